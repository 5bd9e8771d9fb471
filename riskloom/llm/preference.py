"""Preference formatting of conversation pairs.

For a chosen and a rejected conversation the longest common prefix of whole turns is rendered once, as the
prompt; what follows in each is rendered as its completion, with the character spans that the loss
covers (the text of assistant turns and its end mark). Built-in expressions only.

Two ways to get pairs: ``answer_pairs`` gives every conversation a rejected side that shares all its turns but the last answer, which
is that of the next conversation; ``opening_pairs`` pairs conversations with one opening turn.

Defined cases: turns are ordered by ``turn``, then role and text; a null role or text is empty, and null
``turn`` comes first. Rows repeated in full count once. Conversations without a counterpart can be formatted alone, as chosen without a
rejected side. Equal sides give two empty completions. A null ``conv_id`` belongs to no conversation. Other columns are
dropped. Long texts are rendered whole. An empty table gives an empty result.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordering import global_row_number
from riskloom.session import materialize

CLOSE = "<|end|>\n"


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``, its ordered array of role and text."""
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    ordered = F.array_sort(F.collect_list(F.struct(
        F.coalesce("turn", F.lit(-(1 << 62))).alias("turn"), "role", "text")))
    return rows.groupBy("conv_id").agg(ordered.alias("t")).select(
        "conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def _sized(convs: DataFrame) -> DataFrame:
    """``conv_id``, role and text of its opening turn, and ``size``, the characters of its assistant text."""
    answer = F.aggregate(F.filter("turns", lambda x: x["role"] == "assistant"), F.lit(0),
                         lambda s, x: s + F.char_length(x["text"]))
    opening = F.get("turns", F.lit(0))
    return convs.select("conv_id", opening["role"].alias("role"), opening["text"].alias("text"), answer.alias("size"))


def opening_pairs(convs: DataFrame) -> DataFrame:
    """Pairs of conversations with one opening turn, each two in a row in order of id, over the whole table.

    Of the two, the one with more assistant text is chosen, of equals the one of the smaller id. Every
    conversation is paired but the last of an opening that an odd number has; ``unpaired`` gives those.
    The number of a conversation within its opening is its number in the whole order less that of the
    opening's first, so a hot opening is cut like any other rows and the groups that meet hold two.
    """
    opening = F.struct(F.sha2("role", 256).alias("role"), F.sha2("text", 256).alias("text")).alias("opening")
    placed = materialize(global_row_number(_sized(convs).select(opening, "conv_id", "size"),
                                           "opening", "conv_id", name="place"), "openings")
    first = materialize(placed.groupBy("opening").agg(F.min("place").alias("first"), F.count("*").alias("n"))
                        .where("n > 1").select("opening", "first"), "first-places")
    pair = F.floor((F.col("place") - F.col("first")) / 2).alias("pair")
    best = F.struct(-F.col("size"), "conv_id")
    pairs = placed.join(first, "opening").groupBy("opening", pair).agg(
        F.min_by("conv_id", best).alias("chosen_id"), F.max_by("conv_id", best).alias("rejected_id"))
    return pairs.where("chosen_id <> rejected_id").select("chosen_id", "rejected_id")


def unpaired(convs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The conversations that stand in none of the ``pairs``."""
    used = pairs.select(F.col("chosen_id").alias("conv_id")).union(pairs.select("rejected_id"))
    return convs.join(used, "conv_id", "left_anti")


def _last_answer(turns):
    """Number of the last assistant turn, 0 without one."""
    from_end = F.array_position(F.transform(F.reverse(turns), lambda x: x["role"]), "assistant").cast("int")
    return F.when(from_end > 0, F.size(turns) - from_end + 1).otherwise(0)


def answer_pairs(convs: DataFrame) -> DataFrame:
    """``chosen_id``, ``rejected_id`` and the turns ``a`` and ``b`` of both sides, one row per conversation.

    Chosen is the conversation up to its last assistant turn, rejected the same turns closed by the last assistant turn of the
    next conversation in order of id, after the last one that of the first. Conversations without an assistant turn, and a single
    one, have no counterpart: ``rejected_id`` and ``b`` are null, ``a`` holds all their turns. Places in the whole order are unique, so the
    join that brings the next answer has no hot key.
    """
    answered = convs.withColumn("last", _last_answer(F.col("turns")))
    placed = materialize(global_row_number(answered.where("last > 0"), "conv_id", name="place"), "answered")
    n = placed.count()
    following = placed.select(F.col("place").alias("next"), F.col("conv_id").alias("rejected_id"),
                              F.get("turns", F.col("last") - 1).alias("answer"))
    met = placed.join(following.hint("merge"), F.col("place") % n + 1 == F.col("next"))
    before = F.slice("turns", F.lit(1), F.col("last") - 1)
    pairs = met.where(F.lit(n > 1)).select(F.col("conv_id").alias("chosen_id"), "rejected_id", F.slice("turns", F.lit(1), F.col("last")).alias("a"),
                                           F.array_append(before, F.col("answer")).alias("b"))
    alone = answered.where((F.col("last") == 0) | F.lit(n == 1)).select(
        F.col("conv_id").alias("chosen_id"), F.lit(None).cast("bigint").alias("rejected_id"), F.col("turns").alias("a"),
        F.lit(None).cast(convs.schema["turns"].dataType).alias("b"))
    return pairs.unionByName(alone)


def _render(turns):
    return F.array_join(F.transform(turns, lambda x: F.concat(
        F.lit("<|"), x["role"], F.lit("|>\n"), x["text"], F.lit(CLOSE))), "")


def _spans(turns):
    """Start and end of every assistant text with its end mark in the rendering."""
    head = lambda x: F.char_length(x["role"]) + len("<||>\n")
    size = lambda x: F.char_length(x["text"]) + len(CLOSE)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(turns, start, lambda s, x: F.struct(
        (s["at"] + head(x) + size(x)).alias("at"),
        F.when(x["role"] == "assistant", F.array_append(s["spans"], F.struct(
            (s["at"] + head(x)).alias("start"), (s["at"] + head(x) + size(x)).alias("end"))))
        .otherwise(s["spans"]).alias("spans")))["spans"]


def format_preferences(convs: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair of ids, in the columns of ``format_sides``."""
    a = convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("a"))
    b = convs.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("b"))
    return format_sides(pairs.join(a, "chosen_id").join(b, "rejected_id"))


def format_sides(both: DataFrame) -> DataFrame:
    """Of the turns ``a`` and ``b``: ids, ``prefix_turns``, ``prompt``, both completions and their loss spans.

    Without ``b`` nothing is shared and nothing rejected.
    """
    shorter = F.least(F.size("a"), F.size("b"))
    differs = F.array_position(F.zip_with(F.slice("a", 1, shorter), F.slice("b", 1, shorter),
                                          lambda x, y: x != y), True)
    common = F.when(F.col("b").isNull(), 0).when(differs > 0, differs.cast("int") - 1).otherwise(shorter)
    both = both.withColumn("common", common)
    rest = lambda c: F.slice(c, F.col("common") + 1, F.size(c))
    both = both.select("chosen_id", "rejected_id", F.col("common").alias("prefix_turns"),
                       F.slice("a", 1, F.col("common")).alias("prefix"), rest("a").alias("a"),
                       F.when(F.col("b").isNotNull(), rest("b")).alias("b"))
    return both.select("chosen_id", "rejected_id", "prefix_turns", _render(F.col("prefix")).alias("prompt"),
                       _render(F.col("a")).alias("chosen"), _spans(F.col("a")).alias("chosen_spans"),
                       _render(F.col("b")).alias("rejected"), _spans(F.col("b")).alias("rejected_spans"))


def format_single(convs: DataFrame) -> DataFrame:
    """The same columns for conversations without a counterpart: no prompt, nothing rejected."""
    nothing = F.lit(None)
    return convs.select(F.col("conv_id").alias("chosen_id"), nothing.cast("bigint").alias("rejected_id"),
                        F.lit(0).alias("prefix_turns"), F.lit("").alias("prompt"), _render(F.col("turns")).alias("chosen"),
                        _spans(F.col("turns")).alias("chosen_spans"), nothing.cast("string").alias("rejected"),
                        nothing.cast("array<struct<start:int,end:int>>").alias("rejected_spans"))
