"""Surrogates for personal data: keyed, type-consistent replacements.

Every detected entity gets one replacement in the whole corpus (coreference), no two entities share one
(distinctness), and no replacement is itself an entity of the corpus. A replacement is drawn from
SHA-256 over key, entity and attempt and keeps type and format: digits stay digits, letters keep case and
script, octets stay below 256, a card number keeps whether its check digit is right, a phone number
its country code, a token its alphabet, a name its script, a given name its title's gender. Given name and surname are
entities of their own, the given name one for each gender: "Mr John Smith" and "Mr Smith" keep one surname, "Mrs Alex" and
"Mr Alex" differ. The type of a secret and of a name comes from the words before it. Draws that collide go to
the smallest entity; the others draw again. Built-in expressions only.

How it holds at scale: every text is read and matched once and stored. Texts without a match, most of all, are passed on
where they lie; the pieces of the others are shuffled once, by a unique row number, to meet their surrogates. Joins are of one kind at every
size; a hot entity is split by the engine's skew handling.

An e-mail in another case, and a phone, card, IBAN or SSN with other blanks, dots, dashes or brackets, is the same
entity; its replacement is written in the format of each mention. A phone with and one without country code are two.

Defined cases: a null text stays null. Repeated rows give equal results. A null ``doc_id`` is carried
through. Columns named like a result column are replaced. An empty table gives an empty result.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, without
from riskloom.session import materialize

# After a blank: an IP, SSN, card or phone of its own, which a phone number must not run on into.
_ANOTHER = (r"(?! (?:(?:\d{1,3}\.){3}\d|\d{3}-\d{2}-\d{4}(?![\d\-])|(?:\d{4}[ \-]){3}\d{4}(?![\d\-])"
            r"|\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])))")
# No more digits since the plus sign; written out, as a look-behind allows no repeated groups.
_AT_MOST_15 = r"(?<!\+" + r"[ .\-()]{0,2}\d" * 16 + r"(?:[ .\-()]{0,2}\d)?" * 11 + ")"
#: Patterns of the entity types, tried in this order at every place of a text. A cheap test stands before each
#: costly one; an address starts where its run of characters does or where the last match ended, so that
#: a long run without an "@" is read once, and has at most the 127 labels of a host name.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+\-]))[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+){1,126}",
    "secret": r"(?<=[\"'=: ])(?<=(?i:token|key|secret|password) ?[=:] ?[\"']?)(?=[A-Za-z_\-]*+\d|[A-Za-z0-9_\-]{16})[A-Za-z0-9_\-]{8,}+",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": rf"(?<![\w+])\+\d{{1,3}}{_ANOTHER}[ .\-]?(?:\(\d{{1,4}}\){_ANOTHER}[ .\-]?)?\d{{1,4}}"
             rf"(?:{_ANOTHER}[ .\-]?\d{{2,4}}){{1,4}}(?!\d){_AT_MOST_15}"
             r"|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])",
    "card": r"(?<![\d.\-])(?:\d{4}[ \-]){3}\d{4}(?![\d\-])|(?<![\d.])\d{13,19}(?!\d)",
    "name": r"(?=\p{Lu})(?<= )(?<=\b(?:Mr|Mrs|Ms|Herr|Frau|Mme|Sr|Sra|г-н|г-жа|κ|κα)\.? )\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?",
}
# What stands before a secret, a name, and the name of a woman.
_SECRET_BEFORE = r"(?i)(?:token|key|secret|password) ?[=:] ?[\"']?$"
_TITLE_BEFORE = r"\b(?:Mr|Mrs|Ms|Herr|Frau|Mme|Sr|Sra|г-н|г-жа|κ|κα)\.? $"
_WOMAN_BEFORE = r"\b(?:Mrs|Ms|Frau|Mme|Sra|г-жа|κα)\.? $"
#: Attempts that keep the format; later ones may lengthen the replacement, so that drawing ends.
EXACT_ATTEMPTS = 8
# Given names by script and gender, and syllables of invented surnames by script.
GIVEN = {
    ("latin", "f"): ["Anna", "Clara", "Emma", "Julia", "Laura", "Maria", "Nora", "Sofia"],
    ("latin", "m"): ["Adam", "Daniel", "Jonas", "Lukas", "Martin", "Oscar", "Paul", "Simon"],
    ("cyrillic", "f"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Иван", "Максим", "Олег", "Павел", "Семён"],
    ("greek", "f"): ["Αννα", "Ελενη", "Ιωαννα", "Κλειω", "Μαρια", "Νεφελη", "Σοφια", "Χλοη"],
    ("greek", "m"): ["Αλεξης", "Γιωργος", "Ηλιας", "Κωστας", "Μανος", "Νικος", "Πετρος", "Σταθης"],
}
SYLLABLES = {
    "latin": ["ba", "do", "fen", "gar", "hil", "ker", "lin", "mor", "nes", "pol", "ras", "sel", "tan", "vik", "wes", "zan"],
    "cyrillic": ["ба", "во", "гор", "дан", "жук", "зел", "кор", "лен", "мар", "нов", "пет", "рос", "сам", "тар", "чер", "шев"],
    "greek": ["βα", "γο", "δεν", "ζαρ", "θελ", "καρ", "λιν", "μορ", "νεσ", "παλ", "ροδ", "σελ", "ταν", "φικ", "χαρ", "ψαν"],
}


def whole_pattern() -> str:
    return "|".join(f"(?:{p})" for p in PATTERNS.values())


def _kind(mention, before):
    """Type of a mention, from its own characters and, for secrets and names, the text before it."""
    e, before = F.col(mention), F.col(before)
    return (F.when(e.contains("@"), "email")
            .when(e.rlike(r"^[A-Za-z0-9_\-]{8,}$") & before.rlike(_SECRET_BEFORE), "secret")
            .when(e.rlike(r"^\p{Lu}\p{Ll}+( \p{Lu}\p{Ll}+)?$") & before.rlike(_TITLE_BEFORE), "name")
            .when(e.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
            .when(e.rlike(r"^[A-Z]{2}\d{2}( ?[A-Z0-9]{4}){3}"), "iban")
            .when(e.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(e.rlike(r"^(\+|\(\d{3}\)|\d{3}[.\-]\d{3}[.\-]\d{4}$)"), "phone")
            .when(e.rlike(r"^[\d \-]+$"), "card").otherwise("secret"))


def _plain(kind, text):
    """A mention without what its format adds: the entity by which surrogates are keyed."""
    return (F.when(kind == "email", F.lower(text)).when(kind == "phone", F.translate(text, " .-()", ""))
            .when(kind.isin("card", "ssn"), F.translate(text, " -", ""))
            .when(kind == "iban", F.translate(text, " ", "")).otherwise(text))


def _in_format(kind, mention, surrogate):
    """The ``surrogate`` of a plain entity as this mention writes it; what a late attempt adds stands at the end."""
    cased = F.array_join(F.transform(F.split(surrogate, ""), lambda c, i: F.when(
        F.substring(mention, i + 1, F.lit(1)).rlike("[A-Z]"), F.upper(c)).otherwise(c)), "")
    marked = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(_plain(kind, c) == "", c).otherwise(
        F.substring(surrogate, F.length(_plain(kind, F.substring(mention, F.lit(1), i + 1))), F.lit(1)))), "")
    rest = F.substring(surrogate, F.length(_plain(kind, mention)) + 1, F.length(surrogate))
    return (F.when(_plain(kind, mention) == mention, surrogate)
            .when(kind == "email", F.when(F.length(surrogate) == F.length(mention), cased).otherwise(surrogate))
            .otherwise(F.concat(marked, rest)))


def _draw(key: str, entity: str, attempt, salt: str):
    """192 hash values of 0..65535 for an entity, by position (from 1)."""
    blocks = [F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(f"{salt}{i}"), attempt.cast("string"), F.col(entity)), 256)
              for i in range(12)]
    return F.concat(*blocks)


def _value(stream, i):
    """The ``i``-th (from 0) 16-bit value of a hash stream; longer entities go round."""
    return F.conv(F.substring(stream, (i % 192) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _same_format(entity, stream, letters=True, hexadecimal=False, keep=None):
    """Each digit and letter replaced by one of its kind; ``keep(c, i)`` says what stays."""
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def one(c, i):
        v = _value(stream, i)
        out = F.when(keep(c, i), c) if keep else F.when(F.lit(False), c)
        if hexadecimal:
            return out.when(c.rlike("^[0-9a-f]$"), F.substring(F.lit("0123456789abcdef"), v % 16 + 1, F.lit(1))).otherwise(c)
        out = out.when(c.rlike("^[0-9]$"), (v % 10).cast("string"))
        if letters:
            out = (out.when(c.rlike("^[a-z]$"), F.substring(F.lit(lower), v % 26 + 1, F.lit(1)))
                   .when(c.rlike("^[A-Z]$"), F.substring(F.lit(upper), v % 26 + 1, F.lit(1))))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(entity, ""), one), "")


def _luhn_rest(digits):
    """Luhn sum of a digit string, doubling every second digit from the last but one."""
    d = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(
        i % 2 == 1, F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1))
        .otherwise(c.cast("int")))
    return F.aggregate(d, F.lit(0), lambda s, x: s + x) % 10


def _card(entity, stream):
    drawn = _same_format(entity, stream, letters=False, keep=lambda c, i: i == 0)
    plain = lambda x: F.regexp_replace(x, "[^0-9]", "")
    zero_end = F.regexp_replace(drawn, "[0-9]$", "0")
    off = F.when(_luhn_rest(plain(entity)) == 0, F.lit(0)).otherwise(_value(stream, F.lit(100)) % 9 + 1)
    last = (10 - _luhn_rest(plain(zero_end)) + off) % 10
    return F.concat(F.regexp_replace(drawn, "[0-9]$", ""), last.cast("string"))


def _octets(entity, stream, attempt):
    def one(x, i):
        v = _value(stream, i)
        exact = F.when(F.length(x) == 3, v % 156 + 100).when(F.length(x) == 2, v % 90 + 10).otherwise(v % 10)
        return F.when(attempt < EXACT_ATTEMPTS, exact).otherwise(v % 256).cast("string")
    return F.array_join(F.transform(F.split(entity, r"\."), one), ".")


def _name(entity, kind, gender, stream, attempt):
    """An invented surname, or a given name of the gender; later attempts add syllables."""
    script = (F.when(entity.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(entity.rlike(r"^\p{IsGreek}"), "greek")
              .otherwise("latin"))
    pick = lambda words, i: F.element_at(F.array(*map(F.lit, words)), _value(stream, F.lit(i)) % len(words) + 1)

    def chosen(options, i):
        out = None
        for test, words in options:
            out = F.when(test, pick(words, i)) if out is None else out.when(test, pick(words, i))
        return out

    given = chosen([((script == s) & (gender == g), words) for (s, g), words in GIVEN.items()], 0)
    syllable = lambda i: chosen([(script == s, words) for s, words in SYLLABLES.items()], i)
    more = F.when(attempt > 0, syllable(5)).otherwise("")
    more = F.concat(more, F.when(attempt >= EXACT_ATTEMPTS, F.concat(*[syllable(i) for i in range(6, 12)])).otherwise(""))
    return F.when(kind == "given", F.concat(given, more)).otherwise(
        F.initcap(F.concat(syllable(1), syllable(2), syllable(3), more)))


def _replacement(key: str, attempt):
    """A drawn replacement of ``entity``, by ``kind`` and ``gender``."""
    entity, stream = F.col("entity"), F.col("stream")
    longer = F.when(attempt >= EXACT_ATTEMPTS, F.substring(F.regexp_replace(F.substring(stream, 300, 64), "[a-f]", ""), 1, 6)
                    ).otherwise("")
    at = F.instr(entity, "@")
    suffix = F.length(F.regexp_extract(entity, r"\.[A-Za-z0-9\-]+$", 0))
    email = F.concat(longer, _same_format(entity, stream, keep=lambda c, i: i >= F.length(entity) - suffix))
    phone = F.concat(_same_format(entity, stream, letters=False, keep=lambda c, i: i < F.col("country")), longer)
    secret = F.concat(F.when(entity.rlike("^[0-9a-f]+$"), _same_format(entity, stream, hexadecimal=True))
                      .otherwise(_same_format(entity, stream)), longer)
    plain = F.concat(_same_format(entity, stream, letters=True, keep=lambda c, i: (F.col("kind") == "iban") & (i < 2)), longer)
    return (F.when((F.col("kind") == "email") & (at > 0), email).when(F.col("kind") == "ip", _octets(entity, stream, attempt))
            .when(F.col("kind") == "phone", phone).when(F.col("kind") == "card", F.concat(_card(entity, stream), longer))
            .when(F.col("kind").isin("name", "given"), _name(entity, F.col("kind"), F.col("gender"), stream, attempt))
            .when(F.col("kind") == "secret", secret).otherwise(plain))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``who``, ``surrogate`` and ``attempt`` for distinct ``who`` with their ``entity``, ``kind``, ``gender``, ``country``.

    Each round draws for the entities still open. A draw is free if no entity is spelled so and nobody
    holds it; of several that drew it the smallest entity gets it. Few are left after the first round.
    """
    spelled = entities.select(F.col("entity").alias("surrogate")).distinct()
    done, waiting, attempt = None, entities, 0
    while True:
        n = F.lit(attempt)
        drawn = materialize(waiting.withColumn("stream", _draw(key, "who", n, "s")).select(
            *entities.columns, _replacement(key, n).alias("surrogate"), n.alias("attempt")), "draws")
        free = drawn.join(spelled.hint("merge"), "surrogate", "left_anti")
        if done is not None:
            free = free.join(done.select("surrogate").hint("merge"), "surrogate", "left_anti")
        won = free.groupBy("surrogate").agg(F.min_by(F.struct("who", "attempt"), "who").alias("w"))
        won = materialize(won.select("w.who", "surrogate", "w.attempt"), "surrogates")
        waiting = drawn.join(won.hint("merge"), "who", "left_anti").select(*entities.columns)
        done = won if done is None else done.union(won)
        attempt += 1
        if waiting.isEmpty():
            return done


def _places(matched: DataFrame, row, mentions, pieces) -> DataFrame:
    """One row per mention, two for a name of two words: ``pos``, ``part``, ``mention``, ``kind``, ``gender``, ``entity``, ``who``."""
    before = F.transform(F.slice(pieces, F.lit(1), F.size(mentions)), lambda p: F.right(p, F.lit(24)))
    each = matched.select(F.col(row).alias("row"), F.posexplode(F.arrays_zip(F.col(mentions).alias("mention"), before.alias("before"))))
    each = each.select("row", "pos", "col.mention", "col.before").withColumn("kind", _kind("mention", "before"))
    name = F.col("kind") == "name"
    words = F.when(name, F.split("mention", " ")).otherwise(F.array("mention"))
    each = each.select("row", "pos", "before", "kind", F.size(words).alias("words"), F.posexplode(words).alias("part", "mention"))
    given = (F.col("words") == 2) & (F.col("part") == 0)
    gender = F.when(given, F.when(F.col("before").rlike(_WOMAN_BEFORE), "f").otherwise("m")).otherwise("")
    each = each.select("row", "pos", "part", "mention", F.when(given, "given").otherwise(F.col("kind")).alias("kind"), gender.alias("gender"))
    each = each.withColumn("entity", _plain(F.col("kind"), F.col("mention")))
    return each.withColumn("who", F.concat_ws("\x1f", "kind", "gender", "entity"))


def replace_personal_data(docs: DataFrame, key: str, text="text") -> DataFrame:
    """``docs`` with surrogates in the text, and ``n_entities``."""
    row, mentions, pieces, found = (fresh(docs, n) for n in ("_row", "_mentions", "_pieces", "_found"))
    others = [F.col(f"`{c}`") for c in without(docs.columns, (text, "n_entities"))]
    pattern = whole_pattern()
    scanned = docs.select(*others, F.col(f"`{text}`").alias(text), F.monotonically_increasing_id().alias(row),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias(mentions))
    hit = F.coalesce(F.size(mentions), F.lit(0)) > 0
    stored = materialize(scanned.select(
        *others, F.when(~hit, F.col(text)).alias(text), row, F.when(hit, F.col(mentions)).alias(mentions),
        F.when(hit, F.split(text, pattern, -1)).alias(pieces)), "scanned")
    matched = stored.where(F.col(mentions).isNotNull())
    places = materialize(_places(matched, row, mentions, pieces), "places")
    entities = places.groupBy("who", "entity", "kind", "gender").agg(F.max(F.length(
        F.regexp_extract("mention", r"^\+\d{1,3}(?=[ .\-(])", 0))).alias("country"))
    surrogates = materialize(assign(materialize(entities, "entities"), key), "surrogates")
    written = _in_format(F.col("kind"), F.col("mention"), F.col("surrogate")).alias("surrogate")
    lists = places.join(surrogates.select("who", "surrogate").hint("merge"), "who").groupBy(F.col("row").alias(row)).agg(
        F.sort_array(F.collect_list(F.struct("pos", "part", written))).alias(found))
    # A name's second word follows a blank, everything else its piece of the text.
    merged = F.concat(F.array_join(F.transform(found, lambda s: F.concat(
        F.when(s["part"] == 0, F.element_at(pieces, s["pos"] + 1)).otherwise(" "), s["surrogate"])), ""), F.element_at(pieces, -1))
    changed = matched.join(lists.hint("merge"), row).select(
        *others, merged.alias(text), F.size(mentions).cast("bigint").alias("n_entities"))
    return stored.where(F.col(mentions).isNull()).select(*others, text, F.lit(0).cast("bigint").alias("n_entities")).unionByName(changed)
