"""Secret scan with a trigram inverted index. Built-in expressions only.

From the regular expression of every rule a Boolean trigram query is derived: all strings that a stretch of the expression
must hold one of give an OR of ANDs, and the stretches of one rule are ANDed. Documents enter the index under
the trigrams that any query names, lower-cased: one posting list per trigram and block of ``BLOCK`` documents. A rule's
query intersects and unites the lists of each block, and only its candidates are verified with the expression itself.
Rules without a mandatory trigram are run over every text.

How it holds at scale: texts are read once. A document that holds fewer of a rule's trigrams than its query asks for at least, for every rule, is
no candidate, so it is not indexed and its text is not moved; the others' texts are shuffled once, by a unique key, to meet their candidates. A block's
documents lie in one partition, so posting lists combine before the shuffle, and no list has more than ``BLOCK``
numbers, however many documents hold a trigram. The plan is the same at every size.

Defined cases: a null text is empty and holds no secret. Repeated rows and null ids are documents of their own. Positions count code
points. Whole texts are read. Matches of one rule do not overlap, those of different rules may. Columns not named in ``keep`` are
left out, one called ``secrets`` is replaced. An empty table gives an empty result.
"""

import functools
import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, whole_text, without
from riskloom.session import materialize

BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS
#: Alternatives of one stretch followed while a query is derived, characters of a class that count as alternatives, and
#: trigrams kept of each AND; fewer make more candidates and the same secrets.
MAX_STRINGS, MAX_CLASS, MAX_TERM = 64, 8, 4
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_STEP = 512


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``shortest`` characters are secrets of this kind."""
    kind: str
    pattern: str
    group: int = 0
    shortest: int = 1


# Fixed patterns of the base kinds; a run shorter than asked for can hold no other match, so the length stands in the pattern.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Published forms of further credentials.
RULES = BASE + (
    Rule("github", r"(?:gh[pousr]_|github_pat_)[A-Za-z0-9_]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)


# trigram queries -----------------------------------------------------------------------------------

def _clause(strings):
    """The OR of ANDs that one of ``strings`` stands in a text, or None if one of them has no trigram."""
    terms = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    if not all(terms):
        return None
    terms = {t for t in terms if not any(other < t for other in terms)}
    return frozenset(frozenset(sorted(t)[:MAX_TERM]) for t in terms)


class _Stretch:
    """What a sequence must hold: finished clauses, and the strings that the open stretch may be."""

    def __init__(self):
        self.clauses, self.strings, self.whole = [], {""}, True

    def add(self, strings):
        strings = {s + t for s in self.strings for t in strings}
        if len(strings) > MAX_STRINGS:
            self.cut()
        else:
            self.strings = strings

    def cut(self):
        """Anything may follow: the open stretch ends."""
        clause = _clause(self.strings)
        if clause:
            self.clauses.append(clause)
        self.strings, self.whole = {""}, False


def _letters(items):
    """Lower-cased characters of a class; None if it has too many or others than ASCII."""
    found = set()
    for what, value in items:
        if what is op.LITERAL:
            codes = [value]
        elif what is op.RANGE and value[1] - value[0] < MAX_CLASS:
            codes = range(value[0], value[1] + 1)
        else:
            return None
        if max(codes) > 127:
            return None
        found |= {chr(c).lower() for c in codes}
    return found if len(found) <= MAX_CLASS else None


def _walk(tokens) -> _Stretch:
    out = _Stretch()
    for what, value in tokens:
        if what in (op.LITERAL, op.IN):
            letters = _letters([(what, value)] if what is op.LITERAL else value)
            out.add(letters) if letters else out.cut()
        elif what is op.SUBPATTERN or what is op.ATOMIC_GROUP:
            _follow(out, [_walk(value[-1] if what is op.SUBPATTERN else value)])
        elif what is op.BRANCH:
            _follow(out, [_walk(branch) for branch in value[1]])
        elif what in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, inner = value
            inner = _walk(inner)
            if least == 0 and most == 1 and inner.whole:
                out.add(inner.strings | {""})
            elif least == 0:
                out.cut()
            else:
                _follow(out, [inner])
                if most != 1:
                    out.cut()
        elif what not in (op.AT, op.ASSERT, op.ASSERT_NOT):  # these take no characters
            out.cut()
    return out


def _follow(out, choices):
    """One of ``choices`` comes next."""
    if all(c.whole for c in choices):
        out.add(set().union(*(c.strings for c in choices)))
        return
    out.cut()
    for c in choices:
        c.cut()
    if len(choices) == 1:
        out.clauses += choices[0].clauses
    elif all(c.clauses for c in choices):  # any clause of each choice is mandatory for it
        out.clauses.append(frozenset().union(*(min(c.clauses, key=len) for c in choices)))


def trigram_query(pattern: str) -> list:
    """Clauses that a text with a match satisfies, each an OR of ANDs of lower-cased trigrams; empty if none is mandatory."""
    try:
        found = _walk(parser.parse(pattern))
    except re.error:
        return []
    found.cut()
    return found.clauses


# postings ------------------------------------------------------------------------------------------

def postings(keyed: DataFrame, key: str, grams: str) -> DataFrame:
    """The inverted index: (block, gram, docs), ``docs`` the sorted numbers within the block.

    ``grams`` tells of each trigram whether the document holds it.
    """
    return (keyed.select(F.col(key).alias("key"), F.posexplode(grams).alias("gram", "held")).where("held")
            .groupBy(F.shiftright("key", BLOCK_BITS).alias("block"), "gram")
            .agg(F.sort_array(F.collect_list(F.col("key").bitwiseAND(BLOCK - 1).cast("int"))).alias("docs")))


def candidates(index: DataFrame, queries: dict, names: list) -> DataFrame:
    """(key, rules): for each document the numbers of the rules whose query its posting lists satisfy."""
    def listed(gram):
        return f"coalesce(lists[{names.index(gram)}], cast(array() AS array<int>))"

    def joined(how, parts):
        return functools.reduce(lambda a, b: f"{how}({a}, {b})", parts)

    def hits(rule, clauses):
        docs = joined("array_intersect", (joined("array_union", (
            joined("array_intersect", map(listed, sorted(term))) for term in sorted(clause, key=sorted))) for clause in clauses))
        return f"transform({docs}, doc -> named_struct('doc', doc, 'rule', {rule}))"

    blocks = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "docs"))).alias("lists"))
    found = blocks.select("block", F.explode(F.expr(f"concat({', '.join(hits(n, q) for n, q in queries.items())})")).alias("hit"))
    key = F.shiftleft("block", BLOCK_BITS) + F.col("hit.doc")
    return found.groupBy(key.alias("key")).agg(F.collect_set("hit.rule").alias("rules"))


# verification --------------------------------------------------------------------------------------

_EMPTY = "cast(array() AS array<struct<start:int,rule:int,end:int>>)"


def _literal(text):
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name, value, body):
    """``body`` with ``name`` standing for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _sum(numbers):
    return f"aggregate({numbers}, 0, (a, b) -> a + b)"


def _before(lengths):
    """For each entry the sum of those before it, by sums of whole steps and the rest of one."""
    def step(i):
        return f"cast({i} div {_STEP} AS int)"

    whole = f"transform(sequence(0, {step('(size(ls) - 1)')}), c -> {_sum(f'slice(ls, c * {_STEP} + 1, {_STEP})')})"
    heads = f"transform(sums, (x, c) -> {_sum('slice(sums, 1, c)')})"
    each = f"element_at(heads, {step('i')} + 1) + {_sum(f'slice(ls, {step("i")} * {_STEP} + 1, i % {_STEP})')}"
    return _let("ls", lengths, _let("sums", whole, _let("heads", heads, f"transform(ls, (x, i) -> {each})")))


def matches(text, rule: Rule, number: int):
    """Secrets of one rule as structs (start, rule, end): the text split at the matches tells where they stand."""
    text, pattern = f"`{text}`", _literal(rule.pattern)
    parts = (f"transform(arrays_zip(split({text}, {pattern}, -1), regexp_extract_all({text}, {pattern}, 0),"
             f" regexp_extract_all({text}, {pattern}, {rule.group})), p -> named_struct('gap', char_length(p['0']),"
             " 'size', char_length(p['1']), 'value', char_length(p['2'])))")
    # The last piece has no match after it.
    placed = (f"zip_with(found, {_before('transform(found, p -> p.gap + p.size)')}, (p, before) -> named_struct("
              f"'start', before + p.gap, 'rule', {number}, 'end', before + p.gap + p.size, 'value', p.value))")
    spans = _let("parts", parts, _let("found", "slice(parts, 1, size(parts) - 1)", placed))
    kept = (f"transform(filter({spans}, p -> p.value >= {rule.shortest}),"
            " p -> named_struct('start', p.start, 'rule', p.rule, 'end', p.end))")
    return F.expr(f"CASE WHEN {text} RLIKE {pattern} THEN {kept} ELSE {_EMPTY} END")


def _enough(clauses, held):
    """Whether a text holds as many trigrams of a query as any way to satisfy it needs."""
    grams = {g for clause in clauses for term in clause for g in term}
    least = max(min(map(len, clause)) for clause in clauses)
    return sum((held[g].cast("int") for g in sorted(grams)), F.lit(0)) >= least


def find_secrets(docs: DataFrame, keep, text="text", rules=RULES) -> DataFrame:
    """The columns ``keep`` and ``secrets``, an array of (kind, start, end) by start, then by order of the rules."""
    queries = {n: trigram_query(r.pattern) for n, r in enumerate(rules)}
    full, queries = [n for n, q in queries.items() if not q], {n: q for n, q in queries.items() if q}
    names = sorted({g for clauses in queries.values() for clause in clauses for term in clause for g in term})
    keep = without(keep, ("secrets",))
    taken = docs.select(*(F.col(f"`{c}`") for c in keep))
    key, grams, body, spans, enough = (fresh(taken, n) for n in ("_key", "_grams", "_text", "_spans", "_enough"))

    # Plain expressions that compile: the text is lower-cased once for all trigrams.
    plain = docs.select(*(F.col(f"`{c}`") for c in keep), whole_text(f"`{text}`").alias(body))
    lowered = F.translate(F.col(body), _UPPER, _UPPER.lower())
    held = {g: F.contains(lowered, F.lit(g)) for g in names}
    possible = [_enough(clauses, held) for clauses in queries.values()]
    scanned = plain.select(
        *(F.col(f"`{c}`") for c in keep), body, F.monotonically_increasing_id().alias(key),
        F.array(*held.values()).cast("array<boolean>").alias(grams), functools.reduce(lambda a, b: a | b, possible, F.lit(False)).alias(enough),
        F.concat(F.expr(_EMPTY), *(matches(body, rules[n], n) for n in full)).alias(spans))
    stored = materialize(scanned.withColumn(body, F.when(F.col(enough), F.col(body))), "scanned")

    columns = [F.col(f"`{c}`") for c in keep]
    result = stored.where(~F.col(enough)).select(*columns, spans)
    if queries:
        index = materialize(postings(stored.where(enough), key, grams), "postings")
        found = candidates(index, queries, names).select(F.col("key").alias(key), F.col("rules").alias(fresh(stored, "_rules")))
        rule_column = found.columns[1]
        met = stored.where(enough).join(found.hint("merge"), key, "left")
        verified = [F.when(F.array_contains(rule_column, n), matches(body, rules[n], n)).otherwise(F.expr(_EMPTY)) for n in queries]
        result = result.unionByName(met.select(*columns, F.concat(F.col(spans), *verified).alias(spans)))
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return result.select(*columns, F.transform(F.array_sort(spans), lambda x: F.struct(
        F.element_at(kinds, x["rule"] + 1).alias("kind"), x["start"], x["end"])).alias("secrets"))


def as_text(secrets):
    """``kind:start:end`` of each, joined by commas."""
    return F.array_join(F.transform(secrets, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
