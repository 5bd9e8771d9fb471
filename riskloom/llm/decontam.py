"""Benchmark decontamination with a BM25 inverted index of test items, searched by block-max WAND.

The test items are indexed; every training passage is a query. Impacts are divided by the item's score for
itself, so a passage's score is the share of the item's BM25 mass that it repeats, and one
threshold serves all items. Every term has a posting list in the order of the items, cut into blocks of items, with the largest
impact in each block and in the whole list.

A search orders the terms of a passage by the largest impact of their lists. Those before the pivot, where the running sum of these maxima
reaches ``SKIPPED`` of the threshold, cannot lift an item over it by themselves, so their lists, mostly the long ones of frequent words, are never
walked: only blocks in the lists of the terms from the pivot on are met. There the block maxima of those terms and the sum before the pivot bound the
score; a block that still may reach the threshold gets the exact block maxima of the other terms by looking them up, and only blocks that pass this
too are scored item by item. Whole batches of passages take each step together. All items above the threshold are retrieved.
A retrieved item counts as leaked when the passage repeats enough of the word 5-grams of its
question and of its answer. The last sentence of an item is its answer, the rest its question; an item of
one sentence is cut in half; an item of one word is all answer, and its empty question counts as repeated.

Passages are windows of twice the longest item's words, moved by half their width, so an item of a text
always lies in one of them whole.

The items are read in groups of ``ITEMS_PER_PASS`` chosen by a hash; a benchmark of any size takes as many
passes over the texts, and what is broadcast stays bounded. Counts, document frequencies, mean length and
the longest item are those of the whole benchmark in every pass, so scores and passages do not depend on the
groups.

Defined cases: words are runs of letters, digits and underscores in lower case. Null or empty texts and items
without words leak nothing. Repeated items report each id; an item without an id leaks like any other but is not listed, ``overlap`` tells.
A null ``doc_id`` is carried through. Repeated rows are judged one by one. Long texts are judged passage by passage. An empty benchmark
removes nothing, an empty table gives an empty result. Other columns are kept where the result has documents, dropped otherwise.
"""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import map_batches, whole_text, without
from riskloom.session import materialize

K1, B = 1.2, 0.75
#: Share of an item's own BM25 score that a passage must reach.
MIN_SCORE = 0.6
#: Share of the question's and of the answer's 5-grams that must be repeated.
MIN_OVERLAP = 0.5
GRAM = 5
BLOCK_ITEMS = 8
ITEMS_PER_PASS = 16384
#: Passages searched together, and list entries they may meet in one step.
PASSAGES, ENTRIES = 4096, 1 << 20
#: Where the pivot lies; at 1 the fewest lists are walked, at less the first bound is tighter.
SKIPPED = 0.25
_ROUNDING = 1e-5
_WORDS = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"[.!?]\s+")


def words_of(text: str) -> list:
    return _WORDS.findall(text.lower())


def _grams(words):
    width = min(GRAM, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()


def question_and_answer(text: str):
    """5-grams of both parts of an item."""
    text = text.strip()
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    parts = (words_of(text[:ends[-1]]), words_of(text[ends[-1]:])) if ends else ([], [])
    if not all(parts):
        whole = words_of(text)
        parts = (whole[:len(whole) // 2], whole[len(whole) // 2:])
    return tuple(_grams(p) for p in parts)


class Statistics:
    """Of a benchmark: its number of items with words, their mean length, the longest, and in how many items a term stands."""

    def __init__(self, n, mean, longest, df):
        self.n, self.mean, self.longest, self.df = n, mean, longest, df

    @classmethod
    def of(cls, words):
        """Of items given as lists of words."""
        words = [w for w in words if w]
        return cls(len(words), sum(map(len, words)) / max(1, len(words)), max(map(len, words), default=0),
                   Counter(t for w in words for t in set(w)))


def _spread(starts, lengths):
    """The places ``starts[i], ..., starts[i] + lengths[i] - 1`` one after the other, and the ``i`` of each."""
    owner = np.repeat(np.arange(len(starts)), lengths)
    return np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths), owner


class Index:
    """Posting lists of the terms over the items, in blocks.

    The items may be a part of a benchmark; ``statistics`` are those of all of it.
    """

    def __init__(self, items, statistics=None):
        self.items = [(i, words_of(t), t) for i, t in items]
        self.items = [x for x in self.items if x[1]]
        # Like items stand together, so that blocks share their terms.
        self.items.sort(key=lambda x: (sorted(x[1])[:4], x[0] is not None, x[0]))
        known = statistics or Statistics.of([w for _, w, _ in self.items])
        self.longest, mean, df = known.longest, known.mean, known.df
        self.terms, self._parts = {}, {}
        term, item, impact = [], [], []
        for j, (_, w, _) in enumerate(self.items):
            norm = K1 * (1 - B + B * len(w) / mean)
            score = {t: math.log(1 + (known.n - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + norm)
                     for t, n in Counter(w).items()}
            total = sum(score.values())
            for t, s in score.items():
                term.append(self.terms.setdefault(t, len(self.terms) + 1))  # 0: not in any item
                item.append(j)
                impact.append(s / total)
        self.items = [(i, t) for i, _, t in self.items]
        self.n_blocks = len(self.items) // BLOCK_ITEMS + 1
        term, item, impact = np.array(term, np.int64), np.array(item, np.int64), np.array(impact, np.float32)
        order = np.lexsort((item, term))
        term, self.item, self.impact = term[order], item[order].astype(np.int32), impact[order]
        # A block of a list: its key (term, block), where its postings start, and its largest impact.
        keys, starts = np.unique(term * self.n_blocks + self.item // BLOCK_ITEMS, return_index=True)
        self.keys, self.starts = keys, np.append(starts, len(term))
        self.block_max = np.maximum.reduceat(self.impact, starts) if len(starts) else self.impact
        self.lists = np.searchsorted(keys, np.arange(len(self.terms) + 2) * self.n_blocks)  # blocks of a term
        self.list_max = np.zeros(len(self.terms) + 1, np.float32)
        np.maximum.at(self.list_max, term, self.impact)

    def parts(self, j):
        """5-grams of question and answer of an item; only of items that are ever retrieved."""
        if j not in self._parts:
            self._parts[j] = question_and_answer(self.items[j][1])
        return self._parts[j]

    def passages(self, n_words: int):
        """Starts of a text's windows."""
        return range(0, max(1, n_words - self.longest), self.longest)

    def retrieve(self, texts):
        """``(passage, item, score)`` of all passages with a score of ``MIN_SCORE``; ``texts`` are lists of term numbers."""
        terms = [np.unique(numbers) for numbers in texts]
        owner = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        terms = np.concatenate(terms) if len(terms) else np.zeros(0, np.int64)
        owner, terms = owner[terms > 0], terms[terms > 0]
        if not len(terms):
            return
        # By passage, the lists with the smallest maxima first.
        order = np.lexsort((self.list_max[terms], owner))
        owner, terms = owner[order], terms[order]
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        sums = np.cumsum(self.list_max[terms], dtype=np.float64)
        before = np.repeat(sums[first] - self.list_max[terms[first]], np.diff(np.append(first, len(terms))))
        walked = sums - before >= SKIPPED * MIN_SCORE - _ROUNDING
        rest = np.zeros(len(texts))  # of the lists before the pivot
        np.add.at(rest, owner[~walked], self.list_max[terms[~walked]])
        # Passages whose lists together are too long for one step go in several.
        lengths = np.where(walked, self.lists[terms + 1] - self.lists[terms], 0)
        steps = np.cumsum(np.add.reduceat(lengths, first)) // ENTRIES
        ends = np.append(first[1:], len(terms))
        for step in np.unique(steps):
            own = np.flatnonzero(steps == step)
            part = slice(first[own[0]], ends[own[-1]])
            yield from self._search(owner[part], terms[part], walked[part], rest)

    def _search(self, owner, terms, walked, rest):
        lists = terms[walked]
        places, of = _spread(self.lists[lists], self.lists[lists + 1] - self.lists[lists])
        if not len(places):
            return
        met = owner[walked][of] * self.n_blocks + self.keys[places] % self.n_blocks  # (passage, block)
        pairs, where = np.unique(met, return_inverse=True)
        bound = np.bincount(where, self.block_max[places])
        pairs = pairs[bound + rest[pairs // self.n_blocks] >= MIN_SCORE - _ROUNDING]
        per_pair = np.bincount(owner, minlength=int(owner[-1]) + 1)[pairs // self.n_blocks]
        for step in np.split(pairs, np.flatnonzero(np.diff(np.cumsum(per_pair) // ENTRIES)) + 1):
            yield from self._score(owner, terms, step)

    def _score(self, owner, terms, pairs):
        if not len(pairs):
            return
        # The exact block maxima of all terms of those passages.
        starts, ends = np.searchsorted(owner, pairs // self.n_blocks), np.searchsorted(owner, pairs // self.n_blocks, "right")
        at, pair = _spread(starts, ends - starts)
        keys = terms[at] * self.n_blocks + pairs[pair] % self.n_blocks
        found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        held = self.keys[found] == keys
        found, pair = found[held], pair[held]
        bound = np.bincount(pair, self.block_max[found], len(pairs))
        live = bound[pair] >= MIN_SCORE - _ROUNDING
        found, pair = found[live], pair[live]
        # Item by item in the blocks that are left.
        at, of = _spread(self.starts[found], self.starts[found + 1] - self.starts[found])
        scored = (pairs[pair] // self.n_blocks)[of] * len(self.items) + self.item[at]
        hits, where = np.unique(scored, return_inverse=True)
        scores = np.bincount(where, self.impact[at]) if len(hits) else np.zeros(0)
        for hit, score in zip(hits, scores, strict=True):
            if score >= MIN_SCORE - _ROUNDING:
                yield int(hit // len(self.items)), int(hit % len(self.items)), float(score)

    def leaks(self, texts):
        """For each text the ids of the items that leak into it, with the best overlap of both parts."""
        found, waiting = [{} for _ in texts], []

        def judge():
            if not waiting:
                return
            for p, j, _ in self.retrieve([w[2] for w in waiting]):
                i, start, _, words = waiting[p]
                grams = _grams(words[start:start + 2 * self.longest])
                shorter = {}
                share = []
                for part in filter(None, self.parts(j)):
                    n = len(next(iter(part)))
                    if n < GRAM and n not in shorter:
                        inside = words[start:start + 2 * self.longest]
                        shorter[n] = {tuple(inside[k:k + n]) for k in range(len(inside) - n + 1)}
                    share.append(len(part & (shorter[n] if n < GRAM else grams)) / len(part))
                if min(share) >= MIN_OVERLAP:
                    item = self.items[j][0]
                    found[i][item] = max(found[i].get(item, 0.0), min(share))
            waiting.clear()

        for i, text in enumerate(texts):
            words = words_of(text) if self.items else []
            numbers = np.fromiter((self.terms.get(w, 0) for w in words), np.int64, len(words))
            for start in self.passages(len(words)) if words else ():
                waiting.append((i, start, numbers[start:start + 2 * self.longest], words))
                if len(waiting) >= PASSAGES:
                    judge()
        judge()
        return found


def _item_terms(items: DataFrame) -> DataFrame:
    """``part`` (the item's group), ``words`` (of the item, in its first row, else null) and ``term``, a distinct word each."""
    def run(batches):
        for batch in batches:
            for part, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                terms = sorted(set(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(terms), pa.int64()),
                     pa.array([len(words) if k == 0 else None for k in range(len(terms))], pa.int64()),
                     pa.array(terms, pa.string())], names=["part", "words", "term"])

    return materialize(map_batches(items.select("part", "text"), run, "part bigint, words bigint, term string"), "terms")


def _passes(benchmark: DataFrame):
    """``(items, statistics)`` of bounded groups of items; of the document frequencies each has those of its own terms."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), whole_text().alias("text"))
    groups = max(1, -(-items.count() // ITEMS_PER_PASS))
    items = materialize(items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups))), "items")
    terms = _item_terms(items)
    total = terms.agg(F.count("words").alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"),
                      F.coalesce(F.max("words"), F.lit(0)).alias("longest")).first()
    counts = materialize(terms.groupBy("term").agg(F.count("*").alias("df")), "frequencies")
    for group in range(groups):
        rows = items.where(F.col("part") == group).collect()
        own = terms.where(F.col("part") == group).select("term").distinct()
        df = {r["term"]: r["df"] for r in counts.join(own, "term").collect()}
        yield ([(r["item_id"], r["text"]) for r in rows],
               Statistics(total["n"], total["words"] / max(1, total["n"]), total["longest"], df))


def mark_leaks(docs: DataFrame, benchmark: DataFrame, carry) -> DataFrame:
    """``carry`` of each document with ``items``, the sorted ids of the test items that leak into it, and ``overlap``."""
    source = docs.select(*carry, whole_text().alias("__text"))
    schema = T.StructType(source.schema.fields[:-1] + [T.StructField("__items", T.ArrayType(T.LongType())),
                                                       T.StructField("__overlap", T.DoubleType()), source.schema.fields[-1]])
    result = source.select(*carry, F.array().cast("array<bigint>").alias("__items"), F.lit(0.0).alias("__overlap"),
                           "__text")
    spark = docs.sparkSession
    for group in _passes(benchmark):
        shared = spark.sparkContext.broadcast(Index(*group))  # built once; a worker reads it once for all its tasks

        def run(batches, shared=shared, width=len(carry)):
            index = shared.value
            for batch in batches:
                found = index.leaks(batch.column(width + 2).to_pylist())
                items = [sorted(set(before) | set(i for i in now if i is not None)) for before, now in
                         zip(batch.column(width).to_pylist(), found, strict=True)]
                best = [max([before, *now.values()]) for before, now in
                        zip(batch.column(width + 1).to_pylist(), found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:width], pa.array(items, pa.list_(pa.int64())), pa.array(best, pa.float64()),
                     batch.column(width + 2)], names=batch.schema.names)

        result = map_batches(result, run, schema)
    names = without(carry, ("items", "overlap"))
    return result.select(*names, F.col("__items").alias("items"), F.col("__overlap").alias("overlap"))


def remove_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents into which no test item leaks, as they came in."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = mark_leaks(docs.select(row, "text"), benchmark, ["row"])
    return marked.where("overlap = 0").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
