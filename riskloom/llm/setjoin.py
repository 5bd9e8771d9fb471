"""Exact Jaccard self-join of word 5-gram sets by universe partition and pigeonhole.

Sets link when 100 * |intersection| >= 80 * |union|, that is, when they differ in at most
``H = (|x| + |y|) // 9`` elements. The universe of shingles is hashed into segments whose number grows
with the size band; two linked sets differ in at most ``H`` segments.

* *Whole segments.* A set indexes its first ``H + 1`` segments that hold a selective shingle. If two sets
  agreed in none of them, each would hold a difference, one more than allowed. Segments without a
  selective shingle cost most and sort least, so the allocation gives them nothing and goes on
  to later ones; what counts as common is the same for all sets, so both sides skip alike.
* *One-deletion neighbourhoods.* A set with too few such segments (small, or made of common passages)
  indexes all it has and, besides, half as many longer segments over all its shingles, each whole and
  with every single shingle left out. Two such sets agree in a segment up to one shingle.

Common shingles are estimated on a bounded sample of documents (``SAMPLE_DOCS``). They steer cost only:
any choice gives the same links, as every candidate is verified on the whole sets.

Sets with equal elements are one class from the start. A signature shared by many classes is never
expanded into all pairs: its members are compared with two leaders; only members that stay in
another component are compared with the rest. Bitmaps that grow with the set bound the difference from
below, so that few pairs need their sets. Of those, each set is first compared with its smallest
partner; then only pairs that still lie in different components are.

Shingles and classes are told apart by 64-bit hashes.

Defined cases: a null, empty or blank text has no set, links with nothing and is its own component. A null
``doc_id`` takes part, but never names a component unless all ids in it are null. Repeated rows
fall into one component. Other columns are ignored. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import forgetters, fresh, map_batches, whole_text
from riskloom.llm.links import components
from riskloom.session import materialize

WORDS = 5
#: More segments than differences by this factor, so that some may be skipped.
SPARE = 1.25
#: Documents looked at for common shingles, and in how many of them a shingle is common.
SAMPLE_DOCS, COMMON_IN = 4096, 8
MAX_COMMON = 400_000
BITS = 1024
#: Sets to compare that are looked up by a broadcast (under 50 bytes each).
BROADCAST_SETS = 300_000
#: Sets compared with one leader in a shuffle group; a leader with more is sent to several.
GROUP_SETS = 256
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _WordHashes()
forgetters[__name__] = _words.clear


def mix(x, salt=0):
    """A bijection of 64-bit integers that spreads all bits."""
    x = x + np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str):
    """Sorted distinct 64-bit shingle hashes of a text."""
    words = text.encode().translate(_UPPER).split()
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    if not len(hashes):
        return hashes
    width = min(WORDS, len(hashes))
    acc = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + len(acc)])
    return np.unique(acc)


def set_key(tokens) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes()))))


def runs(size: int):
    """``(band, differences allowed to a partner)`` for a set: its own band, and the next if a partner may lie there."""
    band = size.bit_length() - 1
    top, partner = 2 << band, size * 5 // 4
    yield band, (size + min(partner, top - 1)) // 9
    if partner >= top:
        yield band + 1, (size + partner) // 9


def band_differences(band: int) -> int:
    return 2 * ((2 << band) - 1) // 9


def _segments(tokens, count, salt):
    """Segment numbers present, the sum of mixed tokens in each, and per token its segment and mixed value."""
    place = (mix(tokens, salt) >> np.uint64(11)) % np.uint64(count)
    order = np.argsort(place, kind="stable")
    place, values = place[order], mix(tokens[order], salt + 1)
    starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))) if len(place) else np.empty(0, int)
    sums = np.add.reduceat(values, starts) if len(starts) else np.empty(0, np.uint64)
    return place[starts], sums, place, values


def signatures(tokens, common):
    """Signatures over whole segments, and over longer segments with one-deletion neighbourhoods."""
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        rare = tokens[common[at] != tokens]
    else:
        rare = tokens
    whole, deleted = [], []
    for band, allowed in runs(len(tokens)):
        most = band_differences(band)
        where, sums, _, _ = _segments(rare, int(np.ceil(SPARE * (most + 1))), 3 * band)
        found = mix(sums ^ mix(where, 1000 + band))
        whole.append(found[:allowed + 1])
        if len(found) <= allowed:
            count = (most + 2) // 2
            where, sums, place, values = _segments(tokens, count, 7777 + 3 * band)
            full = np.zeros(count, np.uint64)
            full[where.astype(np.int64)] = sums
            tag = mix(np.arange(count, dtype=np.uint64), 500_000 + band)
            less = full[place.astype(np.int64)] - values
            deleted += [mix(full ^ tag), mix(less ^ tag[place.astype(np.int64)])]
    join = lambda parts: np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)
    return join(whole), join(deleted)


def parity_bits(tokens):
    """A bitmap whose differing bits never outnumber the differing elements, as signed 64-bit words."""
    odd = np.bincount(((tokens >> np.uint64(7)) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def fine_bits(tokens):
    """The like over at least two bits an element, for sets that crowd the short bitmap; None for others."""
    if len(tokens) <= BITS // 2:
        return None
    bits = 4 << (len(tokens).bit_length() - 1)
    odd = np.bincount(((tokens >> np.uint64(7)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def fine_difference(x: bytes, y: bytes) -> int:
    """Differing bits of two fine bitmaps; the longer is folded to the length of the shorter."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return int(np.bitwise_count(x ^ y).sum())


def _common_shingles(docs: DataFrame):
    """Hashes of shingles found in several documents of the bounded sample."""
    spark = docs.sparkSession
    every = max(1, -(-docs.count() // SAMPLE_DOCS))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0)

    def run(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text).view(np.int64))], names=["t"])

    rows = (map_batches(sample.select(whole_text().alias("text")), run, "t bigint").groupBy("t").count()
            .where(F.col("count") >= COMMON_IN).orderBy(F.desc("count"), "t").limit(MAX_COMMON).collect())
    return spark.sparkContext.broadcast(np.sort(np.array([r["t"] for r in rows], np.int64).view(np.uint64)))


def _lists(arrays):
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _indexed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (null without a set), ``n``, ``bits``, ``fine`` and the signatures ``whole`` and ``deleted``."""
    shared = _common_shingles(docs)

    def run(batches):
        common = shared.value
        for batch in batches:
            keys, sizes, bits, fine, whole, deleted = [], [], [], [], [], []
            for text in batch.column(1).to_pylist():
                tokens = shingle_set(text)
                found = signatures(tokens, common) if len(tokens) else (tokens, tokens)
                keys.append(set_key(tokens) if len(tokens) else None)
                sizes.append(len(tokens))
                bits.append(parity_bits(tokens).view(np.uint64))
                fine.append(fine_bits(tokens))
                whole.append(found[0])
                deleted.append(found[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
                 _lists(bits), pa.array(fine, pa.binary()), _lists(whole), _lists(deleted)],
                names=["doc_id", "key", "n", "bits", "fine", "whole", "deleted"])

    texts = docs.select(docs["doc_id"].cast("bigint"), whole_text().alias("text"))
    return materialize(map_batches(texts, run, "doc_id bigint, key bigint, n bigint, bits array<bigint>, "
                                               "fine binary, whole array<bigint>, deleted array<bigint>"), "signatures")


def _members(index: DataFrame) -> DataFrame:
    """``sig``, ``key`` and the leaders ``lo`` and ``hi`` of signatures shared by different sets.

    Whole-segment signatures hold a selective shingle, which bounds their groups, so one window
    does. Neighbourhood signatures may be shared by any number of sets: leaders are
    aggregated first and joined back, where Spark splits hot ones.
    """
    rows = {name: index.where(F.size(name) > 0).select(F.explode(name).alias("sig"), "key")
            for name in ("whole", "deleted")}
    group = Window.partitionBy("sig")
    whole = rows["whole"].select("sig", "key", F.min("key").over(group).alias("lo"),
                                 F.max("key").over(group).alias("hi")).where("lo <> hi").distinct()
    leaders = materialize(rows["deleted"].groupBy("sig").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
                          .where("lo <> hi"), "leaders")
    deleted = rows["deleted"].join(leaders, "sig").distinct()
    members = materialize(whole.unionByName(deleted), "members")
    # Near copies share hundreds of signatures. Of signatures with the same members one says it all;
    # members are compared by count, ends and two 64-bit sums without carry.
    same = members.groupBy("sig").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("n"), F.bit_xor("key").alias("x"),
        F.bit_xor(F.xxhash64("key")).alias("y")).groupBy("lo", "hi", "n", "x", "y").agg(F.min("sig").alias("sig"))
    return materialize(members.join(materialize(same.select("sig"), "groups"), "sig"), "members")


def _classes(index: DataFrame) -> DataFrame:
    """One row per set: ``key``, ``n``, ``bits``, ``fine`` and its smallest document ``first``."""
    return materialize(index.where("key IS NOT NULL").groupBy("key").agg(
        F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("fine").alias("fine"),
        F.min("doc_id").alias("first")), "classes")


def _sets(docs: DataFrame, classes: DataFrame, uses: DataFrame) -> DataFrame:
    """The stored rows ``key``, ``leader``, ``part``, ``member`` with the elements of the set ``key`` as ``tokens``.

    The documents to read again are looked up by a broadcast while the uses are few (they are
    counted), by shuffled joins otherwise. A document in several rows gives its set several times.
    """
    few = uses.count() <= BROADCAST_SETS
    use = F.struct("leader", "part", "member")
    wanted = uses.groupBy("key").agg(F.collect_list(use).alias("uses")) if few else uses.select("key").distinct()
    reps = materialize(wanted.join(classes.select("key", "first"), "key").select(
        F.col("first").alias("_rep"), F.col("key").alias("_key"), *wanted.columns[1:]), "representatives")
    texts = docs.select(docs["doc_id"].cast("bigint").alias("_id"), whole_text().alias("text"))
    others = [reps.schema[c] for c in wanted.columns[1:]]

    def run(batches):
        for batch in batches:
            keep, found = [], []
            for wanted, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = shingle_set(text)
                keep.append(bool(len(tokens)) and set_key(tokens) == wanted)
                if keep[-1]:
                    found.append(tokens.tobytes())
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), pa.array(found, pa.binary()), *kept.columns[2:]],
                                             names=["key", "tokens", *batch.schema.names[2:]])

    chosen = texts.join(F.broadcast(reps) if few else reps, F.col("_id").eqNullSafe(F.col("_rep"))).select(
        "_key", "text", *[f.name for f in others])
    sets = map_batches(chosen, run, T.StructType(
        [T.StructField("key", T.LongType()), T.StructField("tokens", T.BinaryType()), *others]))
    if few:
        return sets.select("key", "tokens", F.explode("uses").alias("use")).select("key", "use.*", "tokens")
    return uses.join(sets, "key").select("key", "leader", "part", "member", "tokens")


def _may_link(a: str, b: str):
    """Bounds on sizes and differing bits; false only for sets that cannot link."""
    words = [F.bit_count(F.get(F.col(f"{a}.bits"), F.lit(i)).bitwiseXOR(F.get(F.col(f"{b}.bits"), F.lit(i))))
             for i in range(BITS // 64)]
    differing = sum(words[1:], words[0])
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (4 * n <= 5 * m) & (4 * m <= 5 * n) & (9 * differing <= n + m)


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the ``pairs`` (``a``, ``b``) that may link by size and bitmaps."""
    x = classes.select(F.col("key").alias("a"), F.struct("n", "bits", "fine").alias("x"))
    y = classes.select(F.col("key").alias("b"), F.struct("n", "bits", "fine").alias("y"))

    def run(batches):
        for batch in batches:
            keep = [f is None or g is None or 9 * fine_difference(f, g) <= both
                    for both, f, g in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = pairs.join(x, "a").join(y, "b").where(_may_link("x", "y")).select(
        "a", "b", (F.col("x.n") + F.col("y.n")).alias("both"), F.col("x.fine").alias("f"), F.col("y.fine").alias("g"))
    return materialize(map_batches(near, run, "a bigint, b bigint"), "pairs")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the stored ``pairs`` that link, by their whole sets.

    The set ``a`` leads its pairs and goes once to each of its groups, before the sets ``b``.
    """
    leaders = materialize(pairs.groupBy(F.col("a").alias("leader")).agg(
        F.ceil(F.count("*") / GROUP_SETS).cast("bigint").alias("parts")), "leaders")
    members = pairs.select(F.col("b").alias("key"), F.col("a").alias("leader")).join(leaders, "leader").select(
        "key", "leader", F.pmod(F.xxhash64("key"), "parts").alias("part"), F.lit(True).alias("member"))
    leading = leaders.select(F.col("leader").alias("key"), "leader", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), F.lit(False).alias("member"))
    uses = materialize(members.unionByName(leading), "uses")

    def run(batches):
        group, held = None, None
        for batch in batches:
            found = []
            for key, leader, part, member, tokens in zip(
                    *(c.to_pylist() for c in batch.columns[:4]), batch.column(4), strict=True):
                tokens = np.frombuffer(tokens.as_buffer(), np.uint64)
                if not member:
                    group, held = (leader, part), tokens.copy()
                elif group == (leader, part):
                    at = np.minimum(np.searchsorted(held, tokens), len(held) - 1)
                    both = int(np.count_nonzero(held[at] == tokens))
                    if 100 * both >= 80 * (len(tokens) + len(held) - both):
                        found.append((leader, key))
                else:
                    raise ValueError("a set came without the set to compare it with")
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)],
                                             names=["a", "b"])

    dealt = _sets(docs, classes, uses).repartition("leader", "part").sortWithinPartitions("leader", "part", "member")
    return materialize(map_batches(dealt, run, "a bigint, b bigint"), "links")


def _spanning_links(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links among the stored ``pairs`` that give the same components as all of them."""
    ends = pairs.union(pairs.select("b", "a")).toDF("key", "other")
    first = materialize(ends.groupBy("key").agg(F.min("other").alias("other")).select(
        *_ordered_pairs("key", "other")).distinct(), "pairs")
    links = _verified(first, docs, classes)
    labels = components(links)
    for end in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"_{end}")), end, "left")
    apart = F.coalesce("_a", "a") != F.coalesce("_b", "b")
    rest = materialize(pairs.where(apart).select("a", "b").join(first, ["a", "b"], "left_anti"), "pairs")
    return links if rest.isEmpty() else links.union(_verified(rest, docs, classes))


def _ordered_pairs(a, b):
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _still_apart(members: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs that share a signature, lie in different components and may link by size and bitmap.

    In each group the largest component stays aside: pairs are those with a member outside it.
    """
    placed = members.select("sig", "key").join(
        labels.select(F.col("node").alias("key"), "label"), "key", "left").select(
        "sig", "key", F.coalesce("label", "key").alias("label"))
    placed = materialize(placed, "placed")
    main = placed.groupBy("sig", "label").count().groupBy("sig").agg(
        F.max_by("label", F.struct("count", "label")).alias("main"), F.count("*").alias("parts"))
    main = materialize(main.where("parts > 1").select("sig", "main"), "apart")
    info = classes.select("key", F.struct("n", "bits").alias("s"))
    rows = materialize(placed.join(main, "sig").join(info, "key"), "apart")
    a = rows.where("label <> main").select("sig", F.col("key").alias("k1"), F.col("label").alias("l1"),
                                           F.col("s").alias("x"))
    b = rows.select(F.col("sig").alias("sig2"), F.col("key").alias("k2"), F.col("label").alias("l2"),
                    F.col("main").alias("main2"), F.col("s").alias("y"))
    pairs = a.join(b, (F.col("sig") == F.col("sig2")) & (F.col("l1") != F.col("l2"))
                   & ((F.col("l2") == F.col("main2")) | (F.col("k1") < F.col("k2"))) & _may_link("x", "y"))
    return pairs.select(*_ordered_pairs("k1", "k2")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest ``doc_id`` reachable by links; also ``key`` and ``label``.

    ``label``, the smallest key of the component, tells components apart; ``component_id`` does not where ids
    are null or stand on several rows.
    """
    index = _indexed(docs)
    members, classes = _members(index), _classes(index)
    pairs = (members.select(*_ordered_pairs("key", "lo")).union(members.select(*_ordered_pairs("key", "hi")))
             .where("a <> b").distinct())
    links = _spanning_links(_plausible(pairs, classes), docs, classes)
    labels = components(links)
    apart = _plausible(_still_apart(members, labels, classes), classes)
    if not apart.isEmpty():
        more = _spanning_links(apart, docs, classes)
        labels = components(links.union(more))
    first = classes.select("key", "first")
    named = first.join(labels.select(F.col("node").alias("key"), "label"), "key", "left").select(
        "key", "first", F.coalesce("label", "key").alias("label"))
    named = materialize(named, "named")
    names = materialize(named.groupBy("label").agg(F.min("first").alias("component_id")), "names")
    by_key = materialize(named.join(names, "label").select(
        F.col("key").alias("_key"), "component_id", "label"), "components")
    return index.select("doc_id", "key", "n").join(by_key, F.col("key") == F.col("_key"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "key", "label")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, with one row of each component: that of the smallest ``doc_id``. Those without a set all stay."""
    found = materialize(near_duplicates(docs).where("key IS NOT NULL"), "found")
    winners = materialize(found.groupBy("label").agg(
        F.min("doc_id").alias("_winner"),
        F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("_key"))
        .select("_winner", "_key"), "winners")
    repeated = found.groupBy("doc_id", "key").count().where("count > 1")
    key = fresh(docs, "_set")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    source = docs.select(row, whole_text().alias("text"))
    schema = T.StructType([source.schema.fields[0], T.StructField(key, T.LongType())])

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
            keys = [set_key(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64())], names=["row", key])

    keyed = map_batches(source, run, schema).select("row", key, F.col("row.doc_id").cast("bigint").alias("_id"))
    fields = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    joined = keyed.join(winners, (F.col(key) == F.col("_key")) & F.col("_id").eqNullSafe(F.col("_winner")), "left")
    if repeated.isEmpty():
        return joined.where(F.col(key).isNull() | F.col("_key").isNotNull()).select(*fields)
    alone = joined.where(F.col(key).isNull())
    # A winner may come in several rows with one id and set; one of them is taken.
    chosen = joined.where(F.col("_key").isNotNull()).groupBy("_id", key).agg(F.first("row").alias("row"))
    return alone.select(*fields).unionByName(chosen.select(*fields))
