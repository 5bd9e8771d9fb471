"""Token files coded with a static range asymmetric numeral system.

One frequency table serves the whole corpus. Tokens are coded in independent blocks of whole documents;
within a block many lanes are interleaved over one word stream, so that a step codes one token of
every lane at once. A block holds checkpoints (lane states and stream position), between which
segments can be decoded on their own, and a checksum for each segment and for the block.

Files are Parquet tables of blocks (``part``, ``first``, ``n_tokens``, ``payload``) in ascending
``doc_id`` order, beside the frequency table; ``first`` counts the tokens before the block in its part.

Defined cases: a null or empty text is the end id alone. A null ``doc_id`` comes first. Rows with one
``doc_id`` are ordered by a hash of their ids, then by the ids. Other columns are dropped. An
empty table gives an empty file. A damaged segment raises ``ValueError``.
"""

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm.common import map_batches, whole_text
from riskloom.llm.tokens import END_ID, encoder
from riskloom.session import materialize, shared_path

SCALE_BITS = 20
LANES = 1024
BLOCK_TOKENS = 1 << 19
CHECKPOINT_STEPS = 256
_LOW = np.uint64(1 << 31)
_MAGIC = b"RTB1"
_HEADER = struct.Struct("<4sIIIIIII")  # magic, model crc, documents, tokens, lanes, words, segments, body crc


class Model:
    """Frequencies of all ids, scaled to ``2 ** SCALE_BITS``, every used id having at least one."""

    def __init__(self, ids, counts):
        self.ids = np.asarray(ids, np.uint32)
        counts = np.asarray(counts, np.float64)
        total = 1 << SCALE_BITS
        if len(self.ids) > total:
            raise ValueError("more different ids than the scale has room for")
        freq = np.maximum(1, np.floor(counts * (total / max(1.0, counts.sum())))).astype(np.int64)
        excess = int(freq.sum()) - total
        if len(freq):
            by_size = np.argsort(-freq, kind="stable")
            while excess > 0:  # taken from the largest, which loses least
                for i in by_size:
                    cut = min(excess, int(freq[i]) - 1, max(1, int(freq[i]) >> 4))
                    freq[i] -= cut
                    excess -= cut
                    if not excess:
                        break
            freq[by_size[0]] -= excess
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64) if len(freq) else self.freq
        self.crc = zlib.crc32(self.ids.tobytes() + self.freq.tobytes())
        self._symbol = self._place = None

    def place(self, tokens):
        """Row of each token in the table."""
        if self._place is None:
            self._place = np.zeros(int(self.ids.max()) + 1, np.int64)
            self._place[self.ids] = np.arange(len(self.ids))
        return self._place[tokens]

    def symbol(self, slots):
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq.astype(np.int64))
        return self._symbol[slots]


def encode_block(model: Model, doc_ids, lengths, tokens, lanes=LANES, every=CHECKPOINT_STEPS) -> bytes:
    """A block of whole documents; ``doc_ids`` may hold None."""
    n = len(tokens)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    rows = model.place(tokens)
    freq, start = model.freq[rows], model.start[rows]
    state = np.full(lanes, _LOW, np.uint64)
    limit_shift, scale, low_word = np.uint64(31 - SCALE_BITS + 32), np.uint64(SCALE_BITS), np.uint64(32)
    words, states = [], {}
    for step in range(steps - 1, -1, -1):
        f, c = freq[step * lanes:(step + 1) * lanes], start[step * lanes:(step + 1) * lanes]
        x = state[:len(f)]
        over = x >= (f << limit_shift)
        words.append(x[over].astype(np.uint32))
        x = np.where(over, x >> low_word, x)
        whole = x // f
        state[:len(f)] = (whole << scale) + (x - whole * f) + c
        if step % every == 0:
            states[step // every] = state.copy()
    words.reverse()
    at = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype("<u4")
    stream = np.concatenate(words) if words else np.empty(0, np.uint32)
    missing = np.array([d is None for d in doc_ids], np.uint8)
    body = [np.array([d or 0 for d in doc_ids], "<i8").tobytes(), missing.tobytes(),
            np.asarray(lengths, "<i8").tobytes()]
    for k in range(len(states)):
        piece = np.asarray(tokens[k * every * lanes:(k + 1) * every * lanes], "<u4")
        body += [struct.pack("<II", int(at[k * every]), zlib.crc32(piece.tobytes())),
                 states[k].astype("<u8").tobytes()]
    body.append(stream.astype("<u4").tobytes())
    body = b"".join(body)
    head = _HEADER.pack(_MAGIC, model.crc, len(lengths), n, lanes, len(stream), len(states), zlib.crc32(body))
    return head + struct.pack("<I", every) + body


class Block:
    """A block's index; segments are decoded one by one, in any order."""

    def __init__(self, model: Model, raw: bytes):
        magic, crc, n_docs, self.n_tokens, self.lanes, n_words, self.n_segments, body_crc = _HEADER.unpack_from(raw)
        at = _HEADER.size + 4
        if magic != _MAGIC or crc != model.crc:
            raise ValueError("not a block of this frequency table")
        if zlib.crc32(memoryview(raw)[at:]) != body_crc:
            raise ValueError("block checksum differs")
        self.model = model
        self.every, = struct.unpack_from("<I", raw, _HEADER.size)
        ids = np.frombuffer(raw, "<i8", n_docs, at)
        missing = np.frombuffer(raw, np.uint8, n_docs, at + 8 * n_docs)
        self.doc_ids = [None if m else int(d) for d, m in zip(ids, missing, strict=True)]
        self.lengths = np.frombuffer(raw, "<i8", n_docs, at + 9 * n_docs)
        at += 17 * n_docs
        self.points = []
        for _ in range(self.n_segments):
            position, check = struct.unpack_from("<II", raw, at)
            self.points.append((position, check, np.frombuffer(raw, "<u8", self.lanes, at + 8)))
            at += 8 + 8 * self.lanes
        self.words = np.frombuffer(raw, "<u4", n_words, at)

    def segment(self, k: int):
        """Tokens between checkpoint ``k`` and the next."""
        position, check, state = self.points[k]
        state, model = state.astype(np.uint64), self.model
        first = k * self.every * self.lanes
        n = min(self.n_tokens - first, self.every * self.lanes)
        out = np.empty(n, np.uint32)
        mask, scale, low_word = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
        for at in range(0, n, self.lanes):
            x = state[:min(self.lanes, n - at)]
            slot = x & mask
            symbol = model.symbol(slot.astype(np.int64))
            out[at:at + len(x)] = model.ids[symbol]
            x = model.freq[symbol] * (x >> scale) + slot - model.start[symbol]
            low = np.flatnonzero(x < _LOW)
            x[low] = (x[low] << low_word) | self.words[position:position + len(low)]
            position += len(low)
            state[:len(x)] = x
        if zlib.crc32(out.tobytes()) != check:
            raise ValueError("segment checksum differs")
        return out

    def tokens(self):
        return np.concatenate([self.segment(k) for k in range(self.n_segments)])


def _stored_type(path: str) -> str:
    """Ids on their way to the files: 16 bits if the vocabulary allows."""
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def tokenized(docs: DataFrame, path: str, blanks_dropped: bool) -> DataFrame:
    """``doc_id`` and ``ids`` (unsigned little-endian, ending with the end id)."""
    kind = _stored_type(path)

    def run(batches):
        encode_all = encoder(path, blanks_dropped).encode_all
        for batch in batches:
            found, ends = encode_all(batch.column(1))
            ends = ends + np.arange(1, len(ends) + 1)  # with an end id after each document
            ids, inner = np.full(len(found) + len(ends), END_ID, kind), np.ones(len(found) + len(ends), bool)
            inner[ends - 1] = False
            ids[inner] = found
            bounds = (np.append(0, ends) * ids.itemsize).astype(np.int32)
            stored = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([batch.column(0), stored], names=["doc_id", "ids"])

    return map_batches(docs.select(docs["doc_id"].cast("bigint"), whole_text().alias("text")), run,
                       "doc_id bigint, ids binary")


def _id_counts(tokens: DataFrame, kind: str) -> DataFrame:
    def run(batches):
        counts = np.zeros(0, np.int64)
        for batch in batches:
            ids = batch.column(0)  # all documents of the batch are counted at once
            bounds = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
            held = np.frombuffer(ids.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
            new = np.bincount(held.view(kind), minlength=len(counts))
            new[:len(counts)] += counts
            counts = new
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())],
                                         names=["id", "n"])

    return map_batches(tokens.select("ids"), run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, path: str, blanks_dropped: bool) -> str:
    """Write the coded files; gives their folder. The frequency table, at most as long as the vocabulary, is broadcast."""
    spark = docs.sparkSession
    folder = shared_path(spark, "tokens")
    kind = _stored_type(path)
    tokens = materialize(tokenized(docs, path, blanks_dropped), "ids")
    _id_counts(tokens, kind).write.parquet(f"{folder}/model")
    shared = spark.sparkContext.broadcast(_model_rows(spark, folder))

    def run(batches):
        from pyspark import TaskContext
        part, model, width = TaskContext.get().partitionId(), Model(*shared.value), np.dtype(kind).itemsize
        docs_in, lengths, ids, size, first = [], [], [], 0, 0

        def block():
            payload = encode_block(model, docs_in, lengths, np.frombuffer(b"".join(ids), kind).astype("<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([payload], pa.binary())],
                names=["part", "first", "n_tokens", "payload"])

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs_in.append(doc_id)
                ids.append(raw)
                lengths.append(len(raw) // width)
                size += lengths[-1]
                if size >= BLOCK_TOKENS:
                    yield block()
                    docs_in, lengths, ids, size, first = [], [], [], 0, first + size
        if ids:
            yield block()

    ordered = (tokens.withColumn("tie", F.xxhash64("ids")).repartitionByRange("doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie", "ids").select("doc_id", "ids"))
    map_batches(ordered, run, "part int, first bigint, n_tokens bigint, payload binary").write.parquet(
        f"{folder}/blocks")
    return folder


def _model_rows(spark, folder: str):
    """The frequency table, bounded by the vocabulary."""
    rows = spark.read.parquet(f"{folder}/model").orderBy("id").collect()
    return [r["id"] for r in rows], [r["n"] for r in rows]


def read_tokens(spark, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``, from the files.

    Blocks are decoded apart from each other. What lies before a part comes from the token counts of the
    parts; these are one row per written part, which bounds their window and broadcast.
    """
    shared = spark.sparkContext.broadcast(_model_rows(spark, folder))
    blocks = spark.read.parquet(f"{folder}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("outer"))

    def run(batches):
        model = Model(*shared.value)
        for batch in batches:
            for first, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block = Block(model, payload.as_py())
                raw, lengths = block.tokens().tobytes(), block.lengths
                ends = np.cumsum(lengths)
                ids = [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids, pa.int64()), pa.array(first + ends - lengths, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    return map_batches(blocks.join(F.broadcast(parts), "part").select(F.col("first") + F.col("outer"), "payload"), run,
                       "doc_id bigint, start bigint, n_tokens bigint, ids binary")
