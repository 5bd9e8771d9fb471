"""Packing of documents into token windows by best-fit decreasing.

Documents longer than a window are first cut into full windows, which are sequences as they are. What
is left of each document is placed, longest first, in the open window with the least
room that still holds it; a segment tree over the remaining capacities finds that window in
logarithmic time. Packing runs within pools of bounded size, so no task holds more than one pool
whatever the input's size.

Defined cases: a null or empty text is the end id alone. Repeated rows are separate documents. A
null ``doc_id`` is carried through. Other columns are dropped. An empty table gives no pieces.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from riskloom.llm.common import map_batches, whole_text
from riskloom.llm.tokens import END_ID, encoder

WINDOW = 2048
#: Tokens packed together; a pool is written before the next is read.
POOL_TOKENS = 8 << 20
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
_TASK_BITS = 33  # sequences of one task are numbered below this


class CapacityTree:
    """Open windows by remaining capacity; gives the tightest one that holds a length."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open = [[] for _ in range(window + 1)]

    def add(self, room: int, item) -> None:
        self.open[room].append(item)
        node = self.leaves + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, length: int):
        """``(room, item)`` with the least room of at least ``length``, or None."""
        node = self.leaves + length
        if not self.count[node]:
            # Climb to the nearest subtree on the right that has a window, then go down its left side.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        item = self.open[room].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, item


def best_fit(lengths, window: int = WINDOW) -> list:
    """``(bin, offset)`` for each length (at most ``window``), placed longest first, ties in given order."""
    tree, placed, bins = CapacityTree(window), [None] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            found = (window, bins)
            bins += 1
        room, which = found
        placed[i] = (which, window - room)
        if room > lengths[i]:
            tree.add(room - lengths[i], which)
    return placed


def _pieces(doc_id, ids: bytes, window: int):
    total = len(ids) // 4
    for start in range(0, total, window):
        yield doc_id, start, min(window, total - start), ids[4 * start:4 * (start + window)], total


def pack_documents(docs: DataFrame, path: str, blanks_dropped=False, window: int = WINDOW) -> DataFrame:
    """One row per piece: which ids of which document stand where in which sequence.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit integers; sorting a
    sequence's pieces by ``offset`` and joining them gives its tokens. Everything happens where the
    documents are read: nothing is shuffled.
    """

    def run(batches):
        encode = encoder(path, blanks_dropped).encode
        end = np.array([END_ID], "<u4").tobytes()
        base = TaskContext.get().partitionId() << _TASK_BITS
        pool, tokens, used = [], 0, 0

        def flush():
            nonlocal pool, tokens, used
            short = [p for p in pool if p[2] < window]
            short.sort(key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1], p[3]))
            full = [(p, (i, 0)) for i, p in enumerate(p for p in pool if p[2] == window)]
            fitted = best_fit([p[2] for p in short], window)
            rows = full + [(p, (len(full) + b, at)) for p, (b, at) in zip(short, fitted, strict=True)]
            first, used = base + used, used + max([s for _, (s, _) in rows], default=-1) + 1
            pool, tokens = [], 0
            for i in range(0, len(rows), 1024):
                part = rows[i:i + 1024]
                columns = [list(c) for c in zip(*(p for p, _ in part), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary()),
                    pa.array(columns[4], pa.int64()),
                    pa.array([first + s for _, (s, _) in part], pa.int64()),
                    pa.array([at for _, (_, at) in part], pa.int64()),
                ], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pieces = list(_pieces(doc_id, encode(text) + end, window))
                pool += pieces
                tokens += pieces[0][4]
                if tokens >= POOL_TOKENS:
                    yield from flush()
        if pool:
            yield from flush()

    return map_batches(docs.select(docs["doc_id"].cast("bigint"), whole_text().alias("text")), run, SCHEMA)
