"""Clustering around centroids with a vantage-point tree.

Every round builds a vantage-point tree over the centroids and broadcasts it. Each vector walks it best first: of
its open nodes it takes the one with the least lower bound, measures the node's centroids exactly in integers, and
opens the two halves with bounds from the triangle inequality. It stops when the least bound lies beyond the distance
found; the radius is inclusive, so an equally near centroid in another node is still met and the smaller number wins.
The vectors of a batch take their steps together, each on its own node.

How it holds at scale: vectors never move. A task gives one row of sums per centroid, so hot clusters combine before
the shuffle, and the driver sees ``k`` rows a round. Broadcast: the tree, ``k`` centroids of one length.

Defined cases: entries are floored after scaling. Vectors of another length, null vectors, and those with null or
non-finite entries or entries beyond ``LARGEST`` in size after scaling (whose squares no long holds) are left out.
Starting centroids are the vectors with the smallest digest of their id; ids that repeat are taken by their entries,
null ids come last. Fewer vectors than centroids make fewer centroids; no vector makes an empty result. Empty clusters
keep their centroid. Equal vectors and repeated rows each count. Rows keep their id, null or not.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_batches
from riskloom.llm.vectors import whole_rows
from riskloom.session import materialize

LARGEST = 1 << 27
LEAF = 4
_FAR = np.iinfo(np.int64).max


@dataclass
class Node:
    """Centroids measured at this node, and the halves beyond it with the least and largest distance to its first."""
    members: list
    halves: list


def squared(points, centre):
    """Exact squared distances of rows to one centroid."""
    apart = points - centre
    return np.einsum("ij,ij->i", apart, apart)


def build_tree(centroids: np.ndarray) -> list:
    """Nodes of a vantage-point tree, the root first; ``halves`` holds (node, least, largest)."""
    nodes = []

    def grow(numbers):
        place = len(nodes)
        if len(numbers) <= LEAF:
            nodes.append(Node(numbers, []))
            return place
        # The centroid farthest from the others' middle sees the rest at the most different distances.
        middle = centroids[numbers].mean(axis=0)
        vantage = numbers[int(((centroids[numbers] - middle) ** 2).sum(axis=1).argmax())]
        rest = np.array([c for c in numbers if c != vantage])
        away = np.sqrt(squared(centroids[rest], centroids[vantage]))
        order = np.argsort(away, kind="stable")
        nodes.append(Node([vantage], []))
        for half in (order[:len(order) // 2], order[len(order) // 2:]):
            child = grow(sorted(rest[half].tolist()))
            nodes[place].halves.append((child, away[half].min(), away[half].max()))
        return place

    if len(centroids):
        grow(list(range(len(centroids))))
    return nodes


def nearest(nodes: list, centroids: np.ndarray, points: np.ndarray):
    """Number and squared distance of each point's nearest centroid, the smaller number among equally near ones."""
    label = np.full(len(points), -1, np.int64)
    best = np.full(len(points), _FAR, np.int64)
    bound = np.full((len(points), len(nodes)), np.inf)
    bound[:, :1] = 0
    live = np.arange(len(points) if nodes else 0)
    while len(live):
        at = bound[live].argmin(axis=1)
        least = bound[live, at]
        # Inclusive, and wide enough for the rounding of the square roots.
        near = least <= np.sqrt(best[live].astype(float)) * (1 + 1e-12) + 1e-6
        live, at = live[near & np.isfinite(least)], at[near & np.isfinite(least)]
        bound[live, at] = np.inf
        for place in np.unique(at):
            rows, node = live[at == place], nodes[place]
            for number in node.members:
                away = squared(points[rows], centroids[number])
                better = (away < best[rows]) | ((away == best[rows]) & (number < label[rows]))
                best[rows[better]], label[rows[better]] = away[better], number
            root = np.sqrt(away.astype(float))  # halves are beyond nodes of one centroid
            for child, low, high in node.halves:
                bound[rows, child] = np.maximum(0, np.maximum(low - root, root - high))
    return label, best


def integers(column, size, scale):
    """Places and floored entries of the vectors that count."""
    places, values = whole_rows(column, size)
    values = np.floor(values * scale)
    fits = (np.abs(values) <= LARGEST).all(axis=1)
    return places[fits], values[fits].astype(np.int64)


def seeds(vectors: DataFrame, k, salt, size, scale) -> np.ndarray:
    """The vectors whose salted id has the smallest digest, in its order."""
    hashed = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)

    def run(batches):
        for batch in batches:
            places, points = integers(batch.column(1), size, scale)
            flat = pa.array(points.ravel(), pa.int64())
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(points) + 1) * size, pa.int32()), flat)
            yield pa.record_batch([batch.column(0).take(pa.array(places)), rows], ["digest", "entries"])

    rows = map_batches(vectors.select(hashed.alias("digest"), "vector"), run, "digest string, entries array<bigint>")
    first = rows.orderBy(F.asc_nulls_last("digest"), "entries").limit(k).collect()  # k rows
    return np.array([r.entries for r in first], np.int64).reshape(len(first), size)


def _assigner(shared, size, scale):
    def assign(column):
        centroids, nodes = shared.value
        places, points = integers(column, size, scale)
        return places, points, *nearest(nodes, centroids, points)
    return assign


def moved(vectors: DataFrame, centroids: np.ndarray, size, scale) -> np.ndarray:
    """The centroids after one round: floored means of their vectors; empty ones stay."""
    shared = vectors.sparkSession.sparkContext.broadcast((centroids, build_tree(centroids)))
    assign, k = _assigner(shared, size, scale), len(centroids)

    def run(batches):
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            _, points, label, _ = assign(batch.column(0))
            np.add.at(sums, label, points)
            counts += np.bincount(label, minlength=k)
        used = np.flatnonzero(counts)
        flat = pa.array(sums[used].ravel(), pa.int64())
        rows = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * size, pa.int32()), flat)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(counts[used]), rows], ["cluster", "n", "sums"])

    partial = map_batches(vectors.select("vector"), run, "cluster bigint, n bigint, sums array<bigint>")
    totals = partial.groupBy("cluster").agg(F.sum("n").alias("n"), *(
        F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)))
    after = centroids.copy()
    for row in totals.collect():  # at most k rows
        after[row.cluster] = [row[2 + i] // row.n for i in range(size)]
    shared.destroy()
    return after


def digest(centroid) -> str:
    """SHA-256 of the entries as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def cluster(table: DataFrame, k=40, rounds=5, salt="2", size=64, scale=256, vec_id="vec_id", vector="embedding") -> DataFrame:
    """One row per vector that counts: its id, ``cluster``, squared ``distance``, ``cluster_inertia``, ``inertia``
    and ``centroid_sha256``."""
    spark = table.sparkSession
    vectors = table.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    centroids = seeds(vectors, k, salt, size, scale)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids, size, scale)
    shared = spark.sparkContext.broadcast((centroids, build_tree(centroids)))
    assign = _assigner(shared, size, scale)

    def run(batches):
        for batch in batches:
            places, _, label, best = assign(batch.column(1))
            yield pa.record_batch([batch.column(0).take(pa.array(places)), pa.array(label, pa.int32()), pa.array(best)],
                                  ["id", "cluster", "distance"])

    kind = vectors.schema["id"].dataType.simpleString()
    found = materialize(map_batches(vectors, run, f"id {kind}, cluster int, distance bigint"), "clusters")
    shared.destroy()
    sums = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    facts = spark.createDataFrame(
        [(n, sums.get(n, 0), sum(sums.values()), digest(c)) for n, c in enumerate(centroids)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
