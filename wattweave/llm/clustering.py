"""Centroid clustering (Lloyd's algorithm) with ns-bounds.

Components are turned into integers, so distances and sums are exact and results do not
depend on partitions or on retries. Each vector keeps an upper bound of the distance to its
centroid and a lower bound for every other one, each with the round in which it was
evaluated. The driver keeps the history of all centroids (rounds x centroids x dimensions
numbers). A bound is loosened by the norm of the total displacement of its centroid since that
round, |c(now) - c(then)|, which is never more than the sum of the drifts per round. Where a
lower bound does not exceed the upper one, the upper one is evaluated anew, and the centroids
that still fail are rescanned with exact integer distances. Bounds are rounded outwards, and a
centroid is passed over only if it is farther beyond doubt, so ties go to the smaller number as
in a full scan.

A round is one pass without a shuffle: the vectors with their bounds are read, assigned and
written to the shared folder, and the table before is deleted. Sums are aggregated by Spark
from what was written (a row for each task and centroid is shuffled), so one very common
vector or a large cluster costs no more than its rows.

Vectors that are null, have another length, or hold a null or non-finite component take no
part, and neither do those with an integer beyond ``LARGEST`` in size, whose squared distances
need not fit a long. Vectors of norm zero take part. Repeated rows are rows each, ties and
copies go to the smaller centroid, rows without an id are clustered but can't be a first
centroid. With fewer vectors than centroids there are as many centroids as vectors; an empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattweave.session import discard, durable

DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
#: A component x becomes floor(UNITS * x).
UNITS = 64
LARGEST = (1 << 26) - 1
#: Relative error allowed for in bounds; that of a square root and a few sums is far below.
SLACK = 1e-12
#: Pairs of vector and centroid whose differences are in memory at a time.
CHUNK = 1 << 15


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, units: int, dimensions: int) -> DataFrame:
    """(id, x) of the vectors that take part, their components as integers."""
    vector = F.col(vector_col)
    scaled = lambda c: F.floor(c.cast("double") * units)
    fits = lambda c: F.coalesce(F.abs(c.cast("double")) * units < LARGEST, F.lit(False)) & ~F.isnan(c.cast("double"))
    part = vectors.select(F.col(id_col).alias("id"), vector.alias("vector")).where(
        (F.size("vector") == dimensions) & F.forall("vector", fits)
    )
    return part.select("id", F.transform("vector", lambda c: scaled(c).cast("int")).alias("x"))


def first_centroids(vectors: DataFrame, centroids: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in that order."""
    mixed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("mixed")
    first = vectors.where("id is not null").select(mixed, "x").orderBy("mixed", "x").limit(centroids)
    return np.array([row["x"] for row in first.collect()], np.int64)


def _squared(x: np.ndarray, centroids: np.ndarray, rows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Exact squared distances of pairs (row, centroid)."""
    found = np.empty(len(rows), np.int64)
    for at in range(0, len(rows), CHUNK):
        apart = x[rows[at : at + CHUNK]] - centroids[numbers[at : at + CHUNK]]
        found[at : at + CHUNK] = (apart * apart).sum(axis=1)
    return found


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """Upper bounds of |c(now) - c(then)| for each round until now and each centroid."""
    apart = [((history[-1] - then).astype(float) ** 2).sum(axis=1) for then in history]
    return np.sqrt(np.array(apart)) * (1 + SLACK)


def assign(state: dict[str, np.ndarray], history: list[np.ndarray]) -> dict[str, np.ndarray]:
    """One round over arrays of vectors and bounds; see the module for the method."""
    x, cluster = state["x"].astype(np.int64), state["cluster"].copy()
    near, near_round = state["near"].copy(), state["near_round"].copy()
    far, far_rounds = state["far"].copy(), state["far_rounds"].copy()
    evaluated = state["evaluated"].copy()
    centroids, now, moved = history[-1], len(history) - 1, displacements(history)
    n, k = far.shape
    every = np.arange(n)

    upper = near + moved[near_round, cluster]
    lower = far - moved[far_rounds, np.arange(k)]
    lower[every, cluster] = np.inf
    rows = np.flatnonzero((lower <= upper[:, None]).any(axis=1))

    own = _squared(x, centroids, rows, cluster[rows])
    evaluated[rows] += 1
    near[rows], near_round[rows] = np.sqrt(own) * (1 + SLACK), now
    at, other = np.nonzero(lower[rows] <= near[rows, None])
    exact = _squared(x, centroids, rows[at], other)
    np.add.at(evaluated, rows[at], 1)
    far[rows[at], other], far_rounds[rows[at], other] = np.sqrt(exact) * (1 - SLACK), now

    known = np.full((len(rows), k), np.iinfo(np.int64).max)
    known[at, other] = exact
    known[np.arange(len(rows)), cluster[rows]] = own
    best = known.argmin(axis=1)  # the first of equal ones
    changed = np.flatnonzero(best != cluster[rows])
    left = rows[changed]
    far[left, cluster[left]], far_rounds[left, cluster[left]] = np.sqrt(own[changed]) * (1 - SLACK), now
    cluster[left] = best[changed]
    near[left] = np.sqrt(known[changed, best[changed]]) * (1 + SLACK)
    return {
        "cluster": cluster,
        "near": near,
        "near_round": near_round,
        "far": far,
        "far_rounds": far_rounds,
        "evaluated": evaluated,
        "distance": _squared(x, centroids, every, cluster),
    }


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(matrix.ravel(), kind))


def _round(state: DataFrame, history: list[np.ndarray], dimensions: int) -> DataFrame:
    k = len(history[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            columns = dict(zip(names, batch.columns))
            arrays = {"x": _matrix(columns["x"], dimensions)}
            for name in ("far", "far_rounds"):
                arrays[name] = _matrix(columns[name], k).copy()
            for name in ("cluster", "near", "near_round", "evaluated"):
                arrays[name] = columns[name].to_numpy(zero_copy_only=False)
            for name, values in assign(arrays, history).items():
                kind = columns[name].type
                columns[name] = _lists(values, kind.value_type) if values.ndim == 2 else pa.array(values, kind)
            yield pa.RecordBatch.from_arrays([columns[name] for name in names], names)

    return state.mapInArrow(run, state.schema)


def _floors(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """Each centroid's vectors' exact floor(sum / count); one without vectors stays."""
    count, sums = F.count("*").alias("n"), [F.sum(F.col("x")[d].cast("long")).alias(f"s{d}") for d in range(before.shape[1])]
    after = before.copy()
    for row in state.groupBy("cluster").agg(count, *sums).collect():  # a row for each centroid
        after[row["cluster"]] = [row[f"s{d}"] // row["n"] for d in range(before.shape[1])]
    return after


def clusters(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = 1,
    units: int = UNITS,
    dimensions: int = DIMENSIONS,
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance, evaluated) of every vector that takes part, and the final centroids.

    The first centroids are the vectors whose ``seed:id`` has the smallest SHA-256. ``rounds``
    times, all vectors are assigned and centroids moved; then vectors are assigned once more.
    distance is the squared one, evaluated the number of exact distances the bounds asked for.
    """
    found = integer_vectors(vectors, id_col, vector_col, units, dimensions)
    history = [first_centroids(found, centroids, seed)]
    k = len(history[0])
    state = found.select(
        "id",
        "x",
        F.lit(0).alias("cluster"),
        F.lit(float("inf")).alias("near"),
        F.lit(0).alias("near_round"),
        F.array_repeat(F.lit(0.0), k).alias("far"),
        F.array_repeat(F.lit(0), k).alias("far_rounds"),
        F.lit(0).cast("long").alias("distance"),
        F.lit(0).alias("evaluated"),
    )
    if not k:
        return state.select("id", "cluster", "distance", "evaluated").limit(0), np.empty((0, dimensions), np.int64)
    written = None
    for _ in range(rounds):
        before, written = written, durable(_round(state, history, dimensions), compression="zstd")
        if before is not None:
            discard(before)
        state = written
        history.append(_floors(state, history[-1]))
    last = durable(_round(state, history, dimensions).select("id", "cluster", "distance", "evaluated"))
    if written is not None:
        discard(written)
    return last, history[-1]


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def _long(total: int | None) -> int | None:
    """None for a sum that does not fit a long."""
    return total if total is not None and total < 2**63 else None


def report(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector: the id, cluster, distance, cluster_inertia, inertia and centroid_sha256."""
    found, centroids = clusters(vectors, id_col, vector_col)
    sums = {
        r["cluster"]: int(r["total"])
        for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    }
    total = _long(sum(sums.values()))
    rows = [(c, _long(sums.get(c)), total, centroid_digest(centroids[c])) for c in range(len(centroids))]
    about = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = found.join(F.broadcast(about), "cluster")  # a row for each centroid
    return joined.select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
