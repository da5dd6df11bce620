"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

Codes are the signs of the centred vectors after a projection to their main directions and
a rotation that brings the signs closest to the values (iterative quantisation). For the
largest inner product, vectors get one more component that makes their norms equal, and
queries get 0 there. A code is split into substrings of eight bits, each with an index
from its value to the vectors. A code within Hamming radius r of a query has, by the
pigeonhole principle, a substring within r // (number of substrings) bits, so probing all
values that near finds every such code. These are filtered by their whole distance and
reranked by the inner product in double precision.

Rotation and radius are fitted on a bounded sample: at most ``SAMPLE`` vectors, and the
radius that holds ``COVERED`` of the true neighbours of its queries. Every vector is
indexed. Vectors are dealt into shards by hash and queries into blocks; a task holds one
shard's index and one block. If fewer than k codes of a shard lie within the radius, the
radius grows until there are k or the shard is used up; so k neighbours are always found.

Vectors that are null, empty, zero, or hold null or non-finite components take no part,
nor do those of another length than most. Rows with the query's own id are no candidates
of it. Equal vectors tie and the smaller id wins. A repeated query counts once. Codes of very
large or small vectors are made from scaled ones; their scores are the products in doubles, so
they may be infinite, and one that is no number (infinite parts of both signs) is -infinity.
An empty table gives an empty result; other columns of the table play no part, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 5_000
SAMPLE_QUERIES = 200
COVERED = 0.97
BITS = 64
PIECE = 8
SHARD = 8192
BLOCK = 4096
LOWEST, HIGHEST = 1e-100, 1e100

_ONES = np.array([bin(v).count("1") for v in range(256)], np.uint8)


class BinaryCoder:
    """Rotated sign codes of vectors, with the radius to search."""

    def __init__(self, sample: np.ndarray, norm: float, k: int, rounds: int = 30, seed: int = 3, scale: float = 1.0):
        """``norm`` is the largest norm of all vectors times ``scale``; codes are those of the scaled vectors."""
        self.norm, self.scale = norm, scale
        full = self._widened(sample)
        self.mean = full.mean(axis=0)
        centred = full - self.mean
        bits = min(BITS, full.shape[1])
        _, _, axes = np.linalg.svd(centred, full_matrices=True)
        self.axes = axes[:bits].T
        rotation, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
        low = centred @ self.axes
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.sign(low @ rotation).T @ low)
            rotation = (left @ right).T
        self.axes = self.axes @ rotation
        self.pieces = -(-bits // PIECE)
        self.radius = self._radius(sample, k)

    def _widened(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        vectors = vectors * self.scale
        rest = self.norm**2 - (vectors**2).sum(axis=1)
        return np.column_stack([vectors, np.zeros(len(vectors)) if query else np.sqrt(np.maximum(rest, 0))])

    def codes(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Bytes (n, pieces)."""
        return np.packbits((self._widened(vectors, query) - self.mean) @ self.axes > 0, axis=1)

    def _radius(self, sample: np.ndarray, k: int) -> int:
        queries = np.arange(0, len(sample), max(1, len(sample) // SAMPLE_QUERIES))
        codes = self.codes(sample)
        far = []
        for q in queries:
            score = (sample * self.scale) @ (sample[q] * self.scale)
            score[q] = -np.inf
            near = np.argsort(-score, kind="stable")[: min(k, len(sample) - 1)]
            own = self.codes(sample[q : q + 1], query=True)
            far.append(_ONES[codes[near] ^ own].sum(axis=1))
        distances = np.concatenate(far) if far else np.zeros(1)
        return int(np.quantile(distances, COVERED)) if len(distances) else BITS


class MultiIndex:
    """One index per substring over the vectors of a shard."""

    def __init__(self, coder: BinaryCoder, ids: np.ndarray, vectors: np.ndarray):
        self.coder, self.ids, self.vectors = coder, ids, vectors
        self.codes = coder.codes(vectors)
        self.order = [np.argsort(self.codes[:, j], kind="stable") for j in range(coder.pieces)]
        self.starts = [np.searchsorted(self.codes[o, j], np.arange(257)) for j, o in enumerate(self.order)]
        self.masks = [np.flatnonzero(_ONES <= bits) for bits in range(PIECE + 1)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of all codes within the radius."""
        pieces = self.coder.pieces
        masks = self.masks[min(PIECE, radius // pieces)]
        seen = np.zeros(len(self.ids), bool)
        for j in range(pieces):
            order, starts = self.order[j], self.starts[j]
            for value in code[j] ^ masks:
                seen[order[starts[value] : starts[value + 1]]] = True
        found = np.flatnonzero(seen)
        return found[_ONES[self.codes[found] ^ code].sum(axis=1) <= radius]

    def nearest(self, own: int, query: np.ndarray, code: np.ndarray, k: int) -> list[tuple[int, float]]:
        radius, most = self.coder.radius, PIECE * self.coder.pieces
        while True:
            found = self.within(code, radius)
            found = found[self.ids[found] != own]
            if len(found) >= k or radius >= most:
                break
            radius = min(most, radius + self.coder.pieces)
        with np.errstate(over="ignore", invalid="ignore"):
            scores = (self.vectors[found] * query).sum(axis=1)
        scores[np.isnan(scores)] = -np.inf
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[scores >= least], scores[scores >= least]
        best = np.lexsort((self.ids[found], -scores))[:k]
        return [(int(self.ids[found[b]]), float(scores[b])) for b in best]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) as doubles, of the rows that take part."""
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & (F.size("vector") > 0))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0))


def fit(rows: DataFrame, k: int) -> tuple[BinaryCoder, int] | None:
    """Coder for the vectors of the most frequent length, and their number; None without any."""
    size, square = F.size("vector"), F.aggregate("vector", F.lit(0.0), lambda t, x: t + x * x)
    largest = F.array_max(F.transform("vector", F.abs))
    lengths = rows.groupBy(size.alias("size")).agg(
        F.count("*").alias("n"), F.max(square).alias("square"), F.max(largest).alias("largest")
    )
    most = lengths.orderBy(F.desc("n"), "size").first()
    if most is None:
        return None
    own = rows.where(size == most["size"])
    # by hash order: at most SAMPLE rows come to the driver, the same ones every time
    sample = own.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    table = np.array([r["vector"] for r in sample], float)
    norm, scale = float(np.sqrt(most["square"])), 1.0
    if not LOWEST < norm < HIGHEST:
        # squares leave the range of doubles: components are brought below 1 by a power of two
        norm, scale = float(np.sqrt(most["size"])), 2.0 ** -max(-1000, min(1023, int(np.frexp(most["largest"])[1])))
    return BinaryCoder(table, norm, k, scale=scale), most["n"]


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 20,
    k: int = 20,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """The k nearest of every row whose id is divisible by ``every``: query_id, rank, <id>, score."""
    rows = usable(vectors, id_col, vector_col)
    fitted = fit(rows, k)
    schema = "query_id long, near_id long, score double"
    if fitted is None:
        found = rows.sparkSession.createDataFrame([], schema)
    else:
        coder, n = fitted
        size = len(coder.mean) - 1
        rows = rows.where(F.size("vector") == size)
        queries = rows.where(F.col("id") % every == 0).dropDuplicates(["id"])
        shards = max(1, -(-n // shard))
        blocks = max(1, -(-n // (every * block)))
        deal = lambda column, count: F.pmod(F.xxhash64("id", F.lit(column)), F.lit(count)).cast("int")
        every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
        every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        left = rows.select("id", "vector", deal("shard", shards).alias("shard"), every_block)
        right = queries.select("id", "vector", deal("block", blocks).alias("block"), every_shard)

        def search(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(own) and len(asked):
                index = MultiIndex(coder, own["id"].to_numpy(), np.stack(own["vector"].to_list()).astype(float))
                table = np.stack(asked["vector"].to_list()).astype(float)
                codes = coder.codes(table, query=True)
                for query, vector, code in zip(asked["id"].to_list(), table, codes):
                    out += [(query, near, score) for near, score in index.nearest(query, vector, code, k)]
            return pd.DataFrame(out, columns=["query_id", "near_id", "score"])

        keys = ["shard", "block"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "near_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("near_id").alias(id_col), "score")
