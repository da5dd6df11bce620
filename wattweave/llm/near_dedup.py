"""Near-duplicate documents by min-max hashing over word shingles.

Every permutation gives two signature values, the minimum and the maximum of the permuted
shingles. Each is an unbiased trial of the Jaccard similarity and in large sets the two are
almost independent, so half the hash evaluations of plain MinHash fill a band. A band is two
permutations, four values. With 26 bands a pair at similarity 0.75 shares no band with
probability (1 - 0.75**4)**26 = 5e-5, and at 0.8 with 1e-6.

In small sets minimum and maximum depend on each other: with c of u shingles shared, both are
shared with probability c (c - 1) / (u (u - 1)). So pairs with a set of up to ``SMALL``
shingles are found exactly: sets of a size that such a set can be linked with also have a key
for each of their first shingles, in one order for all sets, and two linked sets share one of
these. For other pairs at 0.75 the union has 36 shingles or more and the miss is 6.4e-5 at most.

Equal shingle sets are put together first, so a group of copies costs one bucket row per
band. Links inside buckets are confirmed on the full sets (``components.linked_components``).

Null, empty and white-space texts have an empty set and are linked with nothing. Texts are
hashed whole. Repeated texts form one group, whatever their number. Ids name documents: a
row repeated as a whole gives a row each; a row without an id has no component. An empty
table gives an empty result. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattweave.llm.bitmap import parted
from wattweave.llm.components import linked_components
from wattweave.llm.texts import per_text
from wattweave.session import discard, durable

SHINGLE = 5
PERCENT = 75
BANDS = 26
PERMUTATIONS = 2 * BANDS
#: Pairs with a set of up to so many shingles are found without a miss.
SMALL = 30

_rng = np.random.default_rng(9)
_FACTORS = _rng.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Word hashes a task keeps; beyond it the table starts anew.
WORD_TABLE = 400_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Distinct shingle hashes of a text; keeps the hashes of words met before."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        if not isinstance(text, str):
            return np.empty(0, np.uint64)
        # bytes.lower() and bytes.split() know A-Z and the six ASCII white-space bytes only
        words = text.encode("utf-8").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > WORD_TABLE:
            known.clear()
        try:
            values = [known[w] for w in words]
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            values = [known[w] for w in words]
        hashes = np.array(values, np.uint64)
        width = min(SHINGLE, len(words))
        n = len(words) - width + 1
        rolled = np.full(n, width, np.uint64)
        for k in range(width):
            rolled = _mixed(rolled * _MIX + hashes[k : k + n])
        return np.unique(rolled)


def _bands(shingles: np.ndarray) -> list[int]:
    """One hash per band of the min-max signature."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 4096):
        permuted = shingles[at : at + 4096] * _FACTORS[:, None] + _SHIFTS[:, None]
        permuted ^= permuted >> np.uint64(31)
        permuted *= _MIX
        np.minimum(low, permuted.min(axis=1), out=low)
        np.maximum(high, permuted.max(axis=1), out=high)
    values = np.stack([low, high], axis=1).reshape(BANDS, 4)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(4):
        key = _mixed(key * _MIX + values[:, k])
    return key.view(np.int64).tolist()


def _first_shingles(shingles: np.ndarray) -> list[int]:
    """Keys of the first shingles of a set; two linked sets share one, if the smaller has up to ``SMALL``.

    A set of n linked with another has at least PERCENT % of its shingles in common with it.
    So the first one in common has room for the others behind it, in either set.
    """
    n = len(shingles)
    if PERCENT * n > 100 * SMALL:
        return []
    common = -(-PERCENT * n // 100)
    return _mixed(shingles[: n - common + 1] ^ _MIX).view(np.int64).tolist()


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, size, digest, bands) of every document; digest and bands (all keys) are null for empty sets."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for batch in batches:
            sizes, digests, bands = [], [], []
            for text in batch:
                found = shingler(text)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_hexdigest(found.tobytes()) if len(found) else None)
                bands.append(_bands(found) + _first_shingles(found) if len(found) else None)
            yield pd.DataFrame({"size": sizes, "digest": digests, "bands": bands})

    found = per_text(docs, id_col, text_col, run, "size long, digest string, bands array<long>")
    return found.withColumnRenamed(id_col, "id")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(id, packed, size) from (id, text): the distinct shingle hashes."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for batch in batches:
            sets = [shingler(t).view(np.int64) for t in batch]
            yield pd.DataFrame({"packed": sets, "size": [len(found) for found in sets]})

    return per_text(docs, "id", "text", run, "packed array<long>, size long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, n_shingles, component_id and kept (one document of each component)."""
    known = durable(signatures(docs, id_col, text_col))
    full = known.where("digest is not null")
    first = full.groupBy("digest").agg(F.min("id").alias("rep"))
    owners = durable(full.join(first, "digest").select("id", "digest", "rep").distinct())
    reps = full.join(owners.where("id = rep"), ["id", "digest"], "left_semi")

    rows = reps.select("id", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    rows = durable(rows.join(shared.select("key"), "key", "left_semi"))

    wanted = durable(rows.select("id").distinct())
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    texts = parted(texts, wanted.select(F.col("id").alias("key")), "id")[0].join(wanted, "id")
    sets = durable(shingle_sets(texts.dropDuplicates(["id"])))
    labels = linked_components(rows, sets, PERCENT)
    discard(rows, wanted, sets)
    found = (
        known.select("id", "size", "digest")
        .join(owners, ["id", "digest"], "left")
        .join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left")
        .select(
            F.col("id"),
            F.col("size").alias("n_shingles"),
            F.coalesce("component", "rep", "id").alias("component_id"),
        )
    )
    return found.withColumn("kept", F.col("id") == F.col("component_id")).withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those whose component has a smaller id; rows without an id stay."""
    gone = durable(near_duplicates(docs, id_col, text_col).where("not kept").select(id_col).distinct())
    # Only documents that may go are shuffled.
    perhaps, others = parted(docs, gone.select(F.col(id_col).alias("key")), id_col)
    return others.unionByName(perhaps.join(gone, id_col, "left_anti"))
