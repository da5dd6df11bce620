import os
import random

import pytest

DATA = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside, as a user's table may have them.
CLASHING = "id long, key string, component string, size string, line string, score string, label string, rep string"


def needs_data(name="documents"):
    return pytest.mark.skipif(not os.path.exists(f"{DATA}/{name}.parquet"), reason="driver tables are not here")


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) or (doc_id, text, lang) as a table of documents."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def clashing_docs(spark):
    def make(rows):
        full = [(*r, 1, "k", "c", "s", "l", "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, {CLASHING}")

    return make


SYLLABLES = ["th", "er", "on", "an", "re", "ing", "nd", "ha", "es", "or", "ti", "ou", "ble", "st", "en"]


def word(rng):
    return "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))


def sentence(rng, n):
    return " ".join(word(rng) for _ in range(n))


def edited(rng, text, share):
    """The text with about this share of its words replaced."""
    return " ".join(word(rng) if rng.random() < share else w for w in text.split(" "))


@pytest.fixture
def rng():
    return random.Random(17)


def unions(ids, links):
    """Smallest id of each component."""
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {i: top(i) for i in ids}
