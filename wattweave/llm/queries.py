"""The numbered operators on the driver tables, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wattweave.llm import (
    alignment,
    ann,
    bpe,
    clustering,
    decontaminate,
    html_text,
    language,
    line_dedup,
    near_dedup,
    quality,
    secret_scan,
    token_counts,
    toxicity,
)
from wattweave.sources.views import table

#: Folder of the vocabulary files.
TOKENIZERS = public_tokenizers.path("").rstrip("/")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


@query("op1_line_dedup")
def op1_line_dedup(spark, folder):
    return line_dedup.line_groups(table(spark, folder, "documents"))


@query("op2_token_counts")
def op2_token_counts(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op3_bpe")
def op3_bpe(spark, folder):
    return bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_WORDS = r"""
    WITH doc AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
    ), item AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
    )
"""


@query("op4_quality")
def op4_quality(spark, folder):
    return quality.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(
    "op5_decontamination",
    _WORDS
    + """, wide AS (
        SELECT item_id, ws, least(len(ws), 10) AS w FROM item WHERE len(ws) > 0
    ), windows AS (
        SELECT DISTINCT item_id, w, array_to_string(ws[p:p + w - 1], ' ') AS gram
        FROM (SELECT *, unnest(range(1, len(ws) - w + 2)) AS p FROM wide)
    ), grams AS (
        SELECT doc_id, w, p, array_to_string(ws[p:p + w - 1], ' ') AS gram
        FROM (SELECT doc_id, ws, w, unnest(range(1, len(ws) - w + 2)) AS p
              FROM doc CROSS JOIN (SELECT DISTINCT w FROM windows))
    ), found AS (
        SELECT doc_id, item_id, p, g.w FROM grams g JOIN windows i ON g.w = i.w AND g.gram = i.gram
    ), hit AS (
        SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + w)) AS q FROM found) GROUP BY 1
    ), names AS (
        SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY 1
    )
    SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
           coalesce(names.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(hit.n, 0) > 0 AS contaminated
    FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN names USING (doc_id)
    """,
)
def op5_decontamination(spark, folder):
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_html_text")
def op6_html_text(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


@query("op7_language_id")
def op7_language_id(spark, folder):
    return language.report(table(spark, folder, "documents"))


@query("op8_multi_index_neighbours")
def op8_multi_index_neighbours(spark, folder):
    return ann.nearest(table(spark, folder, "embeddings"))


@query(
    "op9_minmax_dedup",
    r"""
    WITH RECURSIVE doc AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, array_to_string(ws[p:p + w - 1], ' ') AS gram
        FROM (SELECT doc_id, ws, least(len(ws), 5) AS w, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS p
              FROM doc WHERE len(ws) > 0)
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
    ), common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b
        ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2
    ), links AS (
        SELECT a, b FROM common c JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
        WHERE 100 * c.n >= 75 * (s.n + t.n - c.n)
    ), both_ways AS (
        SELECT a, b FROM links UNION ALL SELECT b, a FROM links
    ), reach AS (
        SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a
    ), smallest AS (
        SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1
    )
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM doc JOIN smallest USING (doc_id) LEFT JOIN sizes USING (doc_id)
    """,
)
def op9_minmax_dedup(spark, folder):
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


@query("op10_toxicity")
def op10_toxicity(spark, folder):
    return toxicity.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _matches(name: str, place: int, pattern: str, value: int, least: int) -> str:
    """The matches of one kind, with the parts between them."""
    pattern = pattern.replace("'", "''")
    return f"""SELECT r, '{name}' AS kind, {place} AS place, {least} AS least, string_split_regex(text, '{pattern}') AS parts,
        regexp_extract_all(text, '{pattern}', 0) AS ms, regexp_extract_all(text, '{pattern}', {value}) AS vs FROM doc"""


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_ASSIGN = rf"""({_either_case("password|passwd|secret|token|api_?key")})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


@query(
    "op11_secret_ledger",
    f"""
    WITH doc AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
    ), raw AS (
        {_matches("assign", 0, _ASSIGN, 2, 8)}
        UNION ALL {_matches("access", 1, "AKIA[A-Z0-9]+", 0, 16)}
        UNION ALL {_matches("hex", 2, "[0-9a-f]+", 0, 32)}
    ), each AS (
        SELECT r, kind, place, least, len(ms[k]) AS width, len(vs[k]) AS value,
               sum(len(parts[k]) + len(ms[k])) OVER (PARTITION BY r, kind ORDER BY k) AS until
        FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS k FROM raw)
    ), named AS (
        SELECT r, kind, until - width AS start, place, kind || ':' || (until - width) || ':' || until AS span
        FROM each WHERE value >= least
    ), found AS (
        SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, place) AS spans
        FROM named GROUP BY r
    )
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
           coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM doc LEFT JOIN found USING (r)
    """,
)
def op11_secret_ledger(spark, folder):
    return secret_scan.scanned_report(table(spark, folder, "documents"))


@query("op12_merge_path_alignment")
def op12_merge_path_alignment(spark, folder):
    return alignment.report(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def _lloyd(rounds: int) -> str:
    """Rounds of assignment (d, a) and new centroids (c) in SQL; integers stay exact."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""d{t} AS (
        SELECT r, c, sum((x.v - c.v) * (x.v - c.v)) AS dist FROM comps x JOIN c{t} c ON x.i = c.i GROUP BY r, c
    ), a{t} AS (
        SELECT r, c, dist FROM d{t} QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, c) = 1
    )""")
        if t < rounds:
            steps.append(f"""m{t} AS (
        SELECT c, i, sum(v) AS s, count(*) AS n FROM a{t} JOIN comps USING (r) GROUP BY c, i
    ), c{t + 1} AS (
        SELECT c, i, CASE WHEN n IS NULL THEN v ELSE (s - ((s % n) + n) % n) // n END AS v FROM c{t} LEFT JOIN m{t} USING (c, i)
    )""")
    return ", ".join(steps)


@query(
    "op13_ns_bounds_clusters",
    f"""
    WITH kept AS (
        SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)::BIGINT) AS x
        FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
    ), comps AS (
        SELECT r, i, x[i] AS v FROM (SELECT r, x, unnest(range(1, 65)) AS i FROM kept)
    ), first AS (
        SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x FROM kept WHERE vec_id IS NOT NULL
        QUALIFY c < 16
    ), c0 AS (
        SELECT c, i, x[i] AS v FROM (SELECT c, x, unnest(range(1, 65)) AS i FROM first)
    ), {_lloyd(3)}, digest AS (
        SELECT c, sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY c
    )
    SELECT vec_id, c::INTEGER AS cluster, dist::BIGINT AS distance, (sum(dist) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
           (sum(dist) OVER ())::BIGINT AS inertia, centroid_sha256
    FROM a3 JOIN kept USING (r) JOIN digest USING (c)
    """,
)
def op13_ns_bounds_clusters(spark, folder):
    return clustering.report(table(spark, folder, "embeddings"))
