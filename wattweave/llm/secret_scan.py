"""Secret scans with an incremental blob ledger, in DataFrame functions only.

A text is addressed by its content (SHA-256): equal texts, be they copies, versions that were
taken back or rows repeated, are one blob. The ledger is a table in the shared folder with a row for each
blob and rule version that was scanned, and the spans found (none as a rule). A scan looks up
which pairs of blob and rule version the ledger lacks, runs only these rules over only these
blobs, appends a row for each, and joins the findings back to all paths that have, or had, the blob.
A row is complete in itself: after a scan that broke off, the next one does what is missing.

Matches are leftmost and do not overlap, as a regular expression finds them; only then are those left out
whose value is too short. Positions are code points from 0, the end is exclusive. They are the
running sums of the lengths between and of the matches, so the work is linear in the text.

Null texts count as empty: a blob without findings. Texts are scanned whole, however long. Many
copies of a text cost a hash each: they are reduced to one before the shuffle, and a
blob's findings are joined to its paths by joins that Spark can split. An empty table gives
an empty result. Rows without an id have findings as others do. Columns other than those named are not looked at.
"""

from __future__ import annotations

import posixpath
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattweave.llm.bitmap import perhaps_in
from wattweave.session import durable, shared_dir


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of the ``value`` group (0: the match).

    ``quick`` is a pattern with the same matches of that length that passes over shorter ones.
    ``version`` rises whenever the pattern or the length changes, so that all blobs are
    scanned for it again.
    """

    name: str
    version: int
    pattern: str
    least: int
    value: int = 0
    quick: str = ""


# The three kinds of the base, in their order.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 16, quick="AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]+", 32, quick="(?<![0-9a-f])[0-9a-f]{32,}+"),
)


class Ledger:
    """The scanned pairs of blob and rule version, with what was found."""

    SCHEMA = "blob binary, rule string, version int, spans array<struct<start:int,end:int>>"

    def __init__(self, spark: SparkSession, path: str | None = None):
        """``path`` names a ledger to go on with; without it a new one is made."""
        self.spark = spark
        self.path = path or posixpath.join(shared_dir(spark), f"ledger-{uuid.uuid4().hex}")
        self._empty = path is None
        if path is None:
            spark.createDataFrame([], self.SCHEMA).write.parquet(self.path)

    def rows(self, rules: tuple[Rule, ...] | None = None) -> DataFrame:
        """All rows, or those of the present versions of the rules."""
        rows = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        if rules is None:
            return rows
        known = [(F.col("rule") == r.name) & (F.col("version") == r.version) for r in rules]
        return rows.where(_any(known))

    def is_new(self) -> bool:
        """Whether nothing was scanned so far."""
        if self._empty:
            self._empty = self.rows().isEmpty()
        return self._empty

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)
        self._empty = False


def _any(conditions: list[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found


def _address(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _lengths(rule: Rule) -> Column:
    """(gap, width, value) of each match of the rule in ``text``: the lengths before it, of it, and of its value."""
    pattern = rule.quick or rule.pattern
    lengths = lambda texts: F.transform(texts, F.length)
    matches = lengths(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    values = lengths(F.regexp_extract_all("text", F.lit(pattern), F.lit(rule.value))) if rule.value else matches
    gaps = F.slice(lengths(F.split("text", pattern, -1)), F.lit(1), F.size(matches))
    named = F.arrays_zip(gaps.alias("gap"), matches.alias("width"), values.alias("value"))
    kind = "array<struct<gap:int,width:int,value:int>>"
    wanted = F.array_contains("rules", rule.name) & F.col("text").rlike(pattern)
    return F.when(wanted, named.cast(kind)).otherwise(F.array().cast(kind))


def _spans(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of (blob, text, rules): one for each of the rules asked for."""
    each = [
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least"), _lengths(r).alias("found"))
        for r in rules
    ]
    rows = blobs.select("blob", "rules", F.explode(F.array(*each)).alias("scan")).where("array_contains(rules, scan.rule)")
    rows = rows.select("blob", "scan.rule", "scan.version", "scan.least", F.posexplode_outer("scan.found").alias("k", "m"))
    until = Window.partitionBy("blob", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("m.gap") + F.col("m.width")).over(until).cast("int"))
    span = F.struct((F.col("end") - F.col("m.width")).alias("start"), "end")
    spans = F.array_sort(F.collect_list(F.when(F.col("m.value") >= F.col("least"), span)))
    return rows.groupBy("blob", "rule", "version").agg(spans.alias("spans"))


def scan(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> Ledger:
    """Scan what the ledger lacks of all texts and rules, and enter it."""
    addressed = versions.select(_address(text_col).alias("blob"), F.coalesce(text_col, F.lit("")).alias("text"))
    every = F.array(*[F.lit(r.name) for r in rules])
    if ledger.is_new():
        blobs = addressed.groupBy("blob").agg(F.first("text").alias("text")).withColumn("rules", every)
    else:
        seen = ledger.rows(rules).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        pending = addressed.select("blob").distinct().join(seen, "blob", "left")
        pending = pending.select("blob", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules"))
        pending = durable(pending.where(F.size("rules") > 0).withColumn("mark", F.xxhash64("blob")))
        near = perhaps_in(addressed.withColumn("mark", F.xxhash64("blob")), pending, "mark")
        blobs = near.groupBy("blob").agg(F.first("text").alias("text")).join(pending.drop("mark"), "blob")
    ledger.add(_spans(blobs, rules))
    return ledger


def findings(
    versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, paths: tuple[str, ...] = ("doc_id",), text_col: str = "text"
) -> DataFrame:
    """The path columns, rule, version, start and end of every finding in every version of a text."""
    named = versions.select(*paths, _address(text_col).alias("__blob"))
    rows = ledger.rows(rules).where(F.size("spans") > 0).dropDuplicates(["blob", "rule", "version"])
    joined = named.join(rows.withColumnRenamed("blob", "__blob"), "__blob")
    return joined.select(*paths, "rule", "version", F.explode("spans").alias("__span")).select(
        *paths, "rule", "version", "__span.start", "__span.end"
    )


def report(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, n_<kind> of each base kind, base_sha256 and spans.

    Spans are ``kind:start:end`` by start, then by the order of the rules, joined by commas.
    """
    base = [r.name for r in RULES]
    rows = ledger.rows(rules).where(F.size("spans") > 0).dropDuplicates(["blob", "rule", "version"])
    place = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.name), F.lit(k))])[F.col("rule")]
    span = lambda s: F.struct(s["start"].alias("start"), place.alias("place"), s["end"].alias("end"), F.col("rule"))
    rows = rows.withColumn("ordered", F.transform("spans", span))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ",")
    counts = [F.sum(F.when(F.col("rule") == name, F.size("spans")).otherwise(0)).alias(f"n_{name}") for name in base]
    of_blob = rows.groupBy("blob").agg(*counts, F.array_sort(F.flatten(F.collect_list("ordered"))).alias("found"))
    of_blob = of_blob.select(
        F.col("blob").alias("__blob"),
        *[f"n_{name}" for name in base],
        F.sha2(text(F.filter("found", lambda s: s["rule"].isin(base))), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
    )
    named = docs.select(F.col(id_col), _address(text_col).alias("__blob"))
    return named.join(of_blob, "__blob", "left").select(
        id_col,
        *[F.coalesce(f"n_{name}", F.lit(0)).cast("long").alias(f"n_{name}") for name in base],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def scanned_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``report`` of the documents over a new ledger."""
    ledger = scan(docs, Ledger(docs.sparkSession), text_col=text_col)
    return report(docs, ledger, id_col=id_col, text_col=text_col)
