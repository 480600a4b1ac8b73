"""Secret scan over an incremental blob ledger, in DataFrame operations only.

Every text is addressed by the SHA-256 of its bytes (its blob).  The ledger
holds the (blob, rule version) pairs that have been scanned; only pairs that
it lacks are scanned, each once however many rows hold the blob, and findings
are joined back to all rows.  Findings are written before the ledger, so a
run that breaks off between the two scans again and loses nothing.

Defined cases: a null text is the empty text; several rows with one id are
versions of one path and each gets its own result row; null ids stay null;
an empty table gives no rows; other columns of the input are ignored; a very
long text is scanned whole, and its matches are rows until they are put
together again, so work is linear in their number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from memloom.llm.common import bounded_broadcast, scratch, written


@dataclass(frozen=True)
class Rule:
    """kind, the pattern, the group that must have at least min_chars, a cheap test that every match passes."""

    kind: str
    pattern: str
    group: int
    min_chars: int
    test: str


# The base rules, in the order in which kinds are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
        r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]""",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, r"AKIA[A-Z0-9]{12}"),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, r"[0-9a-f]{32}"),
)
BASE_VERSION = "base-1"

SPAN = "array<struct<start:int,kind:int,end:int>>"


def rule_matches(text: Column, rule: Rule, kind: int) -> Column:
    """The rule's leftmost non-overlapping matches in order: kind, lengths of the gap before, the match and its value.

    The gaps and the matches cover the text up to its last match.
    """
    regex = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, regex, F.lit(rule.group)).alias("value"),
    )
    long = lambda c: F.char_length(c).cast("long")
    found = F.transform(parts, lambda p, k: F.struct(F.lit(kind).alias("kind"), k.alias("k"), long(p["gap"]).alias("gap"), long(p["hit"]).alias("hit"), long(p["value"]).alias("value")))
    return F.when(text.rlike(rule.test), found)


def scan(texts: DataFrame, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """(blob, text) to (blob, spans in code points), for texts with at least one span; a repeated blob is scanned once."""
    any_hit = F.lit(False)
    for rule in rules:
        any_hit = any_hit | F.col("text").rlike(rule.test)
    once = texts.where(any_hit).select("blob", "text").dropDuplicates(["blob"])
    none = F.array().cast("array<struct<kind:int,k:int,gap:bigint,hit:bigint,value:bigint>>")
    matches = F.concat(*[F.coalesce(rule_matches(F.col("text"), rule, k), none) for k, rule in enumerate(rules)])
    rows = once.select("blob", F.explode(matches).alias("m")).select("blob", "m.*").where("hit is not null")
    # Running sums of gaps and matches are the offsets; a window holds one text's matches of one rule.
    end = F.sum(F.col("gap") + F.col("hit")).over(Window.partitionBy("blob", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("end", end)
    least = F.lit(False)
    for k, rule in enumerate(rules):
        least = least | ((F.col("kind") == k) & (F.col("value") >= rule.min_chars))
    span = F.struct((F.col("end") - F.col("hit")).cast("int").alias("start"), "kind", F.col("end").cast("int").alias("end"))
    return placed.where(least).groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))


class BlobLedger:
    """Scanned (blob, rule version) pairs and their findings, as tables below one shared path."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch(spark, "ledger")

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def scanned(self, version: str) -> DataFrame:
        return self._table("scanned", "blob binary, version string").where(F.col("version") == version).select("blob")

    def findings(self, version: str) -> DataFrame:
        """One row for each blob with findings."""
        rows = self._table("findings", f"blob binary, spans {SPAN}, version string")
        return rows.where(F.col("version") == version).drop("version").dropDuplicates(["blob"])

    def ingest(self, docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES, version: str = BASE_VERSION) -> DataFrame:
        """Scans the blobs of docs that the version has not seen; returns (doc_id, blob) of all rows."""
        text = F.coalesce(F.col("text"), F.lit(""))
        rows = docs.select("doc_id", text.alias("text")).withColumn("blob", F.unhex(F.sha2("text", 256)))
        paths = rows.select("doc_id", "blob")
        first = paths.groupBy("blob").agg(F.min("doc_id").alias("first_id"))
        unseen = written(first.join(self.scanned(version), "blob", "left_anti"), "unseen")
        once = bounded_broadcast(unseen.withColumnRenamed("blob", "new_blob"), 100)
        fresh = rows.join(
            once, (F.col("blob") == F.col("new_blob")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi"
        )
        scan(fresh, rules).withColumn("version", F.lit(version)).write.mode("append").parquet(f"{self.path}/findings")
        unseen.select("blob", F.lit(version).alias("version")).write.mode("append").parquet(f"{self.path}/scanned")
        return paths


def span_text(spans: Column, rules: tuple[Rule, ...] = BASE_RULES) -> Column:
    """kind:start:end of every span, joined by commas."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    one = lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def scan_documents(docs: DataFrame, ledger: BlobLedger, rules: tuple[Rule, ...] = BASE_RULES, version: str = BASE_VERSION) -> DataFrame:
    """(doc_id, blob, spans) of every row, from the ledger after it has taken docs in."""
    paths = ledger.ingest(docs, rules, version)
    none = F.expr(f"cast(array() as {SPAN})")
    return paths.join(ledger.findings(version), "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))


def secret_report(spark: SparkSession, docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """The contract's columns, derived from the spans of scan_documents."""
    found = scan_documents(docs, BlobLedger(spark, ledger_path))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    text = span_text(F.col("spans"))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{rule.kind}") for k, rule in enumerate(BASE_RULES)],
        F.sha2(text, 256).alias("base_sha256"),
        text.alias("spans"),
    )
