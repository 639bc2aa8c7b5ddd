"""Secret scanning over an incremental ledger of content-addressed blobs.

Every version of a text is named by the SHA-256 of its bytes. The ledger holds which blob
was scanned under which rule version, and what was found. An ingest scans only pairs of
blob and rule version that the ledger lacks, whatever number of paths and versions hold
the blob, and findings are joined back to all paths. Everything is DataFrame functions.

A null text is the empty blob. Repeated rows are paths of one blob and stay apart in the
result. A null path is reported like any other. Empty tables give empty results. A new
version of a rule is scanned over all blobs again, other rules are not. Spans count code
points, the end exclusive; spans of one kind do not overlap, those of different kinds may.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.session import stored, work_path

FINDINGS = "blob string, rule string, kind string, start long, end long"
SCANNED = "blob string, rule string"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose last ``group`` is long enough.

    ``group`` 0 is the whole match; another one must end where the match ends.
    """

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns and lengths of the base kinds, in the order of the report.
# Runs are matched with their least length where that finds the same spans, as a shorter
# run holds no match. Keywords spell out both cases, which keeps other letters unfolded.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE_RULES = (
    Rule("assign", 1, ASSIGN, 6, 2),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 24),
)
RULES = (*BASE_RULES, Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0))


def blob_name(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


class Ledger:
    """Scanned pairs and findings as Parquet folders below ``path``, only ever appended to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, path: str | None = None) -> Ledger:
        """An empty ledger, by default at a new place in the shared folder."""
        made = cls(spark, path or work_path(spark, "blob-ledger"))
        spark.createDataFrame([], SCANNED).write.parquet(f"{made.path}/scanned")
        spark.createDataFrame([], FINDINGS).write.parquet(f"{made.path}/findings")
        return made

    def scanned(self) -> DataFrame:
        return self.spark.read.schema(SCANNED).parquet(f"{self.path}/scanned")

    def findings(self) -> DataFrame:
        """Each finding once, also where an ingest was broken off and repeated."""
        return self.spark.read.schema(FINDINGS).parquet(f"{self.path}/findings").distinct()

    def ingest(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> int:
        """Scan the texts of ``versions`` under the rules not yet applied to them.

        ``versions`` needs the column text. The text of a blob moves once, whatever the
        number of its copies: each task sends one copy. Returns the number of scanned
        pairs.
        """
        text = F.coalesce(F.col("text"), F.lit(""))
        blobs = versions.select(blob_name(F.col("text")).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
        known = self.scanned().groupBy("blob").agg(F.collect_set("rule").alias("known"))  # at most the rules
        blobs = blobs.join(known, "blob", "left")
        wanted = F.array_except(F.array(*[F.lit(r.name) for r in rules]), F.coalesce("known", F.array().cast("array<string>")))
        pending = blobs.select("blob", "text", wanted.alias("todo")).where(F.size("todo") > 0)

        hits = pending.select("blob", "todo", F.explode(_pieces(rules)).alias("p")).select("blob", "todo", "p.*")
        hits = stored(hits, "blob-hits")
        _placed(hits.where("rule is not null")).write.mode("append").parquet(f"{self.path}/findings")
        pairs = hits.where("rule is null").select("blob", F.explode("todo").alias("rule"))
        pairs.write.mode("append").parquet(f"{self.path}/scanned")  # last: until then nothing counts as scanned
        return pairs.count()


def _pieces(rules: tuple[Rule, ...]) -> Column:
    """A row for the blob itself and one for each match: what lies before it, and its lengths."""
    kinds = []
    for rule in rules:
        pattern = F.lit(rule.pattern)
        found = F.regexp_extract_all("text", pattern, F.lit(0))

        def row(gap: Column, hit: Column, rule: Rule = rule) -> Column:
            tail = F.regexp_extract(hit, rule.pattern, rule.group) if rule.group else hit
            return F.struct(
                F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"), F.length(gap).alias("gap"), F.length(hit).alias("size"), (F.length(tail) >= rule.least).alias("kept")
            )

        # The piece after the last match pairs with no match and is left out.
        gaps = F.split("text", rule.pattern, -1)
        matched = F.filter(F.zip_with(gaps, found, lambda g, h: F.when(h.isNotNull(), row(g, h))), lambda x: x.isNotNull())
        ordered = F.transform(matched, lambda x, i: x.withField("place", i))
        applies = F.array_contains("todo", rule.name) & F.col("text").rlike(rule.pattern)
        kinds.append(F.when(applies, ordered))
    mark = F.struct(
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("kind"), F.lit(0).alias("gap"), F.lit(0).alias("size"), F.lit(False).alias("kept"), F.lit(0).alias("place")
    )
    empty = F.array().cast("array<struct<rule:string,kind:string,gap:int,size:int,kept:boolean,place:int>>")
    return reduce(F.concat, [F.coalesce(k, empty) for k in kinds], F.array(mark))


def _placed(hits: DataFrame) -> DataFrame:
    """Positions from the lengths of all gaps and matches before, within one blob and rule."""
    before = Window.partitionBy("blob", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.col("size")).cast("long")).over(before)
    placed = hits.select("blob", "rule", "kind", "size", "kept", end.alias("end")).where("kept")
    return placed.select("blob", "rule", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def _order(rules: tuple[Rule, ...]) -> Column:
    order = F.lit(len(rules))
    for place, rule in enumerate(rules):
        order = F.when(F.col("kind") == rule.kind, place).otherwise(order)
    return order


def report(paths: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, n_<kind>..., spans, base_spans) of every row of ``paths``.

    Findings are gathered once a blob, under the rule versions asked for, and then joined
    to its paths; a blob that a third of the paths share is one row on that side.
    """
    asked = [r.name for r in rules]
    found = ledger.findings().where(F.col("rule").isin(asked))
    base = [r.kind for r in BASE_RULES]
    entry = F.struct("start", _order(rules).alias("order"), F.concat_ws(":", "kind", "start", "end").alias("span"), "kind")
    gathered = found.groupBy("blob").agg(F.array_sort(F.collect_list(entry)).alias("found"))
    spans = lambda rows: F.concat_ws(",", F.transform(rows, lambda x: x["span"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in rules]
    blobs = gathered.select("blob", *counts, spans(F.col("found")).alias("spans"), spans(F.filter("found", lambda x: x["kind"].isin(base))).alias("base_spans"))
    named = paths.select("doc_id", blob_name(F.col("text")).alias("blob"))
    filled = named.join(blobs, "blob", "left")
    numbers = [F.coalesce(f"n_{r.kind}", F.lit(0).cast("long")).alias(f"n_{r.kind}") for r in rules]
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("spans", "base_spans")]
    return filled.select("doc_id", "blob", *numbers, *texts)


def redact(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every text that holds findings rewritten and its n_chars set anew.

    Overlapping spans are merged and replaced by ``mark``; other texts stay as they are.
    """
    found = ledger.findings().where(F.col("rule").isin([r.name for r in rules]))
    by_place = Window.partitionBy("blob").orderBy("start", "end")
    reach = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    opened = found.select("blob", "start", "end", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("long").alias("new"))
    runs = opened.withColumn("run", F.sum("new").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("blob", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    previous = F.coalesce(F.lag("end").over(Window.partitionBy("blob").orderBy("start")), F.lit(0))
    gaps = merged.select("blob", "start", "end", previous.cast("long").alias("from"))
    cuts = gaps.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct(F.col("from"), F.col("start")))).alias("cuts__"), F.max("end").alias("rest__"))
    named = docs.withColumn("blob__", blob_name(F.col("text"))).join(cuts.withColumnRenamed("blob", "blob__"), "blob__", "left")
    kept = F.transform("cuts__", lambda c: F.concat(F.col("text").substr((c["from"] + 1).cast("int"), (c["start"] - c["from"]).cast("int")), F.lit(mark)))
    rest = F.col("text").substr((F.col("rest__") + 1).cast("int"), F.length("text"))
    text = F.when(F.col("cuts__").isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), rest))
    fields = {f.name: f.dataType for f in docs.schema}
    columns = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    done = named.select(*columns, F.col("cuts__").isNotNull().alias("changed__"))
    if "n_chars" in fields:
        done = done.withColumn("n_chars", F.when(F.col("changed__"), F.length("text").cast(fields["n_chars"])).otherwise(F.col("n_chars")))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])
