"""Secret scans over an incremental, content-addressed blob ledger. DataFrame functions only.

A blob is one distinct text, addressed by its SHA-256. The ledger is a table (blob, rule, findings) in which a row says
that this blob was scanned by this version of this rule, and beside it is a history (path, version, blob) of what every path
has held. A scan takes the versions of paths that it is given, adds those to the history that are not in it, reduces them to
blobs, scans only the (blob, rule version) pairs that the ledger lacks, appends those, and joins the findings back to all
the paths that ever held a blob. Changing a rule changes its version, which is a hash of its definition, so only that rule
runs again over old blobs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path

FINDING = "struct<start:long,stop:long,kind:string>"
#: Matches whose places are summed at once.
BLOCK = 64


def bind(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it, inside lambdas too."""
    return F.element_at(F.transform(F.array(value), then), 1)


@dataclass(frozen=True)
class Rule:
    """kind; a Java pattern without groups that count; the pattern and least length of what must be in a match."""

    kind: str
    pattern: str
    inner: str = ""
    least: int = 0
    order: int = field(default=0, compare=False)

    @property
    def version(self) -> str:
        return self.kind + "@" + hashlib.sha256(repr((self.kind, self.pattern, self.inner, self.least)).encode()).hexdigest()[:12]

    def find(self, text: Column) -> Column:
        """All leftmost, non-overlapping matches as array<struct<start, stop, kind>>, in code points, stop exclusive.

        The text between matches and the matches themselves give each match's place by a running sum of lengths. An array
        that grows is copied, so the sum runs over blocks of ``BLOCK`` matches, inside and between them.
        """
        hits = F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))
        between = F.split(text, self.pattern, -1)
        steps = bind(hits, lambda found: F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda b, h: F.struct(F.length(b).cast("long").alias("gap"), F.length(h).cast("long").alias("len"), h.alias("hit"))))
        blocks = bind(steps, lambda all_: F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int"))), lambda k: F.slice(all_, k * BLOCK + 1, F.lit(BLOCK))))
        none = "cast(array() as array<struct<start:long,stop:long,hit:string>>)"

        def placed(at: Column, block: Column) -> Column:
            step = lambda acc, s: F.struct((acc["at"] + s["gap"] + s["len"]).alias("at"), F.concat(acc["out"], F.array(F.struct((acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["len"]).alias("stop"), s["hit"].alias("hit")))).alias("out"))
            return F.aggregate(block, F.struct(at.alias("at"), F.expr(none).alias("out")), step)

        def add(acc: Column, block: Column) -> Column:
            return bind(placed(acc["at"], block), lambda p: F.struct(p["at"].alias("at"), F.concat(acc["out"], F.array(p["out"])).alias("out")))

        start = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as array<{none[16:-1]}>)").alias("out"))
        walk = F.flatten(F.aggregate(blocks, start, add, lambda acc: acc["out"]))
        kept = F.filter(walk, lambda m: F.length(F.regexp_extract(m["hit"], self.inner, 1)) >= self.least) if self.inner else walk
        found = F.transform(kept, lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop"), F.lit(self.kind).alias("kind")))
        return F.when(text.rlike(self.pattern), found).otherwise(F.expr(f"cast(array() as array<{FINDING}>)"))


_ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+)"""
#: The contract's three kinds, in the order in which ties are listed.
BASE_RULES = (
    Rule("assign", _ASSIGN, r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 8, 0),
    Rule("access", r"AKIA[A-Z0-9]{12,}", order=1),
    Rule("hex", r"[0-9a-f]{32,}", order=2),
)
#: What this scanner finds besides: private-key headers, JSON web tokens, bearer headers and passwords in URLs.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", order=3),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", order=4),
    Rule("bearer", r"(?i:bearer)\x20[A-Za-z0-9._~+/-]{20,}", order=5),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._%-]{1,64}:[^\x20\x09-\x0D/@:]{3,64}@", order=6),
)
RULES = BASE_RULES + MORE_RULES


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"blob string, rule string, findings array<{FINDING}>")


def scan(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger rows that are missing: (blob, rule, findings) of every unseen pair of a blob and a rule version.

    versions(text) may hold any number of rows; equal texts are one blob and are scanned once. A null text is the empty
    blob. Findings are null-free; a blob without secrets has an empty array, so it is not scanned again.
    """
    blobs = versions.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    todo = blobs.join(seen, "blob", "left")
    rows = F.array(*[F.struct(F.lit(r.version).alias("rule"), F.when(~F.coalesce(F.array_contains("seen", r.version), F.lit(False)), r.find(F.col("text"))).alias("findings")) for r in rules])
    return todo.select("blob", F.explode(rows).alias("x")).where("x.findings is not null").select("blob", "x.rule", "x.findings")


HISTORY = "path string, version string, blob string"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, empty where there is none."""
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = jvm.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def update(spark: SparkSession, versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan versions(text) against the ledger at ``path`` (made where there is none), append what is new, return it all."""
    schema = empty_ledger(spark).schema
    scan(versions, _read(spark, path, schema), rules).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def record(spark: SparkSession, versions: DataFrame, path: str) -> DataFrame:
    """Append those (path, version, blob) of versions(path, version, text) to the history at ``path`` that it lacks, and
    return it all. A null path or version is a value like others; repeated rows are one."""
    new = versions.select(F.col("path").cast("string"), F.col("version").cast("string"), blob_id(F.col("text")).alias("blob")).distinct()
    old = _read(spark, path, HISTORY)
    same = new["path"].eqNullSafe(old["path"]) & new["version"].eqNullSafe(old["version"]) & (new["blob"] == old["blob"])
    new.join(old, same, "left_anti").write.mode("append").parquet(path)
    return spark.read.schema(HISTORY).parquet(path)


def findings_by_path(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """paths(..., blob) with ``findings``: what the current rule versions found in the blob, by start and then by the
    rules' order."""
    current = {r.version: r for r in rules}
    rank = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.order))])
    flat = ledger.where(F.col("rule").isin(*current)).where("size(findings) > 0")
    per_blob = flat.groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("found"))
    ordered = F.transform("found", lambda m: F.struct(m["start"].alias("start"), rank[m["kind"]].alias("rank"), m["stop"].alias("stop"), m["kind"].alias("kind")))
    per_blob = per_blob.select("blob", F.array_sort(ordered).alias("findings"))
    none = F.expr("cast(array() as array<struct<start:long,rank:int,stop:long,kind:string>>)")
    return paths.join(per_blob, "blob", "left").withColumn("findings", F.coalesce("findings", none))


def spans_text(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["stop"].cast("string"))), ",")


def scan_history(spark: SparkSession, versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, version, blob, findings) of every version of every path that this scan of versions(path, version, text), or any
    earlier one with the same ``path``, was given: what the current rules found in its blob, by start and then by the rules'
    order. The ledger is at path/ledger, the history at path/history."""
    ledger = update(spark, versions.select("text"), f"{path}/ledger", rules)
    return findings_by_path(record(spark, versions, f"{path}/history"), ledger, rules).select("path", "version", "blob", "findings")


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, path: str | None = None) -> DataFrame:
    """(doc_id, findings) for every row of docs(doc_id, text): its text is a version of the path that its id names, and what it
    holds comes from the history and the ledger at ``path``, or new ones (see ``scan_history``). A null text is the empty
    blob and has no findings; a null id is a path like others; repeated rows are rows of their own; an empty table gives no
    rows."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("doc_id").cast("string").alias("path"), blob_id(F.col("text")).alias("blob"))
    versions = docs.select(F.col("doc_id").cast("string").alias("path"), blob_id(F.col("text")).alias("version"), "text")
    history = scan_history(spark, versions, path or shared_path(spark, "secret-history"), rules)
    history = history.select(F.col("path").alias("of"), F.col("version").alias("blob"), "findings")
    return rows.join(history, (rows["blob"] == history["blob"]) & rows["path"].eqNullSafe(history["of"])).select("doc_id", "findings")
