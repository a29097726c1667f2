"""A corpus pipeline over ``documents``: toxicity, near-duplicates, benchmark leaks, source mixture, token records.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the next one's
docs. All but the last return the columns of ``documents``. A stage works on all rows that it is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelspark.llm import decontaminate, mixing, near_copies, records, toxicity
from voxelspark.llm.common import discard, materialize, table


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity grammar predicts to be toxic (score 0.5 or more). Null and empty texts are civil;
    extra columns stay as they are; repeated rows are judged alike; without labels the grammar's seeds alone judge."""
    model = toxicity.train_on(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.keep_below(docs, model, 0.5)


def _kept(docs: DataFrame) -> Column:
    """Every column of a row in one, so that none clashes with a stage's own."""
    return F.struct(*docs.columns).alias("kept")


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (Jaccard similarity of 0.8 or more over five-word shingles; the
    SimHash operator's links and those beyond its reach, all verified, see ``near_copies``), the one with the smallest
    doc_id, null ids last. Of rows with the same id and text one stays. Texts without words are copies of each other. Extra
    columns stay as they are; an empty table gives an empty one."""
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))).cast("binary")))
    found = near_copies.near_copies(docs.select(key.alias("row_key"), "doc_id", "text"))
    best = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"))
    first = best.select(F.col("first.row_key").alias("row_key"))
    copy = F.row_number().over(Window.partitionBy("row_key").orderBy("row_key"))
    chosen = docs.select(key.alias("row_key"), _kept(docs)).join(first, "row_key", "left_semi")
    return chosen.withColumn("copy", copy).where("copy = 1").select("kept.*")


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which a window of a benchmark item occurs, of an item without an id too. A null text has none.
    Extra columns stay as they are; an empty benchmark drops nothing."""
    key = F.xxhash64("doc_id", "text")
    found = decontaminate.contamination(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    leaks = found.where("size(hit_spans) > 0").select(F.col("doc_id").alias("row_key")).distinct()
    return docs.select(key.alias("row_key"), _kept(docs)).join(leaks, "row_key", "left_anti").select("kept.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture reads them: frequent sources less than wholly, rare ones up to four times. A null
    source is a source of its own; see ``mixing.mixed_rows``."""
    return mixing.mixed_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records of every row, read back: doc_id, start, n_tokens, ids_crc32. A null text is the end id alone; null ids
    come first; an empty table gives no rows."""
    return records.token_records(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", keep_civil),
    ("near_duplicates", keep_one_of_copies),
    ("decontamination", keep_unleaked),
    ("mixing", mix_sources),
    ("token_records", write_tokens),
]

#: SQL can express neither the grammar's learning, nor XXH64, nor the tokenizer; the tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage gives. A stage's table is deleted once the next one is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
