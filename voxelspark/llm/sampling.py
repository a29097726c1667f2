"""Bounded samples of labelled texts for training on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Up to this many labels, their counts are sent to all tasks; beyond it, rows meet them by a salted join.
FEW_LABELS = 1000
SALTS = 64
#: Stretches that stand for a text that is too long to be sent whole.
STRETCHES = 16


def labelled_ids(rows: DataFrame, per_label: int, seed: int) -> DataFrame:
    """(doc_id, label) of up to ``per_label`` ids of each label of rows(doc_id, label): the ids with the least hashes. A
    null id or label is left out, and so is an id that has rows of several labels; repeated rows count once.

    Labels' distinct ids are estimated first (HyperLogLog, 1 %), and a threshold on the hash leaves little more than
    ``per_label`` ids of each to be made distinct and ranked, however many there are and however often one recurs: as many
    more as make it next to impossible that fewer pass.
    """
    order = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 1)
    ids = rows.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "label", order.alias("o"))
    counts = materialize(ids.groupBy("label").agg(F.approx_count_distinct("doc_id", 0.01).alias("n")), "label-counts")
    if counts.limit(FEW_LABELS + 1).count() <= FEW_LABELS:
        counted = ids.join(F.broadcast(counts), "label")
    else:
        salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        counted = ids.withColumn("salt", F.pmod("o", F.lit(SALTS)).cast("int")).join(salted, ["label", "salt"]).drop("salt")
    enough = 1.15 * (per_label + 8 * per_label**0.5 + 32)
    few = counted.where(F.col("o") < enough / F.col("n") * float(1 << 63)).select("doc_id").distinct()
    once = ids.join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"), F.min("o").alias("o")).where("label = other")
    rank = F.row_number().over(Window.partitionBy("label").orderBy("o", "doc_id"))
    return once.withColumn("r", rank).where(F.col("r") <= per_label).select("doc_id", "label")


def stretches(text: str, text_bytes: int) -> Column:
    """The text in column ``text``, or, where it has over ``text_bytes`` bytes, lines of ``STRETCHES`` equal stretches of at most
    that many bytes in all, spread evenly from its start to its end."""
    width = max(1, text_bytes // (4 * STRETCHES) - 1)  # characters of up to four bytes, and a line's end
    step = (F.length(text) - width) / F.lit(STRETCHES - 1)
    parts = F.transform(F.sequence(F.lit(0), F.lit(STRETCHES - 1)), lambda i: F.substring(F.col(text), F.greatest(F.lit(0), F.floor(i * step)).cast("int") + 1, F.lit(width)))
    return F.when(F.octet_length(text) <= text_bytes, F.col(text)).otherwise(F.array_join(parts, "\n"))


def texts_of(docs: DataFrame, chosen: DataFrame, text_bytes: int | None = None) -> DataFrame:
    """(doc_id, label, text) of the ids of chosen(doc_id, label), labels x per_label rows at most, which are sent to the tasks
    that read docs(doc_id, text). One row an id: of several texts the least. With ``text_bytes`` longer texts come as
    stretches of their whole length."""
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return found if text_bytes is None else found.select("doc_id", "label", stretches("text", text_bytes).alias("text"))


def labelled_sample(docs: DataFrame, label: Column, keep: Column, per_label: int, seed: int, text_bytes: int | None = None) -> DataFrame:
    """(doc_id, label, text) of up to ``per_label`` ids of each label, among rows of docs where ``keep`` holds. The choice
    reads ids and labels alone."""
    chosen = labelled_ids(docs.where(keep).select("doc_id", label.alias("label")), per_label, seed)
    return texts_of(docs, chosen, text_bytes)
