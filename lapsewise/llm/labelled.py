"""Bounded, documented samples of labelled documents for the operators that learn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import utf8


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, id_col: str = "doc_id",
           text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, y, part, text)`` of about ``per_class`` labelled documents of each class, and all label counts.

    The sample is drawn from the labels by a hash of the id, so its size is
    bounded before any text is read, and it is broadcast to the documents.
    Null labels and ids teach nothing; an id with several labels takes the
    largest, and of several rows of an id the one of the smallest text hash
    is taken, so the rows are bounded too.  ``part`` is a hash from 0 to 3.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")) \
        .where("doc_id is not null and y in (0, 1)").where(learn).groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20))
    share = F.lit(0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, F.lit(-(-per_class * (1 << 20) // n))).otherwise(share)
    drawn = known.where(draw < share).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(4)).cast("int"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    found = texts.join(F.broadcast(drawn), "doc_id")  # drawn: per_class rows a class, about
    one = found.groupBy("doc_id", "y", "part").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.select("doc_id", "y", "part", "text"), counts
