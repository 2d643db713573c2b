"""CSV scan with a quarantine.

Every column is scanned as text, so nothing is lost to a failed parse.  One
pass casts the texts to their declared types, sets apart the rows that don't
fit, and counts why while it writes: malformed records (another number of
columns than declared) and, per typed column, values its type can't take.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from ..functions import columns as fx
from .io import layer_path
from .measured import write_observed

BAD, RECORD, REASONS = "__bad", "__record", "__reasons"


def land_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType, root: str, name: str, **options) -> DataFrame:
    """Land CSV files (header row, columns in the order of ``schema``) under ``root``/``name``; the good rows, typed.

    The bad rows are ``quarantined``; the counts are stored as checks:
    ``landed``, ``good`` and ``malformed`` rows, ``uncastable`` values per column
    that isn't text.  An empty field is null, which every type takes.
    """
    record = StructField(RECORD, StringType())
    texts = StructType([*[StructField(f.name, StringType()) for f in schema.fields], record])
    reader = spark.read.schema(texts).options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD)
    rows = reader.options(**options).csv(list(paths) if not isinstance(paths, str) else paths)
    typed = [f for f in schema.fields if not isinstance(f.dataType, StringType)]
    malformed = F.col(RECORD).isNotNull()
    # to tell a failed cast from a null the text is looked at before it is cast
    failed = {f.name: ~malformed & F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in typed}
    why = F.array_compact(F.array(F.when(malformed, "malformed"), *[F.when(x, c) for c, x in failed.items()]))
    texts_again = F.to_csv(F.struct(*[F.col(f.name) for f in schema.fields]))
    seen = rows.withColumn(REASONS, why).withColumn(BAD, F.size(REASONS) > 0)
    seen = seen.withColumn(RECORD, F.when(F.col(BAD), F.coalesce(F.col(RECORD), texts_again)))
    out = seen.select(*[F.when(~F.col(BAD), F.col(f.name).try_cast(f.dataType)).alias(f.name) for f in schema.fields], RECORD, REASONS, BAD)
    checks = {("landed", None): F.count(F.lit(1)), ("good", None): fx.count_where(~F.col(BAD)),
              ("malformed", None): fx.count_where(F.array_contains(REASONS, "malformed"))}
    checks |= {("uncastable", f.name): fx.count_where(F.array_contains(REASONS, f.name)) for f in typed}
    write_observed(out, root, name, name.rpartition("/")[2], checks, partition_by=[BAD])
    return _landed(spark, root, name, schema).where(~F.col(BAD)).select(*schema.fieldNames())


def quarantined(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``(__record, __reasons)`` of the rows that didn't fit: their line, and ``malformed`` or the columns at fault."""
    return _landed(spark, root, name, StructType([])).where(BAD).select(RECORD, REASONS)


def _landed(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    own = [StructField(RECORD, StringType()), StructField(REASONS, ArrayType(StringType())), StructField(BAD, BooleanType())]
    return spark.read.schema(StructType([*schema.fields, *own])).parquet(layer_path(root, name))
