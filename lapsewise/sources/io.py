"""Scans and sinks (CSV landing zone, Parquet stage layers, temp views)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from . import schemas


def read_raw(spark: SparkSession, path: str, schema: StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header row.  ``schema`` may be a StructType, a DDL string or
    the name of a raw domain table; ``None`` falls back to inference (one extra
    pass over the file — profiling only)."""
    reader = spark.read.option("header", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    if isinstance(schema, str) and schema in schemas.RAW:
        schema = schemas.RAW[schema]
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def layer_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_layer(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(layer_path(root, name))


def write_layer(df: DataFrame, root: str, name: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> str:
    """Overwrite sink for one stage table.  A stage never overwrites the path
    it reads (Parquet cannot), so callers give every stage its own layer."""
    path = layer_path(root, name)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "parquet":  # layers are written once and read by column; Spark's default codec writes more bytes
        writer = writer.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
