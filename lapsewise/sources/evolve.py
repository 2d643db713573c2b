"""Layers whose schema has grown: slices replaced alone, older ones read by today's contract.

A layer is Parquet in one folder per slice (partition columns).  Slices written
under an older schema stay as they are; reading by a contract fills the columns
they lack with nulls and widens their types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StructType, TimestampNTZType)

from .io import layer_path

#: The types a column may have had before, by what it is now.
WIDER: dict[type, tuple[type, ...]] = {
    ShortType: (ByteType,), IntegerType: (ByteType, ShortType), LongType: (ByteType, ShortType, IntegerType),
    DoubleType: (FloatType, ByteType, ShortType, IntegerType), TimestampNTZType: (DateType,),
}


def widens(old: DataType, new: DataType) -> bool:
    """Whether every value of ``old`` is a value of ``new``."""
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return old == new or type(old) in WIDER.get(type(new), ())


def misfits(old: StructType, contract: StructType) -> list[str]:
    """Why rows of ``old`` can't be read by ``contract``: columns it lacks, and types that don't widen."""
    types = {f.name: f.dataType for f in contract.fields}
    return [f"{f.name}: not in the contract" if f.name not in types else f"{f.name}: {f.dataType.simpleString()} is not within {types[f.name].simpleString()}"
            for f in old.fields if f.name not in types or not widens(f.dataType, types[f.name])]


def reconcile(df: DataFrame, contract: StructType) -> DataFrame:
    """``df`` with the contract's columns, order and types; missing columns are null, any misfit is an error."""
    if wrong := misfits(df.schema, contract):
        raise ValueError("; ".join(wrong))
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in contract.fields])


def replace_slices(df: DataFrame, root: str, name: str, by: list[str], contract: StructType | None = None) -> None:
    """Write ``df`` as the slices ``by`` that it has rows of, and leave the layer's other slices alone.

    The write is a dynamic partition overwrite, committed by Spark when all
    tasks have ended.  ``df`` must not be read from the slices it replaces.
    """
    rows = df if contract is None else reconcile(df, contract)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(layer_path(root, name))


def read_evolved(spark: SparkSession, root: str, name: str, contract: StructType) -> DataFrame:
    """The whole layer by ``contract``; a slice that doesn't fit it is an error."""
    path = layer_path(root, name)
    for schema in slice_schemas(spark, path):
        if wrong := misfits(schema, contract):
            raise ValueError("; ".join(wrong))
    return spark.read.schema(contract).parquet(path).select(*contract.fieldNames())


def slice_schemas(spark: SparkSession, path: str) -> list[StructType]:
    """The distinct schemas of the layer's slices, without the partition columns; a footer is read per slice folder."""
    schemas: list[StructType] = []
    for folder in sorted({file.rpartition("/")[0] for file in spark.read.parquet(path).inputFiles()}):
        found = spark.read.option("basePath", folder).parquet(folder).schema
        if found not in schemas:
            schemas.append(found)
    return schemas
