"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Spark's own file listing, so any file system works."""
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return not listing.select("path").isEmpty()
    except Exception as e:  # the class differs between classic and Connect sessions
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise


def require_path(spark: SparkSession, path: str) -> None:
    """A directory of part files is a legal table; a missing or empty path is not."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """CSV with header and a declared schema; unparsable fields become null, NaN becomes null.

    With ``keep_corrupt`` the text of a malformed line is kept in ``_corrupt_record``.
    """
    require_path(spark, path)
    declared = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]) if keep_corrupt else schema
    reader = spark.read.schema(declared).option("header", True).option("mode", "PERMISSIVE")
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return nan_to_null(reader.csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    require_path(spark, path)
    return spark.read.parquet(path)


def nan_to_null(df: DataFrame) -> DataFrame:
    """One kind of missing value: Spark's averages and counts treat NaN as a number."""
    doubles = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.when(~F.isnan(_q(c)), F.col(_q(c))).alias(c) if c in doubles else F.col(_q(c)) for c in df.columns]
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Directory of part files; parents are created by the file system."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_batches(df: DataFrame, path: str, batch_col: str = "batch") -> None:
    """One directory ``batch=N`` with one file per slice; a slice has a fixed number of rows."""
    df.repartition(batch_col).write.mode("overwrite").partitionBy(batch_col).parquet(path)


def write_record(spark: SparkSession, record: dict, path: str) -> None:
    """A flat dict (metadata, parameters) as one JSON line."""
    literals = [F.lit(v).alias(k) for k, v in record.items()]
    spark.range(1).select(*literals).coalesce(1).write.mode("overwrite").json(path)


def read_record(spark: SparkSession, path: str) -> dict:
    require_path(spark, path)
    return spark.read.json(path).first().asDict(recursive=True)


def literal_rows(spark: SparkSession, columns: dict[str, str], rows: Sequence[Sequence]) -> DataFrame:
    """A small result table of fixed size, built from literals inside the plan."""
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, columns.items())]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _q(name: str) -> str:
    return f"`{name}`"
