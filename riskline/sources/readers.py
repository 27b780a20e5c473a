"""Table readers (A1): CSV with an explicit schema, Parquet, and the test tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Normalise NaN to NULL in floating columns (Spark counts NaN as a value).

    Missing data is NULL everywhere in this library; a source that may carry
    NaN is passed through here once, at load.
    """
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (columns or floating) if c in floating]
    if not cols:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in cols})


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header: bool = True,
    null_value: str = "NA",
    normalise_nan: bool = True,
) -> DataFrame:
    """CSV scan with header. Give ``schema`` in production: schema inference
    reads the data twice and types a column holding ``NA`` as a string."""
    reader = spark.read.option("header", header).option("nullValue", null_value)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    return nan_to_null(df) if normalise_nan else df


def read_parquet(spark: SparkSession, path: str, normalise_nan: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return nan_to_null(df) if normalise_nan else df


def load_data(spark: SparkSession, path: str, fmt: str | None = None, **kwargs) -> DataFrame:
    """One reader facade: picks CSV or Parquet from ``fmt`` or the path suffix."""
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt == "csv":
        return read_csv(spark, path, **kwargs)
    if fmt == "parquet":
        return read_parquet(spark, path, **kwargs)
    raise ValueError(f"unsupported format {fmt!r}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table of ``/root/testdata/sf*/`` (read as is: it holds no NaN)."""
    if name not in TEST_TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
