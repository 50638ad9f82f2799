"""Readers, writers and small table utilities (survey §2.1)."""

from __future__ import annotations

from functools import reduce
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Nested raw event: only the fields the flat layer uses. An explicit schema
# avoids a full inference pass over multi-line JSON and prunes the parse.
_NAME = T.StructType([T.StructField("name", T.StringType())])
_PLAYER = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("minute", T.LongType()),
    T.StructField("second", T.LongType()),
    T.StructField("type", _NAME),
    T.StructField("player", _PLAYER),
    T.StructField("team", _NAME),
    T.StructField("position", _NAME),
    T.StructField("location", T.ArrayType(T.DoubleType())),
    T.StructField("pass", T.StructType([
        T.StructField("length", T.DoubleType()),
        T.StructField("goal_assist", T.BooleanType()),
        T.StructField("shot_assist", T.BooleanType()),
        T.StructField("outcome", _NAME),
    ])),
    T.StructField("shot", T.StructType([
        T.StructField("statsbomb_xg", T.DoubleType()),
        T.StructField("outcome", _NAME),
    ])),
    T.StructField("dribble", T.StructType([T.StructField("outcome", _NAME)])),
    T.StructField("duel", T.StructType([T.StructField("type", _NAME)])),
    T.StructField("tactics", T.StructType([
        T.StructField("lineup", T.ArrayType(T.StructType([T.StructField("player", _PLAYER)]))),
    ])),
    T.StructField("substitution", T.StructType([T.StructField("replacement", _PLAYER)])),
])


def read_events(spark: SparkSession, path: str, schema: T.StructType = RAW_EVENT_SCHEMA,
                multiline: bool = True) -> DataFrame:
    """A1: a directory of JSON event files (one array per file) with a fixed schema."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def with_file_key(df: DataFrame, pattern: str = r"([0-9]+)\.json$", name: str = "match_id",
                  dtype: str = "int") -> DataFrame:
    """A2: derive a key from the source file path; no match gives NULL, not an error."""
    raw = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return df.withColumn(name, F.nullif(raw, F.lit("")).try_cast(dtype))


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A3: Parquet scan; selecting columns here lets Catalyst prune the read schema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, files: int | None = None,
                  partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> str:
    """A4/A5: Parquet sink. ``files`` sets the number of output files with a
    shuffle (``repartition``), so the upstream stages keep their parallelism."""
    if files:
        df = df.repartition(files)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header; give a schema for production reads (inference scans twice)."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> str:
    """CSV sink with header."""
    if files:
        df = df.repartition(files)
    df.write.mode(mode).option("header", True).csv(path)
    return path


def register(df: DataFrame, name: str) -> DataFrame:
    """Named lazy relation (temporary view)."""
    df.createOrReplaceTempView(name)
    return df


def bounded(df: DataFrame, n: int) -> pd.DataFrame:
    """A10: collect a result that is small by design; refuse anything larger."""
    pdf = df.limit(n + 1).toPandas()
    if len(pdf) > n:
        raise ValueError(f"result has more than {n} rows; aggregate before collecting")
    return pdf


def dataset_size(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Number of files and bytes on storage, read from file metadata only."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    r = r.option("recursiveFileLookup", True)
    files = r.load(path).select("length")          # `content` is never read
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes"),
    ).withColumn("mb", F.round(F.col("bytes") / F.lit(1024.0 ** 2), 2)) \
     .withColumn("gb", F.round(F.col("bytes") / F.lit(1024.0 ** 3), 2))


def input_state(spark: SparkSession, path: str) -> str:
    """Tells whether files have changed: a digest of their paths, sizes and times, from metadata only."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select(F.xxhash64("path", "length", "modificationTime").alias("h")))
    found = files.agg(F.count("h"), F.sum(F.col("h").cast("decimal(38,0)"))).head()
    return f"{path}:{found[0]}:{found[1]}"


def union_available(dfs: Iterable[DataFrame], wanted: Sequence[str]) -> DataFrame:
    """Bind tables, keeping only the wanted columns that each one has."""
    parts = [d.select(*[c for c in wanted if c in d.columns]) for d in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def manifest(meta: DataFrame, present: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Metadata rows whose key occurs in ``present`` (left semi join)."""
    return meta.join(present, key, "left_semi")


def save_features(spark: SparkSession, names: Sequence[str], path: str) -> DataFrame:
    """Persist the ordered feature list used by every model."""
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "index int, feature string")
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return df


def load_features(spark: SparkSession, path: str) -> list[str]:
    """Read back the feature list in its stored order (bounded: one row per feature)."""
    return [r.feature for r in spark.read.parquet(path).orderBy("index").collect()]
