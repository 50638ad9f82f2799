"""Shared helpers: reading tables, written intermediates, row keys, salted joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstat.session import shared_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE_CLASS = "\\x20\\x09-\\x0D"
SPACES = " \t\n\u000b\f\r"
# A word is a run of ASCII digits, ASCII letters and any non-ASCII character.
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

HOT_KEYS = 4096          # most keys that are ever salted; the list of them is broadcast
MAX_SALTS = 1024


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of the corpus folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage, survives lost executors, and lets several branches read
    the same rows without computing them again.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z alone. Pure ASCII takes the fast built-in, the rest a translation."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, ASCII_UPPER, ASCII_UPPER.lower()))


def word_line(text: Column) -> Column:
    """The words of a text, lower-cased (A-Z), joined by single spaces."""
    return F.btrim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, " "))


def n_words(line: Column) -> Column:
    """How many words a ``word_line`` has."""
    return F.when(line == "", F.lit(0)).otherwise(
        F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def row_key(id_col: Column, text: Column) -> tuple[Column, Column]:
    """128 bits that are never null and equal for rows of equal id and text only."""
    return F.xxhash64(F.lit(1), id_col, text), F.xxhash64(F.lit(2), text, id_col)


def salted_join(big: DataFrame, keyed: DataFrame, on: list[str], weight: str,
                spread: list[str], rows_per_salt: int = 2000) -> DataFrame:
    """Inner join of ``big`` with ``keyed`` (unique on ``on``) that splits hot keys.

    ``weight`` is a column of ``keyed``: how many rows of ``big`` the key has.
    The at most ``HOT_KEYS`` heaviest keys get several salts each: their rows
    of ``big`` are dealt over the salts by ``spread``, their one row of
    ``keyed`` is repeated. All other keys weigh less than a ``HOT_KEYS``-th of
    all rows. No row is lost. The broadcast list has ``HOT_KEYS`` rows at most.
    """
    hot = (keyed.where(F.col(weight) > rows_per_salt)
           .orderBy(F.col(weight).desc(), *on).limit(HOT_KEYS)
           .select(*on, F.least(F.ceil(F.col(weight) / rows_per_salt), F.lit(MAX_SALTS))
                   .cast("int").alias("_salts")))
    n = F.coalesce(F.col("_salts"), F.lit(1))
    right = (keyed.join(F.broadcast(hot), on, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("_salts"))
    left = (big.join(F.broadcast(hot), on, "left")
            .withColumn("_salt", F.when(n == 1, F.lit(0)).otherwise(
                F.pmod(F.xxhash64(*spread), n).cast("int"))).drop("_salts"))
    return left.join(right, [*on, "_salt"]).drop("_salt")
