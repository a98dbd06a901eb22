"""Helpers of the operators in this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.session import shared_folder

# The six white space characters that part words, and the pattern of a word.
WORD_SPACE = " \t\n\u000b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once.

    A column that a lambda mentions can be folded into that lambda and then
    runs once for each element; a lambda's own variable never is.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_SPACE)), SPACE_PATTERN), "")


def place_map(hashes: DataFrame, size: int) -> np.ndarray:
    """A byte for each value of ``h`` modulo the size, 1 where a value falls; bitmaps of ``size`` bits are collected."""
    place = F.pmod("h", F.lit(size)) + 1
    bits = hashes.select(F.bitmap_bucket_number(place).alias("k"), F.bitmap_bit_position(place).alias("p"))
    flags = np.zeros(size, np.uint8)
    for k, found in bits.groupBy("k").agg(F.bitmap_construct_agg("p")).collect():
        own = np.unpackbits(np.frombuffer(bytes(found), np.uint8), bitorder="little")
        lo = (k - 1) * len(own)
        flags[lo : lo + len(own)] = own[: size - lo]
    return flags


def let_through(docs: DataFrame, id_col: str, text_col: str, flags: np.ndarray) -> DataFrame:
    """``id`` and ``text`` of the rows whose id's hash falls on a marked place; no marked id is left out."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(flags)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.loc[shared.value[batch["place"].to_numpy()] > 0, ["id", "text"]]

    place = F.pmod(F.xxhash64(id_col), F.lit(len(flags)))
    rows = docs.filter(F.col(id_col).isNotNull()).withColumn("_place", place)
    kept = keyed(rows, id_col, text=text_col, place="_place").mapInPandas(run, "id string, text string")
    return kept.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written as Parquet into the shared folder and read again: a cut in the lineage that outlives executors."""
    spark = df.sparkSession
    path = shared_folder(spark, "loadlens-llm", f"{label}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession, label: str) -> str:
    return shared_folder(spark, "loadlens-llm", f"{label}-{uuid.uuid4().hex[:12]}")


# A model file is sent to the tasks whole, so it must be small.
MODEL_BYTES = 64 << 20


def model_bytes(path: str, limit: int = MODEL_BYTES) -> bytes:
    """A model file's bytes, at most ``limit`` of them."""
    with open(path, "rb") as f:
        body = f.read(limit + 1)
    if len(body) > limit:
        raise ValueError(f"{path} has over {limit} bytes")
    return body


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's sources to the Python workers, once for each application.

    Spark serves the file from the driver, so workers need neither the
    repository on their disks nor a search path that leads to it.
    """
    context = spark.sparkContext
    if getattr(context, "_loadlens_shipped", None) is None:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="loadlens-"), "loadlens.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        context.addPyFile(path)
        context._loadlens_shipped = path
    return spark


def shared_model(df: DataFrame, path: str) -> Broadcast:
    """The bytes of a model file for the tasks that work on the rows."""
    return ship(df.sparkSession).sparkContext.broadcast(model_bytes(path))


def keyed(df: DataFrame, id_col: str, **columns: str) -> DataFrame:
    """The id as text under ``id`` and the named columns under their new names, for work in pandas.

    Whole numbers with nulls become floating point in pandas; text stays exact.
    """
    return df.select(F.col(id_col).cast("string").alias("id"), *[F.col(c).alias(n) for n, c in columns.items()])


def unkeyed(made: DataFrame, df: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``made`` with the id under its own name and type."""
    rest = [c for c in made.columns if c != "id"]
    return made.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), *rest)
