"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app: str = "loadlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Adaptive execution does the work that depends on the data: it sizes
    shuffle partitions, turns a join into a broadcast when the finished side
    proves small, and splits skewed join partitions when it does not.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="loadlens-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts])


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few driver-held rows as a DataFrame made of literals only."""
    fields = T.StructType.fromDDL(schema).fields
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)]) for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder; nothing is overwritten."""
    return shared_folder(spark, "loadlens", f"{label}-{uuid.uuid4().hex[:12]}")

