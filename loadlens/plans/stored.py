"""Stored summaries of a table, brought up to date from its changed files only.

``StoredSeries`` keeps rows per file and day, ``StoredSketches`` sketches of the
columns per file and month, ``StoredKeys`` rows per key. A
refresh compares the table's files with those the summary was made from: files
that are new are read, files that are gone are taken out. Data files are told
by their names, as writers never change a file in place.

Each refresh writes a new version beside the old one and a version counts from
its success mark on, so a refresh that dies half-way leaves the last version in
force. Old versions stay for readers until ``drop_old``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions import dates
from loadlens.operators import sketches
from loadlens.operators.duplicates import null_key

_FILE = "_metadata.file_path"


@dataclass
class Refresh:
    """What a refresh did; ``rows_read`` are rows of the table."""

    version: int
    files_added: int
    files_removed: int
    rows_read: int


class _Versions:
    """Folders ``v1``, ``v2`` and so on under a path; those without a success mark do not count."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._java = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._java(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def complete(self, part: str) -> list[int]:
        top = self._java(f"{self.path}/{part}")
        if not self._system.exists(top):
            return []
        names = [s.getPath().getName() for s in self._system.listStatus(top)]
        found = [int(n[1:]) for n in names if re.fullmatch(r"v\d+", n)]
        return sorted(v for v in found if self._system.exists(self._java(f"{self.path}/{part}/v{v}/_SUCCESS")))

    def used(self, part: str) -> int:
        """The highest number of any folder, complete or not."""
        top = self._java(f"{self.path}/{part}")
        names = [s.getPath().getName() for s in self._system.listStatus(top)] if self._system.exists(top) else []
        return max([int(n[1:]) for n in names if re.fullmatch(r"v\d+", n)], default=0)

    def remove(self, part: str, version: int) -> None:
        self._system.delete(self._java(f"{self.path}/{part}/v{version}"), True)


def files_of(table: DataFrame) -> DataFrame:
    """Names of a table's data files as its scan gives them, from the listing that Spark holds."""
    names = {re.sub("^file:/+", "file:///", n) for n in table.inputFiles()}
    return table.sparkSession.createDataFrame([(n,) for n in sorted(names)], "file string")


def _named_alike(file) -> F.Column:
    return F.regexp_replace(file, "^file:/+", "file:///")


def _rows_of(table: DataFrame, files: list[str], counted: Observation | None = None) -> DataFrame:
    """Rows of some files of a table; other files are not opened."""
    spellings = sorted({re.sub("^file:/+", s, f) for f in files for s in ("file:///", "file:/")})
    rows = table.filter(F.col(_FILE).isin(spellings)).withColumn("_file", _named_alike(F.col(_FILE)))
    return rows.observe(counted, F.count(F.lit(1)).alias("n")) if counted is not None else rows


class _PerFile:
    """A summary with rows per data file; every file has one at least, so that it is known."""

    PART, SCHEMA = "", ""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._versions = _Versions(spark, path)

    def _stored(self) -> DataFrame | None:
        known = self._versions.complete(self.PART)
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/{self.PART}/v{known[-1]}") if known else None

    def _made(self) -> DataFrame:
        stored = self._stored()
        if stored is None:
            raise ValueError(f"the {self.PART} has not been made yet")
        return stored

    def _summary(self, rows: DataFrame, table: DataFrame) -> DataFrame:
        raise NotImplementedError

    def refresh(self, table: DataFrame) -> Refresh:
        """Bring the summary up to date with the table; only its new files are read."""
        now, stored = files_of(table), self._stored()
        if stored is None:
            stored = self.spark.createDataFrame([], self.SCHEMA)
        known = stored.select("file").distinct()
        added = [r["file"] for r in now.join(known, "file", "left_anti").collect()]
        removed = known.join(now, "file", "left_anti").count()
        versions = self._versions.complete(self.PART)
        if not added and not removed and versions:
            return Refresh(versions[-1], 0, 0, 0)
        read, version = Observation(), self._versions.used(self.PART) + 1
        kept = stored.join(now, "file", "left_semi").select(*stored.columns)
        if added:
            kept = kept.unionByName(self._summary(_rows_of(table, added, read), table))
            marks = self.spark.createDataFrame([(f,) for f in added], "file string")
            kept = kept.unionByName(marks, allowMissingColumns=True)
        kept.hint("rebalance").write.parquet(f"{self.path}/{self.PART}/v{version}")
        return Refresh(version, len(added), removed, read.get["n"] if added else 0)

    def drop_old(self) -> None:
        """Remove all versions but the last."""
        for version in self._versions.complete(self.PART)[:-1]:
            self._versions.remove(self.PART, version)


class StoredSeries(_PerFile):
    """Rows per file and day of one table."""

    PART, SCHEMA = "series", "file string, d date, n bigint"

    def __init__(self, spark: SparkSession, path: str, date_column: str, table_name: str = ""):
        super().__init__(spark, path)
        self.date_column, self.table_name = date_column, table_name

    def _summary(self, rows: DataFrame, table: DataFrame) -> DataFrame:
        day = dates.as_date(table, self.date_column).alias("d")
        return rows.groupBy(F.col("_file").alias("file"), day).agg(F.count("*").alias("n"))

    def series(self) -> DataFrame:
        """The daily series as ``series.daily_series`` gives it."""
        days = self._made().groupBy("d").agg(F.sum("n").alias("n")).filter("n > 0")
        return days.select(F.lit(self.table_name).alias("table_name"), "d", "n")


class StoredSketches(_PerFile):
    """Sketches of every column per file and month of one table; rows whose date does not parse have no month."""

    PART, SCHEMA = "sketches", f"file string, month string, {sketches.SKETCH}"

    def __init__(self, spark: SparkSession, path: str, date_column: str, columns: list[str] | None = None):
        super().__init__(spark, path)
        self.date_column, self.columns = date_column, columns

    def _summary(self, rows: DataFrame, table: DataFrame) -> DataFrame:
        month = F.date_format(dates.as_date(table, self.date_column), "yyyy-MM").alias("month")
        names = self.columns or table.columns
        return sketches.column_sketches(rows, F.col("_file").alias("file"), month, columns=names)

    def profile(self, first: str | None = None, last: str | None = None, by_month: bool = False) -> DataFrame:
        """Profile of the months from ``first`` to ``last`` (both ``YYYY-MM``), or of all rows."""
        known = self._made().filter("column_name IS NOT NULL")
        for month, test in ((first, ">="), (last, "<=")):
            known = known if month is None else known.filter(F.expr(f"month {test} '{month}'"))
        return sketches.profile_of(sketches.united(known, *(["month"] if by_month else [])))


class StoredKeys:
    """Rows per key of one table, in buckets of the key's digest.

    A refresh counts the keys of the changed files, deals these to the buckets
    and merges bucket by bucket; the stored keys are never shuffled. Files that
    are gone are subtracted by reading them where they lie, as deletes here
    leave them as recovery point; if one cannot be found, all is counted anew.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], date_column: str | None = None, buckets: int = 200, name: str | None = None
    ):
        self.spark, self.keys, self.date_column, self.buckets = spark, keys, date_column, buckets
        self.path = path.rstrip("/")
        self.name = name or "keys_" + re.sub(r"\W", "_", self.path)[-60:]
        self._versions = _Versions(spark, path)

    def _key(self, table: DataFrame, column: str):
        as_day = self.date_column and column.lower() == self.date_column.lower()
        return (dates.as_date(table, column) if as_day else F.col(f"`{column}`")).alias(column)

    def _counts(self, rows: DataFrame, table: DataFrame, sign: int) -> DataFrame:
        """Signed rows per key: digest, the key's columns as ``k``, whether one of them is null."""
        keyed = rows.select(*[self._key(table, c) for c in self.keys])
        # As text, which keeps the microseconds that a time in JSON would lose.
        binary = {f.name for f in keyed.schema if isinstance(f.dataType, T.BinaryType)}
        texts = [(F.hex(c) if c in binary else F.col(c).cast("string")).alias(c) for c in self.keys]
        plain = F.to_json(F.struct(*texts), {"ignoreNullFields": "false"})
        counted = keyed.groupBy(*self.keys).agg((F.count("*") * sign).alias("n"))
        return counted.select(F.sha2(plain, 256).alias("key"), F.struct(*self.keys).alias("k"), null_key(self.keys).alias("has_null"), "n")

    def _table(self, version: int, schema: str) -> DataFrame:
        """A version as a bucketed table; the catalog entry is made anew from the files if it is not there."""
        name = f"{self.name}_v{version}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY (key) SORTED BY (key) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/keys/v{version}'"
        )
        return self.spark.table(name)

    def _schema(self) -> str | None:
        known = self._versions.complete("keys")
        if not known:
            return None
        fields = self.spark.read.parquet(f"{self.path}/keys/v{known[-1]}").schema
        return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)

    def sizes(self) -> DataFrame:
        """The stored keys: ``key``, ``k``, ``has_null`` and their number of rows ``n``."""
        known = self._versions.complete("keys")
        if not known:
            raise ValueError("the keys have not been counted yet")
        return self._table(known[-1], self._schema())

    def groups(self) -> DataFrame:
        """The key groups as ``duplicates.key_groups`` gives them."""
        return self.sizes().select("k.*", "n")

    def merged(self, change: DataFrame) -> DataFrame:
        """The stored keys with a change added; keys without rows are dropped."""
        stored = self.sizes()
        other = change.select("key", F.col("k").alias("_k"), F.col("has_null").alias("_null"), F.col("n").alias("_n"))
        total = F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))
        joined = stored.join(other.hint("merge"), "key", "full")
        return joined.select(
            "key", F.coalesce("k", "_k").alias("k"), F.coalesce("has_null", "_null").alias("has_null"), total.alias("n")
        ).filter("n > 0")

    def refresh(self, table: DataFrame) -> Refresh:
        """Count the keys of the table's new files, subtract those of files that are gone."""
        now, known = files_of(table), self._versions.complete("keys")
        version = max(self._versions.used("keys"), self._versions.used("files")) + 1
        old = self.spark.read.schema("file string").parquet(f"{self.path}/files/v{known[-1]}") if known else now.limit(0)
        added = [r["file"] for r in now.join(old, "file", "left_anti").collect()]
        gone = [r["file"] for r in old.join(now, "file", "left_anti").collect()]
        if known and not added and not gone:
            return Refresh(known[-1], 0, 0, 0)
        exists = lambda f: self._versions._system.exists(self._versions._java(f))
        if not known or not all(exists(f) for f in gone):
            added, known = [r["file"] for r in now.collect()], []
        read, lost = Observation(), Observation()
        changes = []
        if added:
            changes.append(self._counts(_rows_of(table, added, read), table, 1))
        if gone and known:
            # Partition columns are in the folders' names.
            base = re.sub(r"/[^/=]+=.*$", "", gone[0]) if "=" in gone[0] else gone[0].rsplit("/", 1)[0]
            before = self.spark.read.schema(table.schema).option("basePath", base).parquet(*gone)
            changes.append(self._counts(before.observe(lost, F.count(F.lit(1)).alias("n")), table, -1))
        change = changes[0]
        if len(changes) == 2:
            both = changes[0].unionByName(changes[1]).groupBy("key").agg(
                F.any_value("k").alias("k"), F.any_value("has_null").alias("has_null"), F.sum("n").alias("n")
            )
            change = both.filter("n <> 0")
        out = self.merged(change) if known else change
        now.coalesce(1).write.parquet(f"{self.path}/files/v{version}")
        out = out.repartition(self.buckets, "key") if not known else out
        out.write.format("parquet").bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.path}/keys/v{version}").saveAsTable(
            f"{self.name}_v{version}"
        )
        rows = (read.get["n"] if added else 0) + (lost.get["n"] if gone and known else 0)
        return Refresh(version, len(added), len(gone), rows)

    def drop_old(self) -> None:
        """Remove all versions but the last."""
        for version in self._versions.complete("keys")[:-1]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_v{version}")
            self._versions.remove("keys", version)
            self._versions.remove("files", version)
