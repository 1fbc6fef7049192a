"""Stored tables that a refresh changes: date partitions and published versions.

A table folder holds ``data/<commit>/part_bucket=<b>`` folders of Parquet files
and one small ``versions/<n>`` file for each version, which names the folders of
every bucket. A commit writes the buckets that it touches into folders of its
own and then publishes the next version by one rename: a reader sees the old or
the new version, never a part, and the files of all other buckets stay as they
are. One writer at a time; a lost executor only repeats tasks of an unpublished
commit.

Buckets are ranges of the date key; rows without a date are in the bucket
``NO_DATE``. There are as many buckets as the calendar has ranges, however large
the table is.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfline.plans.star import CODEC, _fs, _read_text, _write_text
from shelfline.session import SHUFFLES_END, held
from shelfline.sources.io import date_bucket

BUCKET = "part_bucket"
NO_DATE = -1_000_000
#: A task keeps the files of so many buckets open: its rows cover few, and only those of further ones are sorted (and spilled) by bucket.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "16"}


class VersionedTable:
    """A table partitioned by ranges of ``date_col``, ``width_days`` long."""

    def __init__(self, spark: SparkSession, path: str, date_col: str, width_days: int = 30):
        self.spark, self.path, self.date_col, self.width_days = spark, path.rstrip("/"), date_col, width_days

    def bucket(self) -> Column:
        return F.coalesce(date_bucket(self.date_col, self.width_days), F.lit(NO_DATE))

    # ------------------------------------------------------------ versions
    def version(self) -> int:
        """The latest version, 0 if there is none."""
        fs, p = _fs(self.spark, f"{self.path}/versions")
        if not fs.exists(p):
            return 0
        return max((int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit()), default=0)

    def folders(self, version: int | None = None) -> dict[int, list[str]]:
        """The folders of every bucket in a version (the latest)."""
        version = self.version() if version is None else version
        text = _read_text(self.spark, f"{self.path}/versions/{version}") if version else None
        return {int(b): f for b, f in json.loads(text)["buckets"].items()} if text else {}

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the latest); a table has one before it is read."""
        version = self.version() if version is None else version
        manifest = json.loads(_read_text(self.spark, f"{self.path}/versions/{version}"))
        schema = StructType.fromJson(manifest["schema"])
        paths = [f"{self.path}/{f}" for x in manifest["buckets"].values() for f in x]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read_buckets(self, buckets: set[int]) -> DataFrame:
        """The rows of some buckets of the latest version; no file of another bucket is opened."""
        folders, schema = self.folders(), self.read().schema
        paths = [f"{self.path}/{f}" for b in buckets for f in folders.get(b, [])]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # ------------------------------------------------------------ commits
    def _write(self, rows: DataFrame, clustered: bool = False) -> dict[int, list[str]]:
        """New folders for the rows, one for each bucket that they touch.

        Rows that are ``clustered`` (read from files that cover few dates each)
        are written from where they are read, without a shuffle."""
        commit = f"data/{uuid.uuid4().hex}"
        rows = rows.withColumn(BUCKET, self.bucket())
        if not clustered:
            n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            # ranges of (date, all other columns) split a date that holds a large share of the rows
            rows = rows.repartitionByRange(n, F.col(self.date_col), F.xxhash64(*[c for c in rows.columns if c != BUCKET]))
        with held(self.spark, SHUFFLES_END | OPEN_FILES):
            rows.write.option("compression", CODEC).partitionBy(BUCKET).parquet(f"{self.path}/{commit}")
        fs, p = _fs(self.spark, f"{self.path}/{commit}")
        names = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()]
        return {int(x.split("=")[1]): [f"{commit}/{x}"] for x in names if x.startswith(BUCKET)}

    def _publish(self, based_on: int, buckets: dict[int, list[str]], schema) -> int:
        new = based_on + 1
        text = json.dumps({"schema": schema.jsonValue(), "buckets": {str(b): f for b, f in sorted(buckets.items()) if f}})
        temp = f"{self.path}/versions/_{uuid.uuid4().hex}"
        _write_text(self.spark, temp, text)
        fs, target = _fs(self.spark, f"{self.path}/versions/{new}")
        if fs.exists(target) or not fs.rename(_fs(self.spark, temp)[1], target):
            raise RuntimeError(f"version {new} of {self.path} was published by another writer")
        return new

    def create(self, rows: DataFrame, clustered: bool = False) -> int:
        return self._publish(self.version(), self._write(rows, clustered), rows.schema)

    def append(self, rows: DataFrame) -> int:
        """Rows join their buckets; no file is rewritten."""
        base = self.version()
        buckets, schema = self.folders(base), self.read(base).schema
        for b, new in self._write(rows.select(*[F.col(f.name).cast(f.dataType) for f in schema])).items():
            buckets[b] = buckets.get(b, []) + new
        return self._publish(base, buckets, schema)

    def rewrite(self, touched: set[int], change, plus: DataFrame | None = None) -> int:
        """``change(rows)`` of the touched buckets replaces them, and the rows of ``plus`` join their
        buckets, in one commit; the other buckets keep their files."""
        base = self.version()
        buckets, schema = self.folders(base), self.read(base).schema
        paths = [f"{self.path}/{f}" for b in touched for f in buckets.get(b, [])]
        if not paths and plus is None:
            return base
        rows = change(self.spark.read.schema(schema).parquet(*paths)) if paths else None
        if plus is not None:
            more = plus.select(*[F.col(f.name).cast(f.dataType) for f in schema])
            rows = more if rows is None else rows.unionByName(more)
        after = {b: f for b, f in buckets.items() if b not in touched}
        for b, new in self._write(rows).items():
            after[b] = after.get(b, []) + new
        return self._publish(base, after, schema)

    def vacuum(self) -> None:
        """Removes the older versions and the folders that only they name. For a table without readers of these."""
        latest = self.version()
        fs, p = _fs(self.spark, f"{self.path}/versions")
        old = [int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit()]
        old = [n for n in old if n < latest]
        kept = {f for x in self.folders(latest).values() for f in x}
        gone = {f for n in old for x in self.folders(n).values() for f in x} - kept
        for name in [f"versions/{n}" for n in old] + sorted(gone):       # a folder goes when no version names it
            fs.delete(_fs(self.spark, f"{self.path}/{name}")[1], True)
