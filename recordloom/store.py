"""Where tables, state and lineage cuts live: plain Parquet in a shared folder.

A table version is a set of Parquet files in buckets of its key. A commit writes only the
buckets that a delta touches and then one small pointer file; readers follow the pointer, so a
job that dies half way leaves the former version intact and can simply be run again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordloom.spec import ddl_of, quote

BUCKET = "_bucket"
REJECTS = "table string, reason string, fields string"


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder named by the cluster; where it names none, one inside the warehouse, which is shared as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_recordloom"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_staged: dict[str, list[str]] = {}


def stage(df: DataFrame) -> DataFrame:
    """Write rows as Parquet into the shared folder and read them back: lineage ends, and later reads prune columns."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/recordloom-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Remove the folders that ``stage`` wrote in this application; call it when the results are written."""
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def bucket_of(pk: Sequence[str], buckets: int) -> Column:
    """Bucket of a key. Text is hashed, so that 7 and '7' are the same key."""
    return F.pmod(F.xxhash64(*[F.col(quote(c)).cast("string") for c in pk]), F.lit(buckets)).cast("int")


class TableStore:
    """Versioned tables and state under one root folder; one writer per table at a time.

    Superseded version folders stay until ``vacuum`` removes them, so that running readers can finish.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- small files through the Hadoop file system, so any storage works --

    def _fs(self, path: str):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _read_text(self, path: str) -> str | None:
        fs, target = self._fs(path)
        if not fs.exists(target):
            return None
        stream = fs.open(target)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        """Write beside the target, then rename: readers never see half a file."""
        fs, target = self._fs(path)
        fs.mkdirs(target.getParent())
        _, part = self._fs(f"{path}.{uuid.uuid4().hex}")
        stream = fs.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            part.toUri(), self.spark._jsc.hadoopConfiguration()
        )
        rename = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(part, target, options)

    # -- tables --

    def current(self, table: str) -> dict:
        text = self._read_text(f"{self.root}/{table}/_current.json")
        return json.loads(text) if text else {}

    def exists(self, table: str) -> bool:
        return bool(self.current(table))

    def buckets(self, table: str, default: int = 0) -> int:
        return self.current(table).get("buckets", default)

    def read(self, table: str, only: Sequence[int] | None = None) -> DataFrame:
        """Current version, or only some of its buckets."""
        pointer = self.current(table)
        if not pointer:
            raise FileNotFoundError(f"no such table: {table}")
        wanted = None if only is None else {str(b) for b in only}
        folders = [
            f"{self.root}/{table}/{version}/{BUCKET}={bucket}"
            for bucket, version in pointer["versions"].items()
            if wanted is None or bucket in wanted
        ]
        schema = self.spark.createDataFrame([], pointer["schema"]).schema
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def write(
        self,
        table: str,
        rows: DataFrame,
        pk: Sequence[str],
        buckets: int,
        touched: Sequence[int] | None = None,
        state: dict | None = None,
        rejected: str | None = None,
    ) -> None:
        """New version of the touched buckets (all of them by default), then the pointer and in it the state and what was set aside."""
        before = self.current(table)
        number = before.get("number", 0) + 1
        version = f"v{number}-{uuid.uuid4().hex[:8]}"
        keyed = rows.withColumn(BUCKET, bucket_of(pk, buckets))
        # rebalance lets adaptive execution split a bucket that is too large for one task
        keyed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/{table}/{version}")
        fs, target = self._fs(f"{self.root}/{table}/{version}")
        written = [
            s.getPath().getName().split("=", 1)[1]
            for s in fs.listStatus(target)
            if s.getPath().getName().startswith(f"{BUCKET}=")
        ]
        if touched is not None and not {int(b) for b in written} <= set(touched):
            # the rows changed between two evaluations; the former version stays in place
            raise RuntimeError(f"{table}: rows of other buckets than announced, land the delta first")
        versions = {} if touched is None else dict(before.get("versions", {}))
        for bucket in touched or []:
            versions.pop(str(bucket), None)
        versions.update(dict.fromkeys(written, version))
        pointer = {
            "number": number,
            "buckets": buckets,
            "pk": list(pk),
            "schema": ", ".join(f"{quote(f.name)} {ddl_of(f.dataType)}" for f in rows.schema.fields),
            "versions": versions,
            "state": {**before.get("state", {}), **(state or {})},
            "rejects": [*before.get("rejects", []), *([rejected] if rejected else [])],
        }
        if self.current(table).get("number", 0) != before.get("number", 0):
            # another writer came between; its version stays in place
            raise RuntimeError(f"{table}: changed by another commit, run this one again")
        self._write_text(f"{self.root}/{table}/_current.json", json.dumps(pointer))

    # -- rows that were refused: they count from the commit that names their folder --

    def set_aside(self, table: str, rejects: DataFrame) -> str:
        """Write refused rows (table, reason, fields) beside the table; the name of their folder."""
        name = f"r{self.current(table).get('number', 0) + 1}-{uuid.uuid4().hex[:8]}"
        rejects.write.parquet(f"{self.root}/{table}/rejects/{name}")
        return name

    def land(self, table: str, delta: DataFrame, refused: Column) -> tuple[DataFrame, int, str]:
        """Write a delta down once, counting the refused rows on the way: the rows as written, that count, the folder (remove it in the end)."""
        seen = Observation()
        path = f"{self.root}/{table}/staged/{uuid.uuid4().hex}"
        delta.observe(seen, F.count_if(refused).alias("refused")).write.parquet(path)
        return self.spark.read.schema(delta.schema).parquet(path), seen.get["refused"], path

    def remove(self, path: str) -> None:
        _delete(self.spark, path)

    def rejects(self, table: str) -> DataFrame:
        """Refused rows of all commits: table, reason, fields."""
        names = self.current(table).get("rejects", [])
        if not names:
            return self.spark.createDataFrame([], REJECTS)
        return self.spark.read.schema(REJECTS).parquet(*[f"{self.root}/{table}/rejects/{name}" for name in names])

    # -- state that belongs to a table: it moves only with the data, in the same pointer --

    def state(self, table: str) -> dict:
        return self.current(table).get("state", {})

    # -- housekeeping --

    def vacuum(self, table: str) -> int:
        """Remove folders of versions and rejects that the pointer no longer names, and deltas of commits that died.

        Call it when nobody reads or writes the table.
        """
        pointer = self.current(table)
        live = {*pointer.get("versions", {}).values(), *pointer.get("rejects", [])}
        gone = 0
        for part, first in (("", "v"), ("/rejects", "r"), ("/staged", "")):
            fs, folder = self._fs(f"{self.root}/{table}{part}")
            for status in fs.listStatus(folder) if fs.exists(folder) else []:
                name = status.getPath().getName()
                if status.isDirectory() and name.startswith(first) and name not in live and name not in ("rejects", "staged"):
                    fs.delete(status.getPath(), True)
                    gone += 1
        return gone
