"""Tables by period and bucket of the key: a commit rewrites the partitions that its delta touches and nothing else.

The rows of a table lie in one folder, partitioned by a period (such as the month of a creation date) and by a bucket of
the key. The number of buckets follows the measured size of the first load. A commit writes the delta down once and counts it while
it does so; what it holds decides which partitions are read, merged and replaced by dynamic partition overwrite. A row whose
period moved is found by its key in the old partition: of the buckets concerned, only key columns are read for that.

Replacing is safe to repeat: a commit that dies is run again with the same delta and gives the same table, as its state is
written last. It is not one step for readers, who may see some partitions before and some after it. A driver that dies while Spark
moves finished files leaves some of them in Spark's staging folder beside the partitions; tables that must survive that without a look
at that folder belong into ``store.TableStore``, which replaces one pointer.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.flatten import at
from recordloom.operators.keys import key_reason
from recordloom.operators.merge import OP, latest_per_key, reject_log, with_op
from recordloom.spec import TableSpec, ddl_of, quote
from recordloom.store import REJECTS, TableStore, bucket_of

PERIOD, BUCKET, GONE = "_period", "_bucket", "_gone"
REASON = "reject_reason"
#: A partition should hold about as much, and a table's period at most this many buckets.
TARGET_BYTES = 128 * 2**20
MOST_BUCKETS = 4096
SUMMARY = "commit int, rows long, upserts long, deletes long, rejects long, no_period long, partitions int, types string, state string"


class PeriodTable:
    """One table; one writer at a time. ``period`` makes the period's name of a row, which must not be null text."""

    def __init__(
        self, spark: SparkSession, root: str, spec: TableSpec, period: Column, moves: bool = True, target_bytes: int = TARGET_BYTES
    ):
        self.spark, self.spec, self.period, self.moves, self.target_bytes = spark, spec, period, moves, target_bytes
        self.folder = f"{root.rstrip('/')}/{spec.name}"
        self._files = TableStore(spark, root)

    # -- what is stored --

    def about(self) -> dict:
        text = self._files._read_text(f"{self.folder}/about.json")
        return json.loads(text) if text else {}

    def state(self) -> dict:
        return self.about().get("state", {})

    def _stored(self, partitions: Sequence[tuple[str, int]] | None = None) -> DataFrame:
        """Rows with period and bucket, of all partitions or of those named."""
        schema = f"{self.about()['schema']}, {GONE} boolean, {PERIOD} string, {BUCKET} int"
        data = f"{self.folder}/data"
        if partitions is None:
            return self.spark.read.schema(schema).parquet(data)
        paths = [p for p in (f"{data}/{PERIOD}={_escaped(a)}/{BUCKET}={b}" for a, b in partitions) if self._there(p)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", data).parquet(*paths)

    def _there(self, path: str) -> bool:
        fs, target = self._files._fs(path)
        return fs.exists(target)

    def read(self) -> DataFrame:
        return self._stored().filter(F.col(GONE).isNull()).drop(GONE, PERIOD, BUCKET)

    def rejects(self) -> DataFrame:
        """Refused rows of all commits: table, reason, fields."""
        path = f"{self.folder}/rejects"
        return self.spark.read.schema(REJECTS).parquet(path) if self._there(path) else self.spark.createDataFrame([], REJECTS)

    def summaries(self) -> DataFrame:
        """One row for each commit, as counted while it wrote."""
        return self.spark.createDataFrame([tuple(s) for s in self.about().get("summaries", [])], SUMMARY)

    # -- commits --

    def _tagged(self, delta: DataFrame) -> DataFrame:
        """Delta with kind of change, reason of refusal and period."""
        return with_op(delta, self.spec).withColumns(
            {REASON: key_reason(delta, self.spec.pk), PERIOD: F.coalesce(self.period.cast("string"), F.lit("none"))}
        )

    def _landed(self, delta: DataFrame) -> tuple[DataFrame, dict, int, str]:
        """The delta as written: rows, counts, bytes, folder."""
        seen = Observation()
        kept = F.col(REASON).isNull()
        counted = self._tagged(delta).observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(kept & (F.col(OP) == "U")).alias("upserts"),
            F.count_if(kept & (F.col(OP) == "D")).alias("deletes"),
            F.count_if(~kept).alias("rejects"),
            F.count_if(F.col(PERIOD) == "none").alias("no_period"),
        )
        path = f"{self.folder}/staged/{uuid.uuid4().hex}"
        counted.write.parquet(path)
        fs, target = self._files._fs(path)
        return self.spark.read.schema(counted.schema).parquet(path), dict(seen.get), fs.getContentSummary(target).getLength(), path

    def commit(self, delta: DataFrame, seq: Sequence[str], state: dict | None = None) -> list[tuple[str, int]]:
        """Merge a delta and return the partitions that were rewritten. Rows that lack a key column go to the rejects."""
        spec, about = self.spec, self.about()
        staged, counts, size, path = self._landed(delta)
        good = staged.filter(F.col(REASON).isNull())
        first = not about
        if first:
            periods = good.agg(F.countDistinct(PERIOD)).first()[0]
            about = {"buckets": min(MOST_BUCKETS, max(1, math.ceil(size / max(1, periods) / self.target_bytes))), "number": 0, "summaries": []}
        if counts["rejects"]:
            lacking = staged.filter(F.col(REASON).isNotNull()).drop(OP, PERIOD)
            reject_log(lacking, spec.name).write.mode("append").parquet(f"{self.folder}/rejects")
        own = [c for c in good.columns if c not in (OP, REASON, PERIOD, "present") and (c not in seq or c in spec.pk)]
        last = latest_per_key(good, spec.pk, seq).select(*map(at, own), OP, PERIOD).withColumn(BUCKET, bucket_of(spec.pk, about["buckets"]))
        fields = {f.name: ddl_of(f.dataType) for f in good.schema.fields if f.name in own}
        about["schema"] = _merged_schema(self.spark, about.get("schema"), fields)
        rows = last.filter(F.col(OP) == "U").drop(OP)
        if first:
            touched, out = [], rows
        else:
            touched = self._touched(last)
            out = self._stored(touched).filter(F.col(GONE).isNull()).join(last.select(*map(at, spec.pk)), list(spec.pk), "left_anti")
            marks = self.spark.createDataFrame(touched, f"{PERIOD} string, {BUCKET} int").withColumn(GONE, F.lit(True))
            # a mark in each partition, so that one that lost its last row is replaced as well
            out = out.unionByName(rows, allowMissingColumns=True).unionByName(marks, allowMissingColumns=True)
        if first or touched:
            self._write(out)
        about["number"] += 1
        about["state"] = {**about.get("state", {}), **(state or {})}
        about["summaries"].append(
            [about["number"], *(counts[k] for k in ("rows", "upserts", "deletes", "rejects", "no_period")), len(touched), about["schema"], json.dumps(about["state"])]
        )
        self._files._write_text(f"{self.folder}/about.json", json.dumps(about))
        fs, target = self._files._fs(path)
        fs.delete(target, True)
        return touched

    def _touched(self, last: DataFrame) -> list[tuple[str, int]]:
        """Partitions of the changed keys, now and before; a list of partitions, never of keys."""
        places = last.select(PERIOD, BUCKET).distinct()
        if self.moves:
            keys = last.select(*map(at, self.spec.pk))
            buckets = [r[0] for r in last.select(BUCKET).distinct().collect()]
            stored = self._stored().filter(F.col(BUCKET).isin(buckets) & F.col(GONE).isNull())
            before = stored.select(*map(at, self.spec.pk), PERIOD, BUCKET).join(keys, list(self.spec.pk), "left_semi")
            places = places.unionByName(before.select(PERIOD, BUCKET)).distinct()
        return sorted((r[0], r[1]) for r in places.collect())

    def _write(self, out: DataFrame) -> None:
        if GONE not in out.columns:
            out = out.withColumn(GONE, F.lit(None).cast("boolean"))
        dealt = out.hint("rebalance", PERIOD, BUCKET)
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD, BUCKET)
        writer.parquet(f"{self.folder}/data")


def _escaped(value: str) -> str:
    """Name of a partition folder, as Spark writes it for the values used here."""
    return "".join(c if c not in "\"#%'*/:=?\\\x7f{[]^" and c >= " " else f"%{ord(c):02X}" for c in value)


def _merged_schema(spark: SparkSession, before: str | None, fields: dict[str, str]) -> str:
    """Stored columns, then the new ones."""
    known = {f.name: ddl_of(f.dataType) for f in spark.createDataFrame([], before).schema.fields} if before else {}
    new = {n: t for n, t in fields.items() if n not in known}
    return ", ".join(f"{quote(n)} {t}" for n, t in {**known, **new}.items())
