"""Materialised stages: Parquet tables in the folder all executors share."""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        folder = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(folder)
        _local_dirs[context.applicationId] = folder
    return _local_dirs[context.applicationId]


MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES = 500_000, 64 << 20
#: Parts that a popular key's rows are dealt out to where a table is too large to be broadcast; a key is popular with
#: more than this share of all rows, so there are fewer popular keys than its inverse.
SPREAD, POPULAR = 32, 1 / 1024


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a table has at most so many rows and bytes (as text), from one scan that ends early if not."""
    text = F.length(F.to_json(F.struct("*"))).cast("long")
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(text)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Mark a table for broadcast after measuring that it is small; larger ones are joined by a shuffle."""
    return F.broadcast(df) if fits_broadcast(df) else df


def popular_keys(rows: DataFrame, key: str) -> list:
    """The keys that hold more than ``POPULAR`` of all rows: their counts are folded, a bounded list is collected."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col(key).isNotNull())
    least = rows.agg((F.count(F.lit(1)) * POPULAR).alias("least")).scalar()
    return [row[0] for row in counts.where(F.col("_n") > least).select(key).collect()]


def join_catalogue(rows: DataFrame, catalogue: DataFrame, key: str, spread_by: str, keys: DataFrame | None = None) -> DataFrame:
    """Left join of many rows with a table that has one row for each ``key``.

    A few keys hold most of the rows. A small table is broadcast, which spares
    them a shuffle. With a larger one the rows of popular keys are dealt out to
    ``SPREAD`` parts by ``spread_by``, and only those keys' rows of the table go
    to every part; all others move once. ``keys`` is a table to count the keys
    in, where ``rows`` takes long to make. The larger table is never left to
    Spark to broadcast, which would judge it by the size of compressed files.
    """
    if fits_broadcast(catalogue):
        return rows.join(F.broadcast(catalogue), key, "left")
    popular = F.col(key).isin(popular_keys(rows if keys is None else keys, key))
    part = F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("int")
    spread = rows.withColumn("_part", F.when(popular | F.col(key).isNull(), part).otherwise(F.lit(0)))
    parts = F.explode(F.sequence(F.lit(0), F.when(popular, F.lit(SPREAD - 1)).otherwise(F.lit(0))))
    return spread.join(catalogue.withColumn("_part", parts).hint("merge"), [key, "_part"], "left").drop("_part")


def content_mark(df: DataFrame) -> str:
    """A mark that changes with the rows of a table, not with their order: one scan, one row to the driver."""
    rows, total = df.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)"))
    ).first()
    return f"{df.schema.simpleString()} {rows} {total}"


class Stages:
    """Writes named intermediate tables and reads them back.

    A written table cuts the lineage and survives lost executors. With ``resume``
    a table is reused only if the last one under its name was completed with the
    same parameters, among which the caller puts a ``content_mark`` of what the
    table is made from; otherwise every call recomputes. A named table has two
    folders in turn, so that the last complete one stays until the next is.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, resume: bool = False):
        if resume and not root:
            raise ValueError("resume needs the root folder of the run to continue")
        self.spark = spark
        self.named = root is not None
        self.root = root.rstrip("/") if root else f"{shared_dir(spark)}/stages-{uuid.uuid4().hex}"
        self.resume = resume

    def __call__(
        self, name: str, df: DataFrame, params: Mapping[str, object] | None = None
    ) -> DataFrame:
        if not self.named:
            return self._written(df, f"{self.root}/{name}/data-{uuid.uuid4().hex}")
        fingerprint, last = _fingerprint(df, params), self._last(name)
        if self.resume and last is not None and last.fingerprint == fingerprint:
            return self.spark.read.schema(df.schema).parquet(last.path)
        paths = [f"{self.root}/{name}/data-{i}" for i in range(2)]
        path = paths[last is not None and last.path == paths[0]]
        table = self._written(df, path)
        # The pointer is written last, so a table cut short is never reused.
        done = self.spark.range(0, 1, 1, 1).select(F.lit(path).alias("path"), F.lit(fingerprint).alias("fingerprint"))
        done.write.mode("overwrite").json(f"{self.root}/{name}/last")
        return table

    def read(self, name: str) -> DataFrame:
        """The table an earlier run left under this name."""
        last = self._last(name)
        if last is None:
            raise FileNotFoundError(f"no completed table {name!r} in {self.root}")
        return self.spark.read.parquet(last.path)

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        # Zstandard takes a third less disk than Spark's choice.
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _last(self, name: str):
        try:
            rows = self.spark.read.schema("path string, fingerprint string").json(f"{self.root}/{name}/last").take(1)
        except AnalysisException:
            return None
        return rows[0] if rows else None


def _fingerprint(df: DataFrame, params: Mapping[str, object] | None) -> str:
    described = json.dumps([dict(params or {}), df.schema.simpleString()], sort_keys=True, default=str)
    return hashlib.sha256(described.encode()).hexdigest()[:24]
