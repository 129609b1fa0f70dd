"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketrank.sources.storage import shared_dir

# The ASCII white space that separates words everywhere here: [\x20\x09-\x0D].
BLANKS = "\t\n\x0b\x0c\r "

_kept: dict[Any, Any] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package, however the driver found it."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    seen = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if (context.master.startswith("local") and root in {Path(p).resolve() for p in seen if p}) or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="run-"), "basketrank.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for module in sorted((root / "basketrank").rglob("*.py")):
            file.write(module, module.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """Select ``new=(old, type)``, by exact name.

    Every other column is dropped first, so extra columns whose names clash with these (in another case, or with
    the columns an operator adds) do no harm.
    """
    by_place = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return by_place.select(
        *[F.col(f"_{df.columns.index(old)}").cast(kind).alias(new) for new, (old, kind) in columns.items()]
    )


def by_place(df: DataFrame) -> DataFrame:
    """The same columns, named by their places: names that differ in case only do no harm."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return pick(df, id=(id_col, "long"), text=(text_col, "string"))


def slices(
    batches: Iterable[pa.RecordBatch], column: str | int = "text", limit: int = 2 << 20, rows: int = 1024
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds about ``limit`` bytes of text, or a single longer row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + limit, "right"))
            stop = min(max(start + 1, stop), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def once(key: Any, build: Callable[[], Any]) -> Any:
    """Build something a Python worker needs in every task only once, until another operator builds something there.

    The first part of a key names the operator: workers outlive it, and what it remembers would stay beside the next.
    """
    if key not in _kept:
        for other in [other for other in _kept if _owner(other) != _owner(key)]:
            del _kept[other]
        _kept[key] = build()
    return _kept[key]


def _owner(key: Any) -> Any:
    return key[0] if isinstance(key, tuple) else key


class Memo(dict):
    """Remembers what ``make`` gave for a key, at most ``2 * size`` of them: those used lately, in two generations."""

    def __init__(self, make: Callable[[Any], Any], size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: Any) -> Any:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key: Any, value: Any) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def has(self, key: Any) -> bool:
        return key in self or key in self.old


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table into the folder all executors share and read it back: this cuts the lineage.

    A lost executor costs at most a new read of the written files. ``options`` are those of the Parquet writer.
    """
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_bytes(spark: SparkSession, path: str):
    """The content of a vocabulary file (a few MB at most) as a broadcast variable."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())
