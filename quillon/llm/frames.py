"""Small helpers for DataFrames that hold documents."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; unset, a temporary one, on one machine only."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="quillon-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(where)
    return where


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


#: Rows of a table of known length that go to one file.
FILE_ROWS = 1 << 15


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage ends there, and lost executors cost nothing.

    ``rows``: about how many it has at most.  Small tables then go to few
    files, however many partitions they come in; Hadoop's local file system
    starts processes for each file.
    """
    path = scratch(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(1 + rows // FILE_ROWS)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written` that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        target = hadoop(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def hash_sample(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """At most ``rows`` rows, the same ones however the table is partitioned: those of smallest key hashes.

    A bound on the hash leaves about that many before any row is moved, so no
    task hands on more than its part.
    """
    n = df.count()
    h = F.xxhash64(*keys)
    if n > rows:
        share = (rows + 6 * rows**0.5) / n  # the limit below is what bounds
        df = df.filter(h < F.lit(int(-(2**63) + min(1.0, share) * 2**64) if share < 1 else 2**63 - 1))
    return df.orderBy(h, *keys).limit(rows)


#: Bytes of a batch that are worked on together; one larger row stands alone.
PIECE_BYTES = 8 << 20


def pieces(batches: Iterable[pa.RecordBatch], limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in order, cut into batches of at most ``limit`` bytes or one row."""
    for batch in batches:
        if batch.nbytes <= limit or batch.num_rows < 2:
            yield batch
        else:
            half = batch.num_rows // 2
            yield from pieces((batch.slice(0, half), batch.slice(half)), limit)


def rows(batch: pa.RecordBatch, at_once: int = 256) -> Iterator[dict]:
    """The rows of a batch as Python objects, a few at a time."""
    for k in range(0, batch.num_rows, at_once):
        yield from batch.slice(k, at_once).to_pylist()


def map_batches(
    df: DataFrame,
    fields: Sequence[tuple[str, T.DataType]],
    fn: Callable[[pa.RecordBatch], Iterator[dict] | dict],
    keep: Sequence[str] = (),
    start: Callable[[], object] | None = None,
) -> DataFrame:
    """mapInArrow with one output row for each input row.

    ``keep`` names the input columns that are carried along; ``fn`` returns the
    new columns of a batch by name, which replace kept ones of the same name.
    Batches reach ``fn`` in :func:`pieces`, whatever the size of their rows.
    """
    new = dict(fields)
    kept = [c for c in keep if c not in new]
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in kept] + [T.StructField(c, t) for c, t in fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in pieces(batches):
            if batch.num_rows:
                made = fn(batch)
                columns = [batch.column(batch.schema.get_field_index(c)) if c in kept else made[c] for c in schema.names]
                yield pa.RecordBatch.from_arrays([_as(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def _as(column, kind: pa.DataType) -> pa.Array:
    if not isinstance(column, pa.Array):
        return pa.array(column, type=kind)
    return column if column.type == kind else column.cast(kind)
