"""Session helpers: local sessions for tests, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side is broadcast only after counting it and finding at most this many rows, of this many bytes together.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def build_session(app: str = "forecastops", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on.

    AQE stays on (coalescing, skew-join splitting, runtime broadcast) and the session zone is UTC so that
    week and day boundaries do not depend on the machine.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where the cluster names one.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="forecastops-")
    context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written rows.

    Used where a frame is read more than once and must give the same rows each time, also when executors are lost.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table of its own in the shared folder and read it back.

    Like :func:`cut` for wide frames that are read several times: later reads take only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def python_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Within it, plans hand Python functions rows in batches of about ``size``, not of 10,000 rows whatever their length.

    Executor and worker each hold a batch, and the worker makes objects of it, so its size decides the memory of work on texts.
    Only for jobs that run inside: a frame that is computed later takes the setting of then. A group of ``applyInPandas`` stays
    whole.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: text and array lengths, 8 for anything else."""
    sizes = []
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            sizes.append(F.octet_length(c))
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            flat = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType)
            sizes.append(F.size(c) * 8 if flat else F.octet_length(F.to_json(c)))
        elif isinstance(kind, T.StructType):
            sizes.append(F.octet_length(F.to_json(c)))
    fixed = F.lit(8 * len(df.columns) + 8).cast("long")
    return reduce(lambda a, b: a + b, [F.greatest(F.coalesce(s.cast("long"), F.lit(0)), F.lit(0)) for s in sizes], fixed)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if its rows and bytes prove it small; otherwise leave the join strategy to Spark.

    Pass a frame that is cheap to evaluate twice, such as the result of :func:`cut`.
    """
    # only the sizes of the rows meet in one place, not the rows
    some = df.select(_row_bytes(df).alias("b")).limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum("b").alias("b")).first()
    if some.n <= max_rows and (some.b or 0) <= max_bytes:
        return F.broadcast(df)
    return df


def lookup(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Compute a small result once (:func:`cut`) and hand it over as a checked broadcast side."""
    return small_side(cut(df), max_rows)
