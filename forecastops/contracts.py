"""Fixed schemas of the landing tables, and the checks made when writing to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY_MAP = T.MapType(T.StringType(), T.StringType())
METRIC_MAP = T.StructType(
    [
        T.StructField("bin_number", T.IntegerType()),
        T.StructField("bin_low", T.DoubleType()),
        T.StructField("bin_high", T.DoubleType()),
        T.StructField("bin_count", T.LongType()),
        T.StructField("bin_prop", T.DoubleType()),
    ]
)


def _fields(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in spec])


_MODEL = [
    ("record_id", T.StringType()),
    ("model_name", T.StringType()),
    ("model_version", T.StringType()),
    ("entity_map", ENTITY_MAP),
    ("week", T.IntegerType()),
]
_CELL = [("aggregated_col", T.StringType()), ("aggregated_value", T.StringType()), ("metric_col", T.StringType())]
_STAMP = [("calmonth", T.StringType()), ("ldts", T.TimestampType())]
_UNIT = [("bkcc", T.StringType()), *_STAMP]
_ALERT = [
    ("warning_threshold", T.DoubleType()),
    ("critical_threshold", T.DoubleType()),
    ("alert_level", T.IntegerType()),
]

PREDICTIONS = _fields([*_MODEL, ("prediction", T.DoubleType()), *_UNIT])
HISTOGRAMS = _fields([*_MODEL, *_CELL, ("metric_map", METRIC_MAP), *_STAMP])
DRIFT = _fields([*_MODEL, *_CELL, ("metric_value", T.DoubleType()), *_ALERT, *_UNIT])
PERFORMANCE_BASELINE = _fields([*_MODEL, *_CELL, ("metric_value", T.DoubleType()), *_UNIT])
PERFORMANCE = _fields(
    [*_MODEL, *_CELL, ("metric_value", T.DoubleType()), ("metric_drift", T.DoubleType()), *_ALERT, *_UNIT]
)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a contract: contract order and types, absent columns null, unknown columns refused."""
    unknown = sorted(set(df.columns) - set(schema.names))
    if unknown:
        raise ValueError(f"columns outside the contract: {unknown}")
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )
