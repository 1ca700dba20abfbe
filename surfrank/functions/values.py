"""Small driver-side row lists as a local relation (``VALUES``), without Python workers.

``spark.createDataFrame(list)`` builds its rows through a Python RDD, so every
use of the DataFrame starts Python workers.  The lists handled here are
bounded (hub keys, hub ranks: at most ``max_hot`` rows) and are written as a
SQL ``VALUES`` relation instead, which Spark keeps on the driver and can
broadcast without running a job.  Literals are exact: text as its UTF-8
bytes in hex, doubles by their shortest round-trip representation.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


def sql_literal(value, dtype: T.DataType) -> str:
    if value is None:
        return f"cast(null as {dtype.simpleString()})"
    if isinstance(dtype, T.StringType):
        return f"cast(X'{str(value).encode('utf-8').hex()}' as string)"
    if isinstance(dtype, _INTEGRAL):
        return f"cast({int(value)} as {dtype.simpleString()})"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        v = float(value)
        text = f"{v!r}D" if math.isfinite(v) else f"cast('{v}' as double)"
        return text if isinstance(dtype, T.DoubleType) else f"cast({text} as float)"
    if isinstance(dtype, T.BooleanType):
        return "true" if value else "false"
    raise TypeError(f"no literal form for {dtype.simpleString()}")


def local_rows(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """``rows`` (tuples matching ``schema``) as a local ``VALUES`` relation."""
    names = ", ".join(f"`{f.name}`" for f in schema.fields)
    if not rows:
        nulls = ", ".join(f"{sql_literal(None, f.dataType)} as `{f.name}`" for f in schema.fields)
        return spark.sql(f"select {nulls} where false")
    body = ", ".join(
        "(" + ", ".join(sql_literal(v, f.dataType) for v, f in zip(row, schema.fields)) + ")" for row in rows
    )
    return spark.sql(f"select * from values {body} as t({names})")
