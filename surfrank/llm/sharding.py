"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records with seeded hashes into buckets that fit in
memory; pass 2 brings each bucket into one task, puts it in a canonical
order, runs a seeded Fisher-Yates shuffle over it and writes it.  A shard
is a run of such buckets, so a shard may be of any size.

The shard of a record is decided by its id and the number of shards alone
(law ``key``): the shard whose seeded hash with the id is highest.  One
shard more takes records only into itself.  The bucket inside the shard
also hashes the whole row, so rows that share an id spread over buckets.
The number of buckets follows from the measured bytes.

Cases: null ids hash like any value; null text counts no bytes; an empty
table writes no rows; repeated rows get slots of their own; input columns
named like the added ones (``shard``, ``slot``) keep their values under
the name with an underscore in front.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

BUCKET_BYTES = 16 << 20
ROW_BYTES = 16


def shard_of(id_col: Column, shards: int, seed: int = 0) -> Column:
    """Shard from 0 to ``shards - 1`` by highest seeded hash."""
    scores = [F.struct(F.xxhash64(F.lit(seed), F.lit(i), id_col).alias("h"), F.lit(i).alias("i")) for i in range(shards)]
    return F.greatest(*scores)["i"] if shards > 1 else F.lit(0)


def record_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _whole_row(df: DataFrame) -> Column:
    def hashable(t: T.DataType) -> bool:
        if isinstance(t, T.ArrayType):
            return hashable(t.elementType)
        if isinstance(t, T.StructType):
            return all(hashable(f.dataType) for f in t)
        return not isinstance(t, (T.MapType, T.VariantType))

    cols = [F.col(f"`{f.name}`") if hashable(f.dataType) else F.to_json(f"`{f.name}`") for f in df.schema]
    return F.xxhash64(*cols) if cols else F.lit(0)


def _shuffler(seed: int, schema: pa.Schema | None = None):
    def shuffle(key: tuple, rows: pa.Table) -> pa.Table:
        shard, bucket = (x.as_py() for x in key)
        rows = rows.sort_by([("_row", "ascending"), ("_size", "ascending")])
        order = np.arange(rows.num_rows)
        draw = np.random.Generator(np.random.PCG64([seed, shard, bucket]))
        last = np.arange(rows.num_rows - 1, 0, -1)
        for i, j in zip(last, draw.integers(0, last + 1), strict=True):  # Fisher-Yates
            order[i], order[j] = order[j], order[i]
        out = rows.take(pa.array(order))
        slot = pa.array(np.arange(rows.num_rows, dtype=np.int64) + (rows["_offset"][0].as_py() if rows.num_rows else 0))
        return out.drop_columns(["_bucket", "_row", "_size", "_offset", "_shard"]).append_column(
            "shard", pa.array([shard] * rows.num_rows, pa.int32())
        ).append_column("slot", slot)

    return shuffle


def shuffled(
    df: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 0,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``df`` with ``shard`` and ``slot`` (gapless from 0 in each shard), in random order."""
    names = list(df.columns)
    for name in ("shard", "slot"):
        if name in names:
            at = names.index(name)
            while names[at] in (*names[:at], *names[at + 1 :], name):
                names[at] = "_" + names[at]
    ship(df.sparkSession)
    given, text = F.col(f"c{df.columns.index(id_col)}"), F.col(f"c{df.columns.index(text_col)}")
    df = df.toDF(*[f"c{i}" for i in range(len(names))])  # names of the input cannot clash with those used here
    size = record_bytes(text)
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    marked = df.withColumns({"_row": _whole_row(df), "_size": size, "_shard": shard_of(given, shards, seed)}).withColumn(
        "_bucket", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("_row")), F.lit(buckets)).cast("long")
    )
    counts = marked.groupBy("_shard", "_bucket").count()
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_shard", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    schema = T.StructType([*df.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    out = marked.join(offsets, ["_shard", "_bucket"]).groupBy("_shard", "_bucket").applyInArrow(_shuffler(seed), schema)
    return out.toDF(*names, "shard", "slot")


def write_shards(df: DataFrame, path: str, shards: int, **options) -> None:
    """Write ``shuffled`` as one folder of Parquet files for each shard, rows in slot order."""
    shuffled(df, shards, **options).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
