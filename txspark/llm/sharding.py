"""Documents dealt to shards by vector bin packing: bytes, tokens and rows balanced jointly.

Documents with equal texts are one group, placed as a whole where the dot product of its
size vector with a shard's residual capacity is highest. Groups that would fill half a shard
are cut by id hash. The few large groups are placed first and centrally; the others are
packed bucket by bucket inside Spark's tasks, largest first, each bucket against its share
of every shard's remaining capacity.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txspark.llm.common import stored

DIMENSIONS = ["bytes", "tokens", "rows"]


@dataclass(frozen=True)
class Plan:
    """A group over cut_share of a shard's target is cut into cut_parts; units over
    large_share are placed centrally, so there are at most shards * dimensions / large_share
    of these. weights: how much room left in each dimension counts in the dot product;
    sizes are to be equal first of all, tokens and rows as nearly as that allows."""

    shards: int = 8
    weights: tuple[float, ...] = (64.0, 1.0, 1.0)
    cut_share: float = 0.5
    cut_parts: int = 64
    large_share: float = 0.001
    units_per_bucket: int = 5_000
    rows_per_slot_bucket: int = 100_000
    least_slot_buckets: int = 64


def place(units: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """A shard for each unit (rows of size vectors), largest first; residual is used up.

    Among shards that can hold the unit, or among all if none can, the highest dot product
    wins, the lower shard number breaking ties.
    """
    out = np.zeros(len(units), np.int64)
    order = np.argsort(-units.max(axis=1, initial=0.0), kind="stable")
    for i in order:
        unit = units[i]
        fits = (residual >= unit).all(axis=1)
        dot = residual @ unit
        if fits.any():
            dot = np.where(fits, dot, -np.inf)
        shard = int(dot.argmax())
        out[i] = shard
        residual[shard] -= unit
    return out


def shard_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", plan: Plan = Plan()) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for every row; slots are gapless in a shard.

    Size is the text's UTF-8 bytes plus one. A null text counts as an empty one, in one
    group with it. Tokens are counted as words between spaces. Rows that repeat an id have
    slots of their own. Other columns are left out.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stored(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            (F.octet_length(body) - F.octet_length(F.replace(body, F.lit(" "), F.lit(""))) + 1).cast("long").alias("tokens"),
            F.unhex(F.sha2(body, 256)).alias("unit"),
        ),
        "rows",
    )
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = rows.agg(*sums).collect()[0]
    totals = np.array([max(total[d] or 0, 1) for d in DIMENSIONS], float)
    target = totals / plan.shards

    def over(share: float):
        return F.greatest(*[F.col(d) / F.lit(float(t)) for d, t in zip(DIMENSIONS, target, strict=True)]) > share

    # at most shards * dimensions / cut_share of them
    hot = [bytes(r[0]) for r in rows.groupBy("unit").agg(*sums).where(over(plan.cut_share)).select("unit").collect()]
    if hot:
        part = F.encode(F.pmod(F.xxhash64("doc_id"), F.lit(plan.cut_parts)).cast("string"), "UTF-8")
        rows = rows.withColumn("unit", F.when(F.col("unit").isin(hot), F.concat("unit", part)).otherwise(F.col("unit")))
    units = stored(rows.groupBy("unit").agg(*sums), "units")
    large = units.where(over(plan.large_share)).orderBy("unit").collect()
    unit_of = totals / np.sqrt(plan.weights)
    residual = np.repeat((target / unit_of)[None, :], plan.shards, axis=0)
    vectors = np.array([[r[d] for d in DIMENSIONS] for r in large], float).reshape(-1, len(DIMENSIONS)) / unit_of
    shards = place(vectors, residual)
    spark = docs.sparkSession
    central = spark.createDataFrame(
        [(bytearray(r["unit"]), int(s)) for r, s in zip(large, shards, strict=True)], "unit binary, shard int"
    )
    residual = np.maximum(residual, 0)
    rest = np.maximum(totals / unit_of - vectors.sum(axis=0), 1e-12)
    buckets = max(1, math.ceil(units.count() / plan.units_per_bucket))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("unit")
        sizes = group[DIMENSIONS].to_numpy(float) / unit_of
        room = residual * (sizes.sum(axis=0) / rest)
        return pd.DataFrame({"unit": group["unit"], "shard": place(sizes, room).astype(np.int32)})

    small = (
        units.where(~over(plan.large_share))
        .withColumn("bucket", F.pmod(F.xxhash64("unit"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(pack, "unit binary, shard int")
    )
    placed = stored(small.union(central), "placed")
    return _slots(rows.join(placed, "unit").select("doc_id", "size", "text_crc32", "shard"), int(total["rows"]), plan)


def _slots(rows: DataFrame, total: int, plan: Plan) -> DataFrame:
    """Adds gapless slots: each (shard, bucket of ids) is numbered by itself and shifted by
    the buckets before it."""
    buckets = max(plan.least_slot_buckets, math.ceil(total / plan.rows_per_slot_bucket))
    rows = stored(rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets))), "placed-rows")
    shifts = (
        rows.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("shift", F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n"))
        .select("shard", "bucket", "shift")
    )
    number = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32")) - 1
    return (
        rows.withColumn("number", number)
        .join(shifts, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("number") + F.col("shift")).cast("long").alias("slot"))
    )
