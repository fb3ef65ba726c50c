"""Uniform shuffle into shards of exact size, by a communication matrix.

The rows of every input partition get a random order. How many of them go to which shard is drawn
exactly: the matrix (partition x shard) follows the multivariate hypergeometric law, partition by
partition, from what the shards still lack. So shard sizes are exact and every assignment of rows
to shards is equally likely. The first rows of the partition's order go to shard 0, the next ones
to shard 1, and so on; within its shard a row gets its slot from a second random order.

Only the matrix is made outside Spark: one count per partition comes to the driver, and the drawn
rows go back as a table that is as long as the input has partitions. Everything else is DataFrame
operations. The second order is cut into buckets of a shard (the first bits of a random number),
so that no task sorts a whole shard; bucket counts give the slots before each bucket.

The input is written once with the place of every row, so that repeated tasks see the same rows in
the same place. Row numbers, not values, drive the draw: null and equal rows need no special case,
and ids may repeat; texts are moved whole and not read. An empty table gives no rows. Columns called
``shard`` or ``slot`` are replaced, all others pass through, whatever their names.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slipstream.llm.common import packed, unpacked, written

# Rows of a bucket in which one task puts the second order, about.
BUCKET_ROWS = 20_000
_IN_PART = (1 << 33) - 1


def matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows that each partition sends to each shard: exact row and column sums, uniform law."""
    total = sum(counts)
    lacking = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    draw, out = np.random.default_rng(seed), np.zeros((len(counts), shards), np.int64)
    for p, n in enumerate(counts):
        out[p] = draw.multivariate_hypergeometric(lacking, n, method="marginals")
        lacking -= out[p]
    return out


def shuffle(docs: DataFrame, shards: int = 8, seed: int = 1) -> DataFrame:
    """``docs`` with ``shard`` (sizes at most one apart) and ``slot`` (gapless from 0)."""
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    docs = packed(docs.select(*[F.col(f"`{c}`") for c in columns]), ())
    # A monotonically increasing id is the partition and the row's number in it.
    rows = written(
        docs.withColumn("_id", F.monotonically_increasing_id())
        .sortWithinPartitions(F.xxhash64(F.lit(seed), "_id"))
        .drop("_id").withColumn("_at", F.monotonically_increasing_id())
    )
    placed = rows.select(
        "*", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit(_IN_PART)).alias("_row")
    )
    counts = [(r["_part"], r["count"]) for r in placed.groupBy("_part").count().orderBy("_part").collect()]
    drawn = matrix([n for _, n in counts], shards, seed)
    table = json.dumps([
        {"_part": p, "_ends": np.cumsum(row).tolist()} for (p, _), row in zip(counts, drawn)
    ])
    ends = spark.range(1).select(
        F.explode(F.from_json(F.lit(table), "array<struct<_part:bigint,_ends:array<bigint>>>")).alias("x")
    ).select("x.*")
    buckets = max(1, sum(n for _, n in counts) // (shards * BUCKET_ROWS))
    sent = placed.join(F.broadcast(ends), "_part").select(
        "_other", "_at",
        F.size(F.filter("_ends", lambda e: e <= F.col("_row"))).alias("shard"),
        F.xxhash64(F.lit(seed + 1), "_at").alias("_order"),
    ).withColumn("_bucket", F.expr(f"cast(shiftrightunsigned(_order, 32) * {buckets}L div 4294967296L as int)"))
    earlier = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sent.groupBy("shard", "_bucket").agg(F.count("*").alias("_n")).select(
        F.col("shard").alias("_s"), F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"),
    )
    # As many rows as buckets: the table is small against the rows, and joins by its size.
    first = written(first)
    inside = Window.partitionBy("shard", "_bucket").orderBy("_order", "_at")
    ranked = sent.withColumn("_rank", F.row_number().over(inside))
    return ranked.join(
        first, (F.col("shard") == F.col("_s")) & (F.col("_bucket") == F.col("_b"))
    ).select(*unpacked(columns, ()), "shard", (F.col("_first") + F.col("_rank") - 1).alias("slot"))
