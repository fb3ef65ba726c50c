"""Near-duplicate vectors by cross-polytope hashing.

Every vector is turned by pseudo-random rotations (three rounds of sign flips and a fast Hadamard
transform). A rotation's code is the axis nearest to the turned vector, one of twice the padded
dimension. A table joins the codes of ``AXES`` rotations to a bucket; with the ``PROBES`` nearest
axes of each rotation a vector lies in PROBES ** AXES buckets of a table. At cosine 0.95 in 64
dimensions two vectors share a bucket of one table with probability 0.78, so the default ten
tables miss 3 pairs in ten million; nearer pairs are missed less.

Buckets with one vector are dropped after counting. Vectors of buckets with more than ``DENSE`` are
held against the mean of their fullest bucket. Those within half the angle of a link form its core:
by the triangle inequality each of them is linked to all others, so their links are the size of
the core, and no pairs are made. A bucket is cut into blocks, and pairs of blocks are worked
through one after another, but for those that hold only the core: cosines in double precision, then
for every link a test that this is the first bucket the two share, so that it is counted once. What
leaves a task is one row per vector with its number of links, and the links of a spanning forest,
not the pairs.

Vectors that are null, zero, of another length than ``dims``, or hold null or non-finite
components link with nothing. Equal vectors, also under one id, are different vectors; rows that
share an id are one node of the links, and each gets the links of all of them. Rows without an id
link with nothing. Other columns are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm.common import importable, pairs_within, whole_groups, with_names, written
from slipstream.llm.components import components, spanning

TABLES, AXES, PROBES, SEED = 10, 3, 2, 7
# Most vectors of one bucket that a task holds of each side.
BLOCK = 1_024
# Vectors of a bucket from which on a core is looked for; results do not depend on it.
DENSE = 256


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row; the length is a power of two."""
    step, out = 1, rows
    while step < rows.shape[1]:
        pair = out.reshape(len(out), -1, 2, step)
        out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(len(out), -1)
        step *= 2
    return out


def buckets(unit: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """Buckets (rows x tables x PROBES ** AXES) of unit vectors."""
    width = 1 << max(1, (unit.shape[1] - 1).bit_length())
    padded = np.zeros((len(unit), width))
    padded[:, :unit.shape[1]] = unit
    draw, out = np.random.default_rng(SEED), []
    for _ in range(tables):
        joined = np.zeros((len(unit), 1), np.int64)
        for _ in range(AXES):
            turned = padded
            for signs in draw.choice([-1.0, 1.0], (3, width)):
                turned = hadamard(turned * signs)
            axes = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :PROBES]
            codes = 2 * axes + (np.take_along_axis(turned, axes, 1) < 0)
            joined = (joined[:, :, None] * (2 * width) + codes[:, None, :]).reshape(len(unit), -1)
        out.append(joined)
    return np.stack(out, 1)


def _cores(units: DataFrame, posted: DataFrame, dense: DataFrame, dims: int, threshold: float) -> DataFrame:
    """(row, vec_id, core): vectors within half the angle of a link from the mean of their fullest bucket."""
    half = max(0.0, (1 + threshold) / 2) ** 0.5 + 1e-9

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            unit = np.frombuffer(b"".join(rows["unit"]), np.float64).reshape(len(rows), dims)
            cores, place = np.unique(rows["core"].to_numpy(), return_inverse=True)
            total = np.zeros((len(cores), dims))
            np.add.at(total, place, unit)
            yield pd.DataFrame({"core": cores, "total": list(total)})

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            unit = np.frombuffer(b"".join(rows["unit"]), np.float64).reshape(len(rows), dims)
            centre = np.array(rows["centre"].tolist(), np.float64).reshape(len(rows), dims)
            near = np.einsum("ij,ij->i", unit, centre) >= half * np.linalg.norm(centre, axis=1)
            yield rows.loc[near & centre.any(axis=1), ["row", "vec_id", "core"]]

    homes = posted.join(dense, "bucket").groupBy("row").agg(F.max(F.struct("n", "bucket")).alias("x"))
    rows = written(units.join(homes, "row").select("row", "vec_id", "unit", F.col("x.bucket").alias("core")))
    # A mean is added up per batch, then by place: no task sees all vectors of a bucket.
    parts = rows.select("core", "unit").mapInPandas(sums, "core long, total array<double>")
    centres = parts.select("core", F.posexplode("total").alias("at", "x")).groupBy("core", "at").agg(
        F.sum("x").alias("x")
    ).groupBy("core").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("all")).select(
        "core", F.transform("all", lambda p: p["x"]).alias("centre")
    )
    return written(rows.join(written(centres), "core").mapInPandas(inside, "row long, vec_id long, core long"))


def link(vectors: DataFrame, dims: int, threshold: float = 0.95, tables: int = TABLES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for ``vectors(vec_id, embedding)``.

    Linked are rows with cosine of at least ``threshold``; ``component_id`` is the smallest vec_id
    reachable, ``kept`` marks the vector that has it.
    """
    importable(vectors.sparkSession)
    every = with_names(vectors, ["vec_id", "embedding"]).withColumn("vec_id", F.col("vec_id").cast("long"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("embedding").to_pylist(), np.float64).reshape(-1, dims)
            unit = rows / np.abs(rows).max(axis=1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            codes = buckets(unit, tables).reshape(len(rows), -1).astype(np.int32) if len(rows) else np.zeros((0, 1), np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array([u.tobytes() for u in unit], pa.binary()),
                pa.array(list(codes), pa.list_(pa.int32())),
            ], ["vec_id", "unit", "codes"])

    fit = every.where("vec_id is not null and embedding is not null").where(
        (F.size("embedding") == dims)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    ).withColumn("embedding", F.col("embedding").cast("array<double>"))
    # A row number tells apart rows of one id; the table is written, so it stays.
    units = written(fit.mapInArrow(hashed, "vec_id long, unit binary, codes array<int>").withColumn(
        "row", F.monotonically_increasing_id()
    ))
    probes = PROBES ** AXES
    posted = units.select("row", F.posexplode("codes").alias("at", "code")).select(
        "row", (F.floor(F.col("at") / probes) * (1 << 32) + F.col("code")).cast("long").alias("bucket")
    )
    counted = written(posted.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    dense = counted.where(F.col("n") > DENSE)
    cores = _cores(units, posted, dense, dims, threshold)
    tagged = posted.join(cores.select("row", "core"), "row", "left")
    # The largest core of each bucket has its own blocks, behind those of all other vectors.
    most = tagged.where("core is not null").join(dense, "bucket", "left_semi").groupBy("bucket", "core").agg(
        F.count("*").alias("m")
    ).groupBy("bucket").agg(F.max(F.struct("m", "core")).alias("x"))
    inner = F.coalesce("x.m", F.lit(0))
    blocks = written(counted.join(most, "bucket", "left").select(
        "bucket", F.col("x.core").alias("main"),
        F.ceil((F.col("n") - inner) / BLOCK).cast("int").alias("outer"), F.ceil(inner / BLOCK).cast("int").alias("inner"),
    ))
    # A vector of block i meets all blocks: it is sent to the pair (i, j) for every j. Vectors of
    # the core only meet the others.
    is_main = F.coalesce(F.col("core") == F.col("main"), F.lit(False))
    number = F.xxhash64("row")
    sent = tagged.join(blocks, "bucket").withColumn("meets", F.when(is_main, F.col("outer")).otherwise(
        F.col("outer") + F.col("inner")
    )).where("meets > 0").withColumn("own", F.when(
        is_main, F.col("outer") + F.pmod(number, F.greatest("inner", F.lit(1)))
    ).otherwise(F.pmod(number, F.greatest("outer", F.lit(1)))).cast("int"))
    sent = sent.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("meets") - 1))).select(
        "bucket", "row", F.coalesce("core", F.lit(-1)).alias("core"), "own",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
    )
    full = sent.join(units, "row")

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["bucket", "i", "j"]):
            bucket, own, core, name = (rows[c].to_numpy() for c in ("bucket", "own", "core", "vec_id"))
            across = (rows["i"] != rows["j"]).to_numpy()
            unit = np.frombuffer(b"".join(rows["unit"]), np.float64).reshape(len(rows), dims)
            codes = np.stack(rows["codes"].to_numpy()).reshape(len(rows), tables, probes)
            table, code = bucket >> 32, bucket & 0xFFFFFFFF
            links, ends = np.zeros(len(rows), np.int64), [[np.empty(0, np.int64)], [np.empty(0, np.int64)]]
            alike = lambda p, q: (
                (unit[p] @ unit[q].T >= threshold - 1e-9)
                & ((core[p, None] != core[q]) | (core[p, None] < 0))
                & (~across[p, None] | (own[p, None] != own[q]))
            )
            for p, q in pairs_within(rows, ["bucket", "i", "j"], test=alike):
                meet = (~across[p] | (own[p] != own[q])) & ((core[p] != core[q]) | (core[p] < 0))
                p, q = p[meet], q[meet]
                near = np.einsum("ij,ij->i", unit[p], unit[q]) >= threshold
                p, q = p[near], q[near]
                if not len(p):
                    continue
                # Counted in the first bucket that the two share.
                upto = int(table[p].max()) + 1
                shared = codes[p, :upto, :, None] == codes[q, :upto, None, :]
                before = np.arange(upto) < table[p][:, None]
                here = np.take_along_axis(shared.any(3), table[p][:, None, None], 1)[:, 0]
                lower = np.take_along_axis(codes[p], table[p][:, None, None], 1)[:, 0] < code[p][:, None]
                first = ~((shared.any((2, 3)) & before).any(1) | (here & lower).any(1))
                links += np.bincount(p[first], minlength=len(rows)) + np.bincount(q[first], minlength=len(rows))
                ends[0].append(p[first])
                ends[1].append(q[first])
            one, root = spanning(name, np.concatenate(ends[0]), np.concatenate(ends[1]))
            ids, place = np.unique(name, return_inverse=True)
            total = np.bincount(place, links, len(ids)).astype(np.int64)
            yield pd.DataFrame({"vec_id": ids, "links": total, "root": ids})[total > 0]
            yield pd.DataFrame({"vec_id": one, "links": np.zeros(len(one), np.int64), "root": root})

    met = full.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInPandas(
        linked, "vec_id long, links long, root long"
    )
    # In a core all are linked with each other.
    sizes = cores.groupBy("core").agg(F.count("*").alias("n"), F.min("vec_id").alias("root"))
    parts = written(met.union(cores.join(sizes, "core").select("vec_id", F.col("n") - 1, "root")))
    named = components(parts.where("vec_id <> root").select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    links = parts.groupBy("vec_id").agg(F.sum("links").alias("n"))
    out = every.select("vec_id").join(links, "vec_id", "left").join(
        named.withColumnRenamed("id", "vec_id"), "vec_id", "left"
    )
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
