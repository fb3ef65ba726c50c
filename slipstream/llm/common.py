"""Helpers that several operators of this package share."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.operators.staging import shared_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when their result has been written."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Sorted batches cut so that no group of equal keys is split; holds one group and a batch."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        if not len(batch):
            continue
        other = (batch[keys] != batch[keys].iloc[-1]).any(axis=1).to_numpy()
        cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if cut:
            yield batch.iloc[:cut].reset_index(drop=True)
        held = batch.iloc[cut:]
    if held is not None and len(held):
        yield held.reset_index(drop=True)


def pairs_within(
    rows: pd.DataFrame, keys: list[str], most: int = 65_536,
    test: Callable[[slice, slice], np.ndarray] | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions p < q of rows with equal keys in a sorted frame, about ``most`` pairs at a time.

    Pairs of large groups can be tested by blocks first; the test may let too many through.
    """
    starts = np.flatnonzero(np.r_[True, (rows[keys].to_numpy()[1:] != rows[keys].to_numpy()[:-1]).any(axis=1)])
    ends = np.r_[starts[1:], len(rows)]
    end_of, large = np.repeat(ends, ends - starts), (ends - starts) > 64
    small = np.flatnonzero(~np.repeat(large, ends - starts))
    for lag in range(1, 64):
        small = small[small + lag < end_of[small]]
        for at in range(0, len(small), most):
            yield small[at:at + most], small[at:at + most] + lag
    for a, b in zip(starts[large], ends[large]):
        step = max(1, most // (b - a))
        for at in range(a, b, step):
            p, q = np.meshgrid(np.arange(at, min(at + step, b)), np.arange(a, b), indexing="ij")
            keep = p < q
            if test is not None:
                keep &= test(slice(at, min(at + step, b)), slice(a, b))
            yield p[keep], q[keep]


def importable(spark: SparkSession) -> None:
    """Let Python tasks import this package from where the driver has it.

    That suffices if the folder is shared or the package is installed; otherwise ship it with
    ``--py-files``.
    """
    home, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in known:
        environment["PYTHONPATH"] = os.pathsep.join([home, *known])


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cut lineage, freed shuffle files.

    The table outlives executors. It stays until the folder is cleaned, because the returned
    DataFrame is read lazily.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    with freeing_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as UTF-8; no text has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def text_key(column: str = "text") -> Column:
    """64-bit key that tells apart rows of one id with different texts; null texts count as empty."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def with_names(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Only the wanted columns, so that other columns of the input cannot clash with ours."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"the input lacks the columns {missing}")
    return df.select(*wanted)


def packed(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """The needed columns, and all other columns in one called ``_other``, so that no names clash."""
    other = [c for c in df.columns if c not in needed]
    held = F.struct(*[F.col(f"`{c}`") for c in other]) if other else F.lit(0)
    return df.select(*needed, held.alias("_other"))


def unpacked(columns: Sequence[str], needed: Sequence[str]) -> list[Column]:
    """The columns of the input of ``packed``, in their order; needed ones as they are now."""
    return [F.col(c) if c in needed else F.col("_other").getField(c).alias(c) for c in columns]


def bit_table(slots: DataFrame, bits: int) -> DataFrame:
    """One row with ``2 ** bits`` bits as an array of numbers: those of ``slots(slot)`` are set."""
    marks = slots.groupBy(F.shiftright("slot", 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("mark")
    )
    every = slots.sparkSession.range(1 << (bits - 6)).select(F.col("id").cast("int").alias("at"))
    return every.join(marks, "at", "left").agg(
        F.sort_array(F.collect_list(F.struct("at", F.coalesce("mark", F.lit(0).cast("long")).alias("mark")))).alias("m")
    ).select(F.transform("m", lambda x: x["mark"]).alias("bits"))


def marked(bits: Column, slot: Column) -> Column:
    """Whether the slot of a bit table is set."""
    return F.getbit(F.get(bits, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(63).cast("int")) == 1


def semi_join(rows: DataFrame, keys: DataFrame, name: str, most: int = 25) -> DataFrame:
    """Rows whose ``name`` is among ``keys``, each once; most others go before the shuffle.

    They go by a bit table of the keys' hashes, of at most ``2 ** most`` bits. With too many keys for
    it the join is made without one; the rows are the same.
    """
    keys = written(keys.select(name).distinct())
    bits = max(12, (8 * keys.count()).bit_length())
    if bits <= most + 2:
        bits = min(bits, most)
        slot = F.shiftrightunsigned(F.xxhash64(name), 64 - bits)
        table = written(bit_table(keys.select(slot.alias("slot")).distinct(), bits))
        rows = rows.where(marked(table.scalar(), slot))
    return rows.join(keys, name, "left_semi")
