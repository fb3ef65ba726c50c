"""Reading files whose rows may be bad, with every dropped row kept and its reason.

The plain readers null what they cannot parse and the cleaning step drops rows without keys. Here
the same rows leave with a reason instead: the file is parsed once, the rows are written once, by
reason, and accepted and rejected rows together are the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipstream.functions.columns import first_match
from slipstream.operators.staging import shared_folder

RAW_LINE = "raw_line"
REASON = "reject_reason"
BAD_NUMBERS = "bad_numbers"
ACCEPTED = "accepted"


def read_permissive(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV rows as ``schema`` has them, and the whole line where a field does not fit its type or
    the number of fields is wrong (else null)."""
    wide = T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType(), True)])
    return (
        spark.read.schema(wide).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW_LINE).csv(path)
    )


def reason(keys: Sequence[str]) -> Column:
    """Why a row is dropped, or null: the first key it lacks, or that its line does not parse.

    A key that does not parse counts as unreadable, not as missing.
    """
    return first_match(
        [(F.col(RAW_LINE).isNotNull(), "unreadable line")]
        + [(F.col(k).isNull(), f"no {k}") for k in keys]
    )


def bad_numbers(measures: Sequence[str]) -> Column:
    """Names of the measures that hold text which is no number; such rows stay, with a null there."""
    return F.filter(F.array(*[
        F.when(F.col(m).isNotNull() & F.col(m).try_cast("double").isNull(), F.lit(m)) for m in measures
    ]), lambda m: m.isNotNull())


def split(
    rows: DataFrame, keys: Sequence[str], measures: Sequence[str] = (), folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of ``read_permissive``, from one pass over the file.

    Both are read back from ``folder`` (default: a new one below the shared folder), which holds a
    directory per outcome. Accepted rows have the columns of the file's schema and ``bad_numbers``,
    rejected rows also ``raw_line`` and ``reject_reason``. An empty file gives two empty tables.
    """
    spark = rows.sparkSession
    folder = folder or f"{shared_folder(spark)}/rejects-{uuid.uuid4().hex}"
    judged = rows.withColumns({
        BAD_NUMBERS: bad_numbers(measures) if measures else F.array().cast("array<string>"),
        REASON: reason(keys),
    }).withColumn("outcome", F.when(F.col(REASON).isNull(), ACCEPTED).otherwise("rejected"))
    # Files hold the rows of one outcome: reading the accepted rows opens no rejected ones.
    judged.write.partitionBy("outcome").parquet(folder)
    kept = T.StructType([f for f in judged.schema.fields if f.name != "outcome"])
    both = spark.read.schema(T.StructType([*kept.fields, T.StructField("outcome", T.StringType())])).parquet(folder)
    good, bad = F.col("outcome") == ACCEPTED, F.col("outcome") == "rejected"
    return both.where(good).drop("outcome", RAW_LINE, REASON), both.where(bad).drop("outcome")


def summary(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows per outcome and reason, and accepted rows per measure that was no number."""
    return (
        rejected.groupBy(F.lit("rejected").alias("outcome"), F.col(REASON).alias("detail"))
        .agg(F.count("*").alias("n"))
        .unionByName(accepted.agg(F.count("*").alias("n")).select(
            F.lit(ACCEPTED).alias("outcome"), F.lit(None).cast("string").alias("detail"), "n"))
        .unionByName(accepted.select(F.explode(BAD_NUMBERS).alias("detail")).groupBy("detail").agg(
            F.count("*").alias("n")).select(F.lit("bad number").alias("outcome"), "detail", "n"))
    )
