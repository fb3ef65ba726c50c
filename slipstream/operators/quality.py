"""Checks of the data and of its freshness, and the log of training runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.schemas import RUNS


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, nulls and share of nulls, in one pass."""
    counted = df.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    rate = F.col("nulls") / F.nullif(F.col("rows").cast("double"), F.lit(0.0))
    return (
        counted.unpivot(["rows"], list(columns), "column_name", "nulls")
        .select("column_name", "rows", "nulls", rate.alias("null_rate"))
    )


def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule: how many rows break it. A rule that is unknown (null) is not broken."""
    counted = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


def missing_keys(expected: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Expected keys that no row has."""
    return expected.select(key).distinct().join(df.select(key).distinct(), key, "left_anti")


def freshness(datasets: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """One row per dataset: rows, latest date and distinct keys. Values are (table, date, key)."""
    rows = [
        df.agg(
            F.count("*").alias("rows"), F.max(F.col(date)).cast("date").alias("latest"),
            F.count_distinct(F.col(key)).alias("distinct_keys"),
        ).select(F.lit(name).alias("dataset"), "*")
        for name, (df, date, key) in datasets.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def file_freshness(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per Parquet dataset: number of files, bytes and time of the latest change."""
    out = None
    for name, path in paths.items():
        files = (
            spark.read.parquet(path)
            .select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
            .distinct()
        )
        row = files.agg(
            F.count("*").alias("files"), F.sum("file_size").alias("bytes"),
            F.max("file_modification_time").alias("modified"),
        ).select(F.lit(name).alias("dataset"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def log_run(
    spark: SparkSession, path: str, run_id: str, metrics: DataFrame,
    params: dict[str, object], n_features: int,
) -> None:
    """Append one training run; ``metrics`` is an ``evaluation`` row."""
    plain = {k: str(v) for k, v in params.items() if isinstance(v, (bool, int, float, str))}
    entries = [item for pair in plain.items() for item in map(F.lit, pair)]
    row = metrics.select(
        F.lit(run_id).alias("run_id"), F.current_timestamp().cast("timestamp_ntz").alias("logged_at"),
        (F.create_map(*entries) if entries else F.lit(None)).cast("map<string,string>").alias("params"),
        "auc_roc", "f1_score", "average_precision", F.lit(int(n_features)).alias("n_features"),
    )
    row.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def best_run(runs: DataFrame, metric: str = "auc_roc", run_id: str = "run_id") -> DataFrame:
    """The run with the highest metric; the smaller id wins ties. Empty if there are none."""
    scored = runs.where(F.col(metric).isNotNull())
    # Among the runs with the best metric take the smallest id: two aggregates, no sort.
    top = scored.where(F.col(metric) == scored.select(F.max(metric)).scalar())
    return (
        top.agg(F.min_by(F.struct(*runs.columns), F.col(run_id)).alias("r"))
        .where(F.col("r").isNotNull()).select("r.*")
    )
