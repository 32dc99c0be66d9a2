"""Screening and cleaning of one big table in its own types, without one row per value.

Two passes over the deduplicated rows. The first needs no shuffle of values: counts, minimum and
maximum (constant columns exactly) and an estimate of distinct values. The second counts exactly,
for the target and for the few columns whose estimate is near the row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevet.functions.values import DTYPES, kind_of, present
from tablevet.limits import Limits
from tablevet.operators.profile import catalog_task
from tablevet.operators.screening import first_failure
from tablevet.session import staged
from tablevet.sources.fleet import flat_fields

# A sketch of 2^14 registers deviates by 0.8 %; ten deviations below the row count leave no
# identifier out of the exact count.
SKETCH_LG_REGISTERS = 14
CANDIDATE_SHARE = 0.9


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def features_only(df: DataFrame, target: str) -> DataFrame:
    return df.drop(target)


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    """Rows whose target is neither NULL nor NaN."""
    return df.na.drop(subset=[target])


def dedup_rows(df: DataFrame) -> DataFrame:
    """One row of each kind; copies are folded before the shuffle. NULL equals NULL."""
    return df.dropDuplicates()


def cleaned_rows(df: DataFrame, target: str) -> DataFrame:
    """Flat columns with NaN as NULL, without rows that lack the target or repeat another."""
    flat = df.select(*[present(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in flat_fields(df)])
    return dedup_rows(drop_missing_target(flat, target))


def table_stats(rows: DataFrame, target: str) -> dict[str, dict]:
    """Exact facts per column: rows, missing, constant, identifier; one record to the driver."""
    fields = rows.schema.fields
    exprs = [F.count("*").alias("rows")]
    for i, f in enumerate(fields):
        column = F.col(f"`{f.name}`")
        exprs += [
            F.count(column).alias(f"present_{i}"),
            (F.min(column) == F.max(column)).alias(f"constant_{i}"),
        ]
        if kind_of(f.dataType) not in "fd":
            sketch = F.hll_sketch_agg(column.cast("string"), SKETCH_LG_REGISTERS)
            exprs.append(F.hll_sketch_estimate(sketch).alias(f"estimate_{i}"))
    first = rows.agg(*exprs).first().asDict()
    n = first["rows"]
    candidates = [
        i
        for i, f in enumerate(fields)
        if f.name != target
        and kind_of(f.dataType) not in "fd"
        and first[f"present_{i}"] == n
        and first[f"estimate_{i}"] >= CANDIDATE_SHARE * n
    ]
    exact = {}
    if candidates:
        counts = [F.count_distinct(F.col(f"`{fields[i].name}`")).alias(str(i)) for i in candidates]
        exact = rows.agg(*counts).first().asDict()
    return {
        f.name: {
            "dtype": DTYPES[kind_of(f.dataType)],
            "n_rows": n,
            "n_missing": n - first[f"present_{i}"],
            "is_constant": bool(first[f"constant_{i}"]),
            "is_id": n > 1 and exact.get(str(i)) == n,
        }
        for i, f in enumerate(fields)
    }


def sparse_columns(stats: dict[str, dict], target: str, max_missing_share: float = 0.5) -> list[str]:
    return [
        name
        for name, s in stats.items()
        if name != target and s["n_rows"] and s["n_missing"] / s["n_rows"] > max_missing_share
    ]


def constant_columns(stats: dict[str, dict], target: str) -> list[str]:
    return [name for name, s in stats.items() if name != target and s["is_constant"]]


def id_columns(stats: dict[str, dict], target: str) -> list[str]:
    return [name for name, s in stats.items() if name != target and s["is_id"]]


def clean_table(df: DataFrame, target: str, limits: Limits = Limits()) -> DataFrame:
    """The table without missing targets, copies, and sparse, constant and identifier columns.

    The cleaned rows are staged, so the shuffle of whole rows runs once and the statistics read
    single columns of a Parquet table.
    """
    rows = staged(cleaned_rows(df, target), "clean-rows")
    stats = table_stats(rows, target)
    dropped = {
        *sparse_columns(stats, target, limits.max_missing_share),
        *constant_columns(stats, target),
        *id_columns(stats, target),
    }
    return drop_columns(rows, sorted(dropped))


def gate_table(df: DataFrame, cleaned: DataFrame, target: str, limits: Limits = Limits()) -> DataFrame:
    """One row with status and reason of a cleaned table; ``df`` is the raw table."""
    dtype = DTYPES[kind_of(df.schema[target].dataType)]
    raw_rows = F.lit(df.count())
    classes = cleaned.groupBy(target).agg(F.count("*").alias("_n"))
    record = classes.agg(
        F.count("*").alias("n_classes"),
        F.min("_n").alias("smallest_class"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_instances"),
    ).select(
        catalog_task(F.lit(dtype), F.col("n_classes"), raw_rows, limits).alias("task"),
        F.lit(target).alias("target_variable"),
        "n_classes",
        "smallest_class",
        "n_instances",
        F.lit(len(cleaned.columns) - 1).cast("bigint").alias("n_features"),
    )
    return record.withColumn("reason", first_failure(limits)).withColumn(
        "status", F.when(F.col("reason").isNull(), "validated").otherwise("rejected")
    )
