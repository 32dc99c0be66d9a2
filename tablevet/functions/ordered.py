"""Running sums and ranks that never put one group into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablevet.session import staged


def running_sums(df: DataFrame, by: list[str], order: list, sums: dict[str, str]) -> DataFrame:
    """Add inclusive running sums within ``by`` along ``order``, which must be a total order.

    ``sums`` maps a new column to its source; ``<name>_total`` holds the sum of the whole group.

    A window over a group that holds a third of all rows would sort that third in one task. Here
    the rows are range partitioned on (by, order) so that a big group spans many chunks; the
    chunk totals (one row per group and chunk) give each chunk its offset. The chunk numbers are
    fixed by a staged table, because a second evaluation could draw other range bounds.
    """
    chunks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = df.repartitionByRange(chunks, *by, *order).withColumn("_chunk", F.spark_partition_id())
    ranged = staged(ranged, "ranged")

    parts = ranged.groupBy(*by, "_chunk").agg(
        *[F.sum(source).alias(name) for name, source in sums.items()]
    )
    group = Window.partitionBy(*by)
    before = group.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *[F.col(c).alias(f"_by_{c}") for c in [*by, "_chunk"]],
        *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"_before_{name}") for name in sums],
        *[F.sum(name).over(group).alias(f"{name}_total") for name in sums],
    )
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    same.append(F.col("_chunk") == F.col("_by__chunk"))
    inside = (
        Window.partitionBy(*by, "_chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return ranged.join(offsets, reduce(lambda a, b: a & b, same)).select(
        *df.columns,
        *[
            (F.col(f"_before_{name}") + F.sum(source).over(inside)).alias(name)
            for name, source in sums.items()
        ],
        *[f"{name}_total" for name in sums],
    )


def ranked(df: DataFrame, by: list[str], order: list, name: str) -> DataFrame:
    """Row number within ``by`` along the total order ``order``; ``<name>_total`` is the group size."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_sums(counted, by, order, {name: "_one"}).drop("_one")
