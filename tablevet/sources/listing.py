"""Repository listing: the ranged scan, and the gates that need no data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevet.functions.naming import sanitize_name
from tablevet.operators.boxes import box_join, in_ranges, merged_ranges


@dataclass(frozen=True)
class Bounds:
    # The default search bounds.
    min_rows: int = 500
    max_rows: int = 10_000
    min_features: int = 5
    max_features: int = 100
    n_classes: int | None = None


def scan_listing(listing: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Active candidates inside the bounds; plain comparisons, so Parquet prunes row groups."""
    found = listing.where(
        F.col("n_instances").between(bounds.min_rows, bounds.max_rows)
        & F.col("n_features").between(bounds.min_features, bounds.max_features)
        & (F.col("status") == "active")
    )
    return found if bounds.n_classes is None else found.where(F.col("n_classes") == bounds.n_classes)


def scan_by_collection(listing: DataFrame, bounds: DataFrame) -> DataFrame:
    """Active candidates inside the bounds of each collection, with its ``collection_id``.

    ``bounds`` comes from ``collection_bounds``. The ranges of all collections are merged to disjoint
    ones, which reach the Parquet scan; the rows that pass are joined to the collections they lie in.
    """
    kept = listing.where(F.col("status") == "active")
    ranges = bounds.select("collection_id", "n_classes", *[
        F.col(f"{end}_{short}").alias(f"{end}_{field}")
        for short, field in (("rows", "n_instances"), ("features", "n_features"))
        for end in ("min", "max")
    ]).withColumnRenamed("n_classes", "_n_classes")
    for field in ("n_instances", "n_features"):
        kept = kept.where(in_ranges(F.col(field), merged_ranges(ranges, field)))
    found = box_join(kept, ranges, ["n_instances", "n_features"])
    found = found.where(F.col("_n_classes").isNull() | (F.col("n_classes") == F.col("_n_classes")))
    return found.select("collection_id", *listing.columns)


def first_text(*names: str) -> Column:
    """First of the columns that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names])


def licensed(listing: DataFrame) -> DataFrame:
    """Candidates with some license and some citation."""
    return listing.where(
        first_text("licence", "license").isNotNull() & first_text("citation", "paper_url").isNotNull()
    )


def non_empty(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("n_instances") > 0)


def listing_latest(listing: DataFrame) -> DataFrame:
    """One listing row per folder name: the one with the highest ``did``.

    ``max_by`` folds each name's rows before the shuffle, however often the name occurs.
    """
    named = listing.withColumn("dataset_id", sanitize_name(F.col("name")))
    fields = F.struct(*[F.col(c) for c in listing.columns])
    return (
        named.groupBy("dataset_id")
        .agg(F.max_by(fields, "did").alias("_row"))
        .select("dataset_id", "_row.*")
    )
