"""The catalog: academic metadata, flat rows, status, missing sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevet.functions.naming import display_name
from tablevet.sources.fleet import KEY
from tablevet.sources.listing import Bounds, first_text, listing_latest, scan_listing


def with_academic(catalog: DataFrame, listing: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Citation, paper and license of each dataset, by folder name; ``unknown`` where absent.

    Only active candidates inside the bounds count, so an inactive one of the same name gives nothing."""
    known = listing_latest(scan_listing(listing, bounds)).select(
        "dataset_id",
        first_text("citation").alias("citation"),
        first_text("paper_url").alias("paper_url"),
        first_text("licence", "license").alias("license"),
    )
    unknown = F.lit("unknown")
    return catalog.join(known, "dataset_id", "left").withColumns(
        {c: F.coalesce(c, unknown) for c in ("citation", "paper_url", "license")}
    )


def catalog_profiles(profiles: DataFrame, listing: DataFrame) -> DataFrame:
    """Profile records with name, academic metadata and status."""
    return with_academic(profiles, listing).select(
        "dataset_id",
        "collection_id",
        display_name(F.col("dataset_id")).alias("name"),
        F.struct("citation", "paper_url", "license").alias("academic_meta"),
        "task",
        "structure",
        "feature_types",
        "data_quality",
        F.lit("cataloged").alias("status"),
    )


def flatten_profile(profiles: DataFrame) -> DataFrame:
    """Flat ledger row of each profile record."""
    return profiles.select(
        *KEY,
        F.col("structure.n_instances").alias("n_instances"),
        F.col("structure.n_features").alias("n_features"),
        F.col("structure.missing_rate").alias("missing_rate"),
        (F.size("data_quality.constant_columns") > 0).alias("has_constants"),
        (F.size("data_quality.high_cardinality_columns") > 0).alias("has_high_cardinality"),
        (F.col("academic_meta.citation") != "unknown").alias("has_citation"),
        F.col("academic_meta.license").alias("license"),
        "status",
        F.concat_ws("/", F.lit("raw"), *KEY).alias("data_path"),
        F.concat_ws("/", F.lit("profiles"), *KEY).alias("profile_path"),
    )


def with_target(catalog: DataFrame, profiles: DataFrame) -> DataFrame:
    """Target column of each catalog entry; ``unknown`` without a profile."""
    targets = profiles.select(*KEY, F.col("task.target_variable").alias("target_variable"))
    return catalog.join(targets, KEY, "left").withColumn(
        "target_variable", F.coalesce("target_variable", F.lit("unknown"))
    )


def missing_source(catalog: DataFrame, present: DataFrame) -> DataFrame:
    """Catalog entries without data."""
    return catalog.join(present.select(*KEY), KEY, "left_anti")


def apply_status(catalog: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Catalog with the outcome's status where there is one."""
    new = outcomes.select(*KEY, F.col("status").alias("_status"))
    return catalog.join(new, KEY, "left").withColumn(
        "status", F.coalesce("_status", "status")
    ).drop("_status")


def with_status(catalog: DataFrame, status: str) -> DataFrame:
    return catalog.where(F.col("status") == status)
