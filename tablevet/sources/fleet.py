"""The fleet: many tables with different schemas in one pair of DataFrames.

``rows``     collection_id, dataset_id, row_id, target_store, target_slot, longs, doubles, texts,
             fingerprint
``columns``  collection_id, dataset_id, ordinal, column_name, dtype, is_target, kind, declared, store, slot

A row keeps its values together, typed, in one array per store, so row-level work (missing targets,
duplicates) needs no regrouping. Names and types stay out of the shuffles: ``columns`` is joined to
per-column results by (store, slot). The place of the target travels with the row, because a join
on the dataset would move every row once more.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablevet.functions.values import (
    DTYPES,
    STORE_TYPES,
    STORES,
    as_text,
    declared_type,
    fingerprint_sql,
    kind_of,
    missing_sql,
    stored_sql,
    target_sql,
)

KEY = ["collection_id", "dataset_id"]

ROWS_SCHEMA = (
    "collection_id string, dataset_id string, row_id bigint, target_store string, target_slot int,"
    " longs array<bigint>, doubles array<double>, texts array<string>"
)

COLUMNS_SCHEMA = pa.schema(
    [
        ("collection_id", pa.string()),
        ("dataset_id", pa.string()),
        ("ordinal", pa.int32()),
        ("column_name", pa.string()),
        ("dtype", pa.string()),
        ("is_target", pa.bool_()),
        ("kind", pa.string()),
        ("declared", pa.string()),
        ("store", pa.string()),
        ("slot", pa.int32()),
    ]
)


@dataclass(frozen=True)
class Fleet:
    rows: DataFrame
    columns: DataFrame

    def union(self, *others: Fleet) -> Fleet:
        """Append the datasets of other fleets."""
        parts = [self, *others]
        return Fleet(
            reduce(DataFrame.unionByName, [p.rows for p in parts]),
            reduce(DataFrame.unionByName, [p.columns for p in parts]),
        )


def flat_fields(df: DataFrame) -> list:
    """Fields of flat type; nested columns are outside the model."""
    return [f for f in df.schema.fields if kind_of(f.dataType)]


def skipped_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not kind_of(f.dataType)]


def with_fingerprint(rows: DataFrame) -> DataFrame:
    """Rows of :data:`ROWS_SCHEMA` with their fingerprint; not computed unless it is used."""
    stores = list(STORE_TYPES)
    nulls = "concat(" + ", ".join(f"transform({s}, v -> isnull(v))" for s in stores) + ")"
    gaps = "array_join(concat(" + ", ".join(f"transform({s}, v -> if(isnull(v), '1', '0'))" for s in stores) + "), '')"
    hashed = [s if s == "longs" else f"transform({s}, v -> if(isnull(v), NULL, xxhash64(v)))" for s in stores]
    target = " ".join(f"WHEN target_store = '{s}' THEN {target_sql(s, f'get({s}, target_slot)')}" for s in stores)
    return rows.selectExpr("*", fingerprint_sql(stores, nulls, gaps, f"concat({', '.join(hashed)})", f"CASE {target} END"))


def target_value_present() -> Column:
    """Whether the target of a fleet row is there; false for a dataset without a target."""
    return F.col("fingerprint.target").isNotNull()


def dataset_code() -> Column:
    """A number that stands for a dataset, so that rows and values are not each folded beside its names;
    missing for a dataset without a name."""
    named = F.col(KEY[0]).isNotNull() & F.col(KEY[1]).isNotNull()
    return F.when(named, F.xxhash64(*KEY)).alias("_of")


def numbered(columns: DataFrame) -> DataFrame:
    """Columns with their dataset's code and their number among the values of a row, store after store."""
    own = Window.partitionBy(*KEY)
    longs, doubles = (
        F.coalesce(F.max(F.when(F.col("store") == store, F.col("slot"))).over(own) + 1, F.lit(0))
        for store in ("longs", "doubles")
    )
    before = F.when(F.col("store") == "longs", 0).when(F.col("store") == "doubles", longs).otherwise(longs + doubles)
    return columns.select("*", dataset_code(), (F.col("slot") + before).cast("int").alias("_at"))


def to_fleet(
    df: DataFrame, dataset_id: str, collection_id: str = "default", target: str | None = None
) -> Fleet:
    """One table as a fleet of one; the target is the last flat column unless named."""
    fields = flat_fields(df)
    if target is None and fields:
        target = fields[-1].name
    held: dict[str, list[str]] = {store: [] for store in STORE_TYPES}
    tests: dict[str, list[str]] = {store: [] for store in STORE_TYPES}
    records = []
    for i, field in enumerate(fields):
        kind = kind_of(field.dataType)
        store = STORES[kind]
        records.append(
            {
                "collection_id": collection_id,
                "dataset_id": dataset_id,
                "ordinal": i + 1,
                "column_name": field.name,
                "dtype": DTYPES[kind],
                "is_target": field.name == target,
                "kind": kind,
                "declared": declared_type(field.dataType),
                "store": store,
                "slot": len(held[store]),
            }
        )
        held[store].append(stored_sql(field.name, field.dataType))
        tests[store].append(missing_sql(field.name, field.dataType))
    place = next((r for r in records if r["is_target"]), {"store": None, "slot": None})
    values = [v for store in held.values() for v in store]
    nulls = "concat('', " + ", ".join(f"if({t}, '1', '0')" for some in tests.values() for t in some) + ")"
    arrays = [
        f"CAST(array({', '.join(held[store])}) AS array<{t}>) AS {store}" for store, t in STORE_TYPES.items()
    ]
    hashed = [
        v if store == "longs" else f"if(isnull({v}), NULL, xxhash64({v}))" for store, some in held.items() for v in some
    ]
    hashes = f"CAST(array({', '.join(hashed)}) AS array<bigint>)"
    value = "NULL" if place["store"] is None else held[place["store"]][place["slot"]]
    rows = df.selectExpr(
        *arrays, fingerprint_sql(values, nulls, nulls, hashes, target_sql(place["store"], value))
    ).select(
        F.lit(collection_id).alias("collection_id"),
        F.lit(dataset_id).alias("dataset_id"),
        F.monotonically_increasing_id().alias("row_id"),
        F.lit(place["store"]).cast("string").alias("target_store"),
        F.lit(place["slot"]).cast("int").alias("target_slot"),
        *STORE_TYPES,
        "fingerprint",
    )
    columns = df.sparkSession.createDataFrame(pa.Table.from_pylist(records, schema=COLUMNS_SCHEMA))
    return Fleet(rows, columns)


def fleet_of(tables: list[Fleet]) -> Fleet:
    return tables[0].union(*tables[1:])


def to_cells(fleet: Fleet) -> DataFrame:
    """One row per value as text, with its column's name and type, in one pass over the rows."""

    def entries(store: str) -> Column:
        def entry(value: Column, slot: Column) -> Column:
            long, text = (value, F.lit(None)) if store == "longs" else (F.lit(None), value)
            return F.struct(
                F.lit(store).alias("store"),
                slot.alias("slot"),
                long.cast("bigint").alias("_long"),
                text.cast("string").alias("_text"),
            )

        return F.transform(store, entry)

    cells = fleet.rows.select(*KEY, "row_id", F.inline(F.concat(*map(entries, STORE_TYPES))))
    names = fleet.columns.select(*KEY, "store", "slot", "ordinal", "column_name", "dtype", "kind")
    whole = F.when(F.col("store") == "longs", as_text(F.col("kind"), F.col("_long")))
    return cells.join(names, [*KEY, "store", "slot"]).select(
        *KEY, "row_id", "ordinal", "column_name", "dtype", whole.otherwise(F.col("_text")).alias("value")
    )


def digest_sums(df: DataFrame, by: list[str], text: Column) -> DataFrame:
    """Per group the rows and two sums over digests of ``text``: equal sums mean equal texts, whatever
    their order. Folded before the shuffle."""
    return df.withColumn("_digest", F.md5(text)).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.sum(F.conv(F.substring("_digest", at, 8), 16, 10).cast("bigint")).alias(name)
            for name, at in (("digest_a", 1), ("digest_b", 9))
        ],
    )


def marked(value: Column) -> Column:
    """A value as text that tells missing from empty and ends before the next one."""
    return F.concat(F.lit("\x1f"), F.coalesce(F.concat(F.lit("="), value), F.lit("-")))


def cell_digests(cells: DataFrame) -> DataFrame:
    """One row per column of a cell table, with the digests of its values."""
    return digest_sums(cells, [*KEY, "ordinal", "column_name", "dtype"], marked(F.col("value")))


def row_digests(fleet: Fleet) -> DataFrame:
    """One row per dataset, with its columns and types and the digests of whole rows, so that values
    mixed up between rows show. Only the column lists, one small row per dataset, are joined."""
    fields = F.struct("ordinal", "store", "slot", "kind", F.concat_ws(":", "column_name", "dtype").alias("text"))
    layout = fleet.columns.groupBy(*KEY).agg(F.array_sort(F.collect_list(fields)).alias("_columns"))

    def value(c: Column) -> Column:
        found = F.when(c["store"] == "longs", as_text(c["kind"], F.get("longs", c["slot"])))
        for store in STORE_TYPES:
            if store != "longs":
                found = found.when(c["store"] == store, F.get(store, c["slot"]).cast("string"))
        return marked(found)

    rows = fleet.rows.drop("row_id", "target_store", "target_slot", "fingerprint").join(layout, KEY)
    sums = digest_sums(rows, KEY, F.array_join(F.transform("_columns", value), ""))
    none = F.lit(0).cast("bigint")
    return layout.join(sums, KEY, "left").select(
        *KEY,
        F.array_join(F.transform("_columns", lambda c: c["text"]), ",").alias("columns"),
        *[F.coalesce(c, none).alias(c) for c in ("n_rows", "digest_a", "digest_b")],
    )
