"""Collection conditions: as column expressions, and as a table joined to the metrics.

A collection is ``{"collection_id", "all_of": [condition, ...], "sort": [(field, order), ...]}``. A
condition is ``{"field", "op", "value"}`` or ``{"any_of": [[condition, ...], ...]}``.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevet.functions.naming import norm, to_bool, to_number, unquote
from tablevet.operators import boxes

# Fields compared as numbers and as truth values, and the default search bounds.
NUMERIC_FIELDS = [
    "n_instances",
    "n_features",
    "n_classes",
    "missing_rate",
    "imbalance_ratio",
    "p_to_n_ratio",
]
BOOL_FIELDS = ["temporal", "grouped", "academic_usage", "iid_assumed"]
DEFAULT_ROWS = (500, 10_000)
DEFAULT_FEATURES = (5, 100)

COMPARE = {
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
}

CRITERIA_SCHEMA = pa.schema(
    [
        ("collection_id", pa.string()),
        ("cond_no", pa.int32()),
        ("any_no", pa.int32()),
        ("group_no", pa.int32()),
        ("field", pa.string()),
        ("op", pa.string()),
        ("value", pa.string()),
    ]
)


# Rows that stand for an empty group, which holds, and for an any_of without groups, which does not.
ALWAYS = {"field": "", "op": "==", "value": ""}
NEVER = {"field": "", "op": "!=", "value": ""}


def number_or_none(value) -> float | int | None:
    try:
        number = float(value)
    except (TypeError, ValueError):
        return None
    return int(number) if number.is_integer() else number


def cond_to_column(field: str, op: str, value, schema: T.StructType, unknown: str = "pass") -> Column:
    """Truth of one condition; NULL, which a filter drops, for a missing or non-numeric operand.

    Numeric columns are compared as they are, so the comparison reaches the Parquet scan.
    ``unknown`` says what a field outside ``schema`` does: ``pass`` or ``error``.
    """
    if field not in schema.fieldNames():
        if unknown == "error":
            raise ValueError(f"unknown field: {field}")
        return F.lit(True)
    column = F.col(field)
    if op in ("==", "!=") and field not in NUMERIC_FIELDS:
        return COMPARE[op](F.lower(column.cast("string")), F.lower(F.lit(str(value))))
    if not isinstance(schema[field].dataType, T.NumericType):
        column = to_number(column.cast("string"))
    if op == "between":
        low, high = value
        return column.between(number_or_none(low), number_or_none(high))
    if op not in COMPARE:
        raise ValueError(f"unknown operator: {op}")
    truth = COMPARE[op](column, F.lit(number_or_none(value)))
    fractional = not isinstance(schema[field].dataType, T.IntegralType)
    return truth & ~F.isnan(column) if fractional and op in (">", ">=", "!=") else truth


def _truth(condition: dict, schema: T.StructType, unknown: str) -> Column:
    if "any_of" in condition:
        groups = [compile_conditions(group, schema, unknown) for group in condition["any_of"]]
        return reduce(lambda a, b: a | b, groups, F.lit(False))
    return cond_to_column(condition["field"], condition["op"], condition["value"], schema, unknown)


def compile_conditions(conditions: list[dict], schema: T.StructType, unknown: str = "pass") -> Column:
    """Conjunction of all conditions; an empty list passes."""
    truths = [_truth(c, schema, unknown) for c in conditions]
    return reduce(lambda a, b: a & b, truths, F.lit(True))


def compile_criteria(spec: dict, schema: T.StructType, unknown: str = "pass") -> Column:
    """Filter condition of a collection."""
    return compile_conditions(spec.get("all_of", []), schema, unknown)


def condition_text(condition: dict) -> str:
    if "any_of" in condition:
        groups = [" and ".join(condition_text(c) for c in group) for group in condition["any_of"]]
        return " or ".join(f"({g})" for g in groups)
    return f"{condition['field']} {condition['op']} {condition['value']}"


def explain_criteria(spec: dict, schema: T.StructType, unknown: str = "pass") -> Column:
    """Text of the first failing condition; NULL when all hold."""
    reasons = [
        F.when(F.coalesce(_truth(c, schema, unknown), F.lit(False)), F.lit(None)).otherwise(
            F.lit(condition_text(c))
        )
        for c in spec.get("all_of", [])
    ]
    return F.coalesce(*reasons, F.lit(None).cast("string"))


def match_collections(metrics: DataFrame, specs: list[dict], unknown: str = "pass") -> DataFrame:
    """Verdict of every dataset for every declared collection: no join and no shuffle.

    The conditions are written down by people, so they are compiled into the plan of a single pass
    over the metrics.
    """
    verdicts = [
        F.struct(
            F.lit(spec["collection_id"]).alias("collection_id"),
            explain_criteria(spec, metrics.schema, unknown).alias("reason"),
        )
        for spec in specs
    ]
    return metrics.select("*", F.inline(F.array(*verdicts))).withColumn(
        "passed", F.col("reason").isNull()
    )


def match_passing(metrics: DataFrame, specs: list[dict], unknown: str = "pass") -> DataFrame:
    """The passing pairs alone: ``metrics`` with ``collection_id``, one row per dataset and collection
    that takes it. Datasets that no collection takes are dropped by a filter that reaches the scan."""
    truths = [compile_criteria(spec, metrics.schema, unknown) for spec in specs]
    takers = F.array(
        *[F.when(truth, F.lit(spec["collection_id"])) for truth, spec in zip(truths, specs)]
    )
    some = metrics.where(reduce(lambda a, b: a | b, truths, F.lit(False)))
    return some.select("*", F.explode(F.array_compact(takers)).alias("collection_id"))


def flat_groups(groups: list[list[dict]]) -> list[list[dict]]:
    """Alternatives of an ``any_of`` without nesting: a nested one multiplies out its group."""
    out = []
    for group in groups:
        flat: list[list[dict]] = [[]]
        for condition in group:
            inner = flat_groups(condition["any_of"]) if "any_of" in condition else [[condition]]
            flat = [a + b for a in flat for b in inner]
        out += flat
    return out


def criteria_df(spark: SparkSession, specs: list[dict]) -> DataFrame:
    """Conditions as a table; rows of an ``any_of`` carry its number and that of their group.

    An empty group always holds, and so does a row without a field. An ``any_of`` without groups
    never holds; it is a row without field and operator.
    """
    records = []
    for spec in specs:
        flat = []
        n_any = 0
        for condition in spec.get("all_of", []):
            if "any_of" not in condition:
                flat.append((None, None, condition))
                continue
            n_any += 1
            groups = flat_groups(condition["any_of"])
            for number, group in enumerate(groups, start=1):
                flat += [(n_any, number, c) for c in group or [ALWAYS]]
            if not groups:
                flat.append((n_any, 1, NEVER))
        for cond_no, (any_no, group_no, c) in enumerate(flat, start=1):
            value = ",".join(map(str, c["value"])) if c["op"] == "between" else str(c["value"])
            records.append(
                {
                    "collection_id": spec["collection_id"],
                    "cond_no": cond_no,
                    "any_no": any_no,
                    "group_no": group_no,
                    "field": c["field"],
                    "op": c["op"],
                    "value": value,
                }
            )
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=CRITERIA_SCHEMA))


def coerce_criteria(criteria: DataFrame) -> DataFrame:
    """Typed readings of the value text, by field: number, truth value, or unquoted text."""
    field = norm(F.col("field"))
    numeric, boolean = field.isin(NUMERIC_FIELDS), field.isin(BOOL_FIELDS)
    return criteria.withColumns(
        {
            "num_value": F.when(numeric, to_number(F.col("value"))),
            "bool_value": F.when(boolean, to_bool(F.col("value"))),
            "text_value": F.when(~numeric & ~boolean, unquote(F.col("value"))),
        }
    )


def condition_holds(op: Column, actual: Column, value: Column, numeric_field: Column) -> Column:
    """Row-wise form of :func:`cond_to_column`, over texts."""
    number, bound = to_number(actual), to_number(value)
    text, wanted = F.lower(actual), F.lower(unquote(value))
    parts = F.split(value, ",")
    low, high = to_number(F.get(parts, F.lit(0))), to_number(F.get(parts, F.lit(1)))
    truth = (
        F.when(op == "<", number < bound)
        .when(op == "<=", number <= bound)
        .when(op == ">", number > bound)
        .when(op == ">=", number >= bound)
        .when(op == "between", number.between(low, high))
        .when((op == "==") & numeric_field, number == bound)
        .when(op == "==", text == wanted)
        .when((op == "!=") & numeric_field, number != bound)
        .when(op == "!=", text != wanted)
    )
    return F.coalesce(truth, F.lit(False))


# Dimensions of a collection's box.
BOX_FIELDS = ["n_instances", "n_features"]


def criteria_boxes(criteria: DataFrame, fields: list[str]) -> DataFrame:
    """One row per collection: its range in each of ``BOX_FIELDS`` among ``fields``, one text it asks
    for (``_tag``, empty if none), and all its conditions.

    Only conditions outside an ``any_of`` bound the box; the others are checked afterwards.
    """
    # A condition on an unknown field holds, inside a group as well, so it asks what always holds.
    known = F.col("field").isin([*fields, ""])
    asked = criteria.select(
        "collection_id",
        "cond_no",
        "any_no",
        "group_no",
        F.when(known, F.col("field")).otherwise("").alias("field"),
        F.when(known, F.col("op")).otherwise("==").alias("op"),
        F.when(known, F.col("value")).otherwise("").alias("value"),
    )
    op, number, parts = F.col("op"), to_number(F.col("value")), F.split("value", ",")
    low = F.when(op.isin(">", ">=", "=="), number).when(op == "between", to_number(F.get(parts, F.lit(0))))
    high = F.when(op.isin("<", "<=", "=="), number).when(op == "between", to_number(F.get(parts, F.lit(1))))
    single = F.col("group_no").isNull()
    dims = [f for f in BOX_FIELDS if f in fields]
    ranges = []
    for field in dims:
        here = single & (F.col("field") == field)
        ranges += [F.max(F.when(here, low)).alias(f"min_{field}"), F.min(F.when(here, high)).alias(f"max_{field}")]
        ranges.append(F.max(F.when(here & (op == ">"), number)).alias(f"above_{field}"))
        ranges.append(F.min(F.when(here & (op == "<"), number)).alias(f"below_{field}"))
    text = single & (op == "==") & ~F.col("field").isin(NUMERIC_FIELDS) & (F.col("field") != "")
    tag = F.concat_ws("=", "field", F.lower(unquote(F.col("value"))))
    # What the exact ranges say already is not checked again for each pair.
    by_box = single & F.col("field").isin(dims) & number.isNotNull() & op.isin(">=", "<=", "==", ">", "<")
    columns = ("cond_no", "any_no", "group_no", "field", "op", "value")
    condition = F.struct(*columns, F.when(text, tag).alias("tag"))
    boxed = asked.groupBy("collection_id").agg(
        *ranges,
        F.coalesce(F.min(F.when(text, tag)), F.lit("")).alias("_tag"),
        F.collect_list(F.when(~F.coalesce(by_box, F.lit(False)), condition)).alias("_conditions"),
    )
    # Nor is the text that both sides were joined by, which tells its field unless a name holds "=".
    if any("=" in f for f in fields):
        return boxed
    open_ones = F.filter("_conditions", lambda c: c["tag"].isNull() | (c["tag"] != F.col("_tag")))
    return boxed.withColumn("_conditions", open_ones)


def _all_hold(conditions: Column, actual: Column) -> Column:
    """Whether a dataset's texts by field meet a collection's conditions."""

    def fails(c: Column) -> Column:
        return ~condition_holds(c["op"], F.try_element_at(actual, c["field"]), c["value"], c["field"].isin(NUMERIC_FIELDS))

    def group(c: Column) -> Column:
        return F.struct(c["any_no"].alias("any_no"), c["group_no"].alias("group_no"))

    grouped = F.filter(conditions, lambda c: c["group_no"].isNotNull())
    failed = F.array_distinct(F.transform(F.filter(grouped, fails), group))
    held = F.array_except(F.transform(grouped, group), failed)
    number = lambda groups: F.size(F.array_distinct(F.transform(groups, lambda g: g["any_no"])))
    some_group = number(held) == number(F.transform(grouped, group))
    return ~F.exists(conditions, lambda c: c["group_no"].isNull() & fails(c)) & some_group


def _points(metrics: DataFrame, key: list[str]) -> DataFrame:
    """Datasets as points: a number per box dimension, all texts by field, and each tag they carry."""
    fields = [c for c in metrics.columns if c not in key]
    texts = [F.col(f).cast("string") for f in fields]
    actual = F.map_from_arrays(F.array(*map(F.lit, ["", *fields])), F.array(F.lit(""), *texts))
    tags = [F.concat(F.lit(f"{f}="), F.lower(t)) for f, t in zip(fields, texts) if f not in NUMERIC_FIELDS]
    dims = [to_number(F.col(f).cast("string")).alias(f) for f in BOX_FIELDS if f in fields]
    points = metrics.select(*key, *dims, actual.alias("_actual"), F.array_compact(F.array(F.lit(""), *tags)).alias("_tags"))
    return points.select(*key, *[f for f in BOX_FIELDS if f in fields], "_actual", F.explode("_tags").alias("_tag"))


def criteria_candidates(metrics: DataFrame, criteria: DataFrame, key: list[str]) -> DataFrame:
    """Pairs of datasets and collections that share a grid cell and the collection's tag."""
    fields = [c for c in metrics.columns if c not in key]
    dims = [f for f in BOX_FIELDS if f in fields]
    collections = criteria_boxes(criteria, fields)
    if not dims:
        return _points(metrics, key).join(collections, "_tag")
    return boxes.candidates(_points(metrics, key), collections, dims, "_tag")


def passing_criteria_table(metrics: DataFrame, criteria: DataFrame, key: list[str]) -> DataFrame:
    """The passing pairs of datasets and collections of a criteria table of any size.

    A collection is a box over rows and features and may ask for one text; a dataset is a point. Both
    meet in grid cells, and only then are all conditions checked, so the work follows the passing pairs
    and not the product. Collections without (known) conditions take every dataset.
    """
    dims = [f for f in BOX_FIELDS if f in metrics.columns]
    pairs = criteria_candidates(metrics, criteria, key)
    if dims:
        pairs = pairs.where(boxes.inside(dims))
    for d in dims:
        above, below = F.col(f"above_{d}"), F.col(f"below_{d}")
        pairs = pairs.where((above.isNull() | (F.col(d) > above)) & (below.isNull() | (F.col(d) < below)))
    left = F.size("_conditions") > 0
    held = F.when(left, _all_hold(F.col("_conditions"), F.col("_actual"))).otherwise(True)
    return pairs.where(held).select("collection_id", *key)


def match_criteria_table(metrics: DataFrame, criteria: DataFrame, key: list[str]) -> DataFrame:
    """Verdict and reason of every dataset for every collection, passing or not."""
    return explain_criteria_table(metrics, criteria, key)


def explain_criteria_table(
    metrics: DataFrame, criteria: DataFrame, key: list[str], salts: int | None = None
) -> DataFrame:
    """Verdict and reason of every dataset for every collection of a criteria table: a row for each
    pair, so for reports. :func:`passing_criteria_table` gives the passing ones.

    Metrics are turned to (dataset, field, value) and equi-joined to the conditions on the field.
    There are few fields, so each is spread over ``salts`` sub-keys (as many as shuffle partitions
    by default), on which the conditions are repeated. Every collection gets one condition on the key, which always holds, so that
    collections without (known) conditions pass too.
    """
    if salts is None:
        salts = int(metrics.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = [c for c in metrics.columns if c not in key]
    salt = F.pmod(F.xxhash64(*key), F.lit(salts)).cast("int")
    entries = [F.lit("").alias("field"), F.lit("").alias("actual")]
    long = metrics.select(
        *key,
        salt.alias("_salt"),
        F.explode(
            F.array(
                F.struct(*entries),
                *[
                    F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("actual"))
                    for f in fields
                ],
            )
        ).alias("_m"),
    ).select(*key, "_salt", "_m.field", "_m.actual")

    always = criteria.select("collection_id").distinct().select(
        "collection_id",
        F.lit(0).alias("cond_no"),
        F.lit(None).cast("int").alias("any_no"),
        F.lit(None).cast("int").alias("group_no"),
        F.lit("").alias("field"),
        F.lit("==").alias("op"),
        F.lit("").alias("value"),
    )
    # A condition on an unknown field holds, inside a group as well, so it asks what always holds.
    known = F.col("field").isin([*fields, ""])
    asked = criteria.select(
        "collection_id",
        "cond_no",
        "any_no",
        "group_no",
        F.when(known, F.col("field")).otherwise("").alias("field"),
        F.when(known, F.col("op")).otherwise("==").alias("op"),
        F.when(known, F.col("value")).otherwise("").alias("value"),
    )
    spread = asked.unionByName(always).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    holds = condition_holds(
        F.col("op"), F.col("actual"), F.col("value"), F.col("field").isin(NUMERIC_FIELDS)
    )
    checked = long.join(spread, ["field", "_salt"]).withColumn("_fails", ~holds)
    single = F.col("group_no").isNull()
    text = F.concat_ws(" ", "field", "op", "value")
    group = F.when(~single, F.struct("any_no", "group_no"))
    verdict = checked.groupBy("collection_id", *key).agg(
        F.coalesce(F.bool_or(F.when(single, F.col("_fails"))), F.lit(False)).alias("_single_fails"),
        F.min_by(text, F.when(single & F.col("_fails"), F.col("cond_no"))).alias("_reason"),
        F.collect_set(group).alias("_groups"),
        F.collect_set(F.when(F.col("_fails"), group)).alias("_failed_groups"),
    )
    # Every any_of needs a group in which nothing fails.
    number = lambda groups: F.array_distinct(F.transform(groups, lambda g: g["any_no"]))
    held = F.array_except("_groups", "_failed_groups")
    some_group = F.size(number(held)) == F.size(number(F.col("_groups")))
    return verdict.select(
        "collection_id",
        *key,
        (~F.col("_single_fails") & some_group).alias("passed"),
        F.when(F.col("_single_fails"), F.col("_reason"))
        .when(~some_group, "any_of")
        .alias("reason"),
    )


def collection_bounds(criteria: DataFrame) -> DataFrame:
    """Tightest row and feature range per collection, to be pushed into the listing scan.

    Strict comparisons shift by one, ``==`` pins both ends even outside the defaults, and different
    ``==`` give an empty range. A binary subtype asks for two classes.
    """
    plain = criteria.where(F.col("group_no").isNull()).withColumns(
        {
            "_field": norm(F.col("field")),
            "_int": to_number(F.col("value")).try_cast("bigint"),
        }
    )
    op, number = F.col("op"), F.col("_int")
    low = F.when(op == ">=", number).when(op == ">", number + 1)
    high = F.when(op == "<=", number).when(op == "<", number - 1)
    ranges = []
    for field, name, defaults in (
        ("n_instances", "rows", DEFAULT_ROWS),
        ("n_features", "features", DEFAULT_FEATURES),
    ):
        here = F.col("_field") == field
        pin = F.when(here & (op == "=="), number)
        ranges += [
            F.coalesce(F.max(pin), F.greatest(F.max(F.when(here, low)), F.lit(defaults[0])))
            .cast("bigint")
            .alias(f"min_{name}"),
            F.coalesce(F.min(pin), F.least(F.min(F.when(here, high)), F.lit(defaults[1])))
            .cast("bigint")
            .alias(f"max_{name}"),
        ]
    binary = (
        (F.col("_field") == "task_subtype")
        & (op == "==")
        & (F.lower(unquote(F.col("value"))) == "binary")
    )
    return plain.groupBy("collection_id").agg(
        *ranges, F.max(F.when(binary, F.lit(2))).cast("bigint").alias("n_classes")
    )
