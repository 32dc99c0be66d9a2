"""Inputs of the registered queries, all derived from whole test tables."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablevet.sources.fleet import Fleet, fleet_of, to_fleet

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

# The conditions of the three sample collections.
SIZE_CONDITIONS = [
    {"field": "n_instances", "op": ">=", "value": 500},
    {"field": "n_instances", "op": "<=", "value": 10000},
    {"field": "n_features", "op": ">=", "value": 5},
    {"field": "n_features", "op": "<=", "value": 100},
]
SPECS = [
    {
        "collection_id": "binary_clean_core",
        "all_of": [
            {"field": "task", "op": "==", "value": "classification"},
            {"field": "task_subtype", "op": "==", "value": "binary"},
            {"field": "missing_rate", "op": "<=", "value": 0.05},
            *SIZE_CONDITIONS,
        ],
        "sort": [("n_instances", "asc")],
    },
    {
        "collection_id": "multiclass_imbalanced_core",
        "all_of": [
            {"field": "task", "op": "==", "value": "classification"},
            {"field": "task_subtype", "op": "==", "value": "multiclass"},
            {"field": "imbalance_ratio", "op": ">=", "value": 3.0},
            *SIZE_CONDITIONS,
        ],
        "sort": [("imbalance_ratio", "desc"), ("n_instances", "asc")],
    },
    {
        "collection_id": "regression_standard_core",
        "all_of": [{"field": "task", "op": "==", "value": "regression"}, *SIZE_CONDITIONS],
        "sort": [("n_instances", "asc")],
    },
]


@cache
def table_schema(sf_dir: str, table: str) -> StructType:
    """Read from the file once; later scans skip the footer job."""
    return SparkSession.active().read.parquet(f"{sf_dir}/{table}.parquet").schema


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(table_schema(sf_dir, table)).parquet(f"{sf_dir}/{table}.parquet")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repository listing: one candidate per part."""
    return load(spark, sf_dir, "part").selectExpr(
        "p_partkey AS did",
        "concat(p_name, ' (', p_type, ')') AS name",
        "CAST(p_size * 200 AS BIGINT) AS n_instances",
        "p_partkey % 110 AS n_features",
        "p_partkey % 30 AS n_classes",
        "CASE WHEN p_partkey % 11 = 0 THEN 'in_preparation' ELSE 'active' END AS status",
        "CAST(floor(p_retailprice) AS BIGINT) AS number_downloads",
        "CASE WHEN p_partkey % 7 <> 0 THEN 'Public' END AS licence",
        "CASE WHEN p_partkey % 3 = 0 THEN 'CC-BY' ELSE '' END AS license",
        "CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat('cite ', p_brand) END AS citation",
        "CASE WHEN p_partkey % 4 = 0 THEN concat('http://paper/', p_partkey) END AS paper_url",
        "CAST(p_partkey % 20 AS DOUBLE) / 100 AS missing_rate",
        "CAST(1 + p_partkey % 7 AS DOUBLE) AS imbalance_ratio",
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metrics record per candidate of the listing."""
    return listing(spark, sf_dir).selectExpr(
        "concat('ds_', did) AS dataset_id",
        "*",
        "CASE WHEN n_classes > 20 OR n_classes = 0 THEN 'regression' ELSE 'classification' END AS task",
        "CASE WHEN n_classes > 20 THEN 'continuous' WHEN n_classes = 2 THEN 'binary'"
        " WHEN n_classes > 2 THEN 'multiclass' ELSE 'unknown' END AS task_subtype",
        "did % 13 = 0 AS temporal",
        "did % 17 = 0 AS grouped",
        "TRUE AS academic_usage",
    )


METRIC_FIELDS = [
    "n_instances", "n_features", "n_classes", "missing_rate", "imbalance_ratio", "task",
    "task_subtype", "temporal", "grouped", "academic_usage",
]


def written_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A criteria table as text: one condition per part, collected by part name."""
    return load(spark, sf_dir, "part").selectExpr(
        "p_name AS collection_id",
        "CAST(p_partkey AS INT) AS cond_no",
        "CAST(NULL AS INT) AS group_no",
        "element_at(array('n_instances', 'n_features', 'missing_rate', 'temporal', 'task',"
        " 'task_subtype'), CAST(p_partkey % 6 + 1 AS INT)) AS field",
        "CASE WHEN p_partkey % 6 >= 3 OR p_size % 49 = 0 THEN '=='"
        " ELSE element_at(array('<', '<=', '>', '>='), CAST(p_size % 4 + 1 AS INT)) END AS op",
        "CASE CAST(p_partkey % 6 AS INT) WHEN 0 THEN concat(' ', p_size * 200, ' ')"
        " WHEN 1 THEN CAST(p_size AS STRING)"
        " WHEN 2 THEN element_at(array('0.05', '5d', '1e-2', ''), CAST(p_size % 4 + 1 AS INT))"
        " WHEN 3 THEN element_at(array('True', 'no', ' Y ', 'maybe'), CAST(p_size % 4 + 1 AS INT))"
        " WHEN 4 THEN '\"classification\"' ELSE concat('''', if(p_size % 2 = 0, 'binary', p_type), '''')"
        " END AS value",
    )


def part_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A criteria table with one collection per part: ranges of rows and features, and a task."""
    conditions = [
        ("n_instances", "'>='", "p_size * 200"),
        ("n_instances", "'<='", "p_size * 200 + 400"),
        ("n_features", "'>='", "p_partkey % 110"),
        ("n_features", "'<'", "p_partkey % 110 + 4"),
        ("task", "'=='", "if(p_partkey % 2 = 0, 'Regression', 'classification')"),
    ]
    rows = ", ".join(
        f"named_struct('cond_no', {i}, 'field', '{f}', 'op', {op}, 'value', CAST({value} AS STRING))"
        for i, (f, op, value) in enumerate(conditions, start=1)
    )
    return load(spark, sf_dir, "part").selectExpr("concat('part_', p_partkey) AS collection_id", f"inline(array({rows}))").selectExpr(
        "collection_id", "cond_no", "CAST(NULL AS INT) AS any_no", "CAST(NULL AS INT) AS group_no", "field", "op", "value"
    )


def lineitem_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a constant, a sparse and a target column with gaps; line 2 occurs twice."""
    base = load(spark, sf_dir, "lineitem").withColumns(
        {
            "c_const": F.lit(1),
            "c_sparse": F.when(F.col("l_linenumber") == 1, F.col("l_suppkey")),
            "tgt": F.when(F.col("l_discount") != 0, F.col("l_returnflag")),
        }
    )
    return base.unionByName(base.where(F.col("l_linenumber") == 2))


def orders_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "c_nationkey",
        "c_acctbal", "c_mktsegment", "o_orderpriority",
    )


def table_fleet(spark: SparkSession, sf_dir: str) -> Fleet:
    """Every table as a dataset whose target is its last column."""
    return fleet_of([to_fleet(load(spark, sf_dir, t), t, "tables") for t in TABLES])


def derived_fleet(spark: SparkSession, sf_dir: str) -> Fleet:
    lineitem = load(spark, sf_dir, "lineitem")
    return fleet_of(
        [
            to_fleet(lineitem, "lineitem_cls", "derived", "l_returnflag"),
            to_fleet(lineitem, "lineitem_reg", "derived", "l_quantity"),
            to_fleet(orders_customer(spark, sf_dir), "orders_customer", "derived"),
            to_fleet(lineitem_dirty(spark, sf_dir), "lineitem_dirty", "derived"),
        ]
    )


def whole_fleet(spark: SparkSession, sf_dir: str) -> Fleet:
    return table_fleet(spark, sf_dir).union(derived_fleet(spark, sf_dir))
