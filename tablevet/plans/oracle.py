"""SQL statements of the same answers, for DuckDB over the same tables."""

from __future__ import annotations

# Columns of the test tables with their types; nested columns are left out.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey int, c_name string, c_nationkey int, c_acctbal float, c_mktsegment string",
    "supplier": "s_suppkey int, s_name string, s_nationkey int, s_acctbal float",
    "part": "p_partkey int, p_name string, p_brand string, p_type string, p_size int, p_retailprice float",
    "orders": "o_orderkey int, o_custkey int, o_orderstatus string, o_totalprice float,"
    " o_orderdate datetime, o_orderpriority string",
    "lineitem": "l_orderkey int, l_partkey int, l_suppkey int, l_linenumber int, l_quantity float,"
    " l_extendedprice float, l_discount float, l_tax float, l_returnflag string,"
    " l_linestatus string, l_shipdate datetime",
    "events": "event_id int, ts datetime, user_id int, event_type string, value float, props string",
    "documents": "doc_id int, text string, lang string, source string, n_chars int",
    "embeddings": "vec_id int, label int",
    "pages": "page_id int, url string, html string",
    "benchmark": "item_id int, text string",
    "labels": "doc_id int, quality int, toxic int",
    "conversations": "conv_id int, turn int, role string, text string",
}

DIRTY = """(SELECT *, 1 AS c_const, CASE WHEN l_linenumber = 1 THEN l_suppkey END AS c_sparse,
  CASE WHEN l_discount <> 0 THEN l_returnflag END AS tgt FROM lineitem
  UNION ALL
  SELECT *, 1, CASE WHEN l_linenumber = 1 THEN l_suppkey END,
  CASE WHEN l_discount <> 0 THEN l_returnflag END FROM lineitem WHERE l_linenumber = 2)"""
DIRTY_SCHEMA = SCHEMAS["lineitem"] + ", c_const int, c_sparse int, tgt string"

ORDERS_CUSTOMER = """(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  c_nationkey, c_acctbal, c_mktsegment, o_orderpriority
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
ORDERS_CUSTOMER_SCHEMA = (
    "o_orderkey int, o_custkey int, o_orderstatus string, o_totalprice float, o_orderdate datetime,"
    " c_nationkey int, c_acctbal float, c_mktsegment string, o_orderpriority string"
)


def dataset(collection: str, name: str, relation: str, schema: str, target: str | None = None) -> dict:
    columns = [tuple(c.split()) for c in schema.split(",")]
    return {
        "c": collection,
        "d": name,
        "rel": relation,
        "columns": columns,
        "target": target or columns[-1][0],
    }


TABLE_SETS = [dataset("tables", t, t, s) for t, s in SCHEMAS.items()]
DERIVED_SETS = [
    dataset("derived", "lineitem_cls", "lineitem", SCHEMAS["lineitem"], "l_returnflag"),
    dataset("derived", "lineitem_reg", "lineitem", SCHEMAS["lineitem"], "l_quantity"),
    dataset("derived", "orders_customer", ORDERS_CUSTOMER, ORDERS_CUSTOMER_SCHEMA),
    dataset("derived", "lineitem_dirty", DIRTY, DIRTY_SCHEMA),
]
WHOLE = TABLE_SETS + DERIVED_SETS
CSV_SETS = [dataset("csv", t, t, s) for t, s in SCHEMAS.items()]

LISTING = """(SELECT p_partkey AS did, p_name || ' (' || p_type || ')' AS name,
  CAST(p_size * 200 AS BIGINT) AS n_instances, p_partkey % 110 AS n_features,
  p_partkey % 30 AS n_classes,
  CASE WHEN p_partkey % 11 = 0 THEN 'in_preparation' ELSE 'active' END AS status,
  CAST(floor(p_retailprice) AS BIGINT) AS number_downloads,
  CASE WHEN p_partkey % 7 <> 0 THEN 'Public' END AS licence,
  CASE WHEN p_partkey % 3 = 0 THEN 'CC-BY' ELSE '' END AS license,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'cite ' || p_brand END AS citation,
  CASE WHEN p_partkey % 4 = 0 THEN 'http://paper/' || p_partkey END AS paper_url,
  CAST(p_partkey % 20 AS DOUBLE) / 100 AS missing_rate,
  CAST(1 + p_partkey % 7 AS DOUBLE) AS imbalance_ratio FROM part)"""
METRICS = f"""(SELECT 'ds_' || did AS dataset_id, *,
  CASE WHEN n_classes > 20 OR n_classes = 0 THEN 'regression' ELSE 'classification' END AS task,
  CASE WHEN n_classes > 20 THEN 'continuous' WHEN n_classes = 2 THEN 'binary'
    WHEN n_classes > 2 THEN 'multiclass' ELSE 'unknown' END AS task_subtype,
  did % 13 = 0 AS temporal, did % 17 = 0 AS grouped, TRUE AS academic_usage FROM {LISTING})"""
WRITTEN = """(SELECT *, CASE CAST(k % 6 AS INTEGER) WHEN 0 THEN ' ' || (p_size * 200) || ' '
    WHEN 1 THEN CAST(p_size AS VARCHAR)
    WHEN 2 THEN ['0.05', '5d', '1e-2', ''][p_size % 4 + 1]
    WHEN 3 THEN ['True', 'no', ' Y ', 'maybe'][p_size % 4 + 1]
    WHEN 4 THEN '"classification"'
    ELSE '''' || CASE WHEN p_size % 2 = 0 THEN 'binary' ELSE p_type END || '''' END AS value
  FROM (SELECT p_partkey AS k, p_name AS collection_id, CAST(p_partkey AS INTEGER) AS cond_no, p_size,
    p_type,
    ['n_instances', 'n_features', 'missing_rate', 'temporal', 'task', 'task_subtype']
      [CAST(p_partkey % 6 + 1 AS INTEGER)] AS field,
    CASE WHEN p_partkey % 6 >= 3 OR p_size % 49 = 0 THEN '=='
      ELSE ['<', '<=', '>', '>='][p_size % 4 + 1] END AS op FROM part))"""

KEY = "collection_id, dataset_id"


def _union(parts: list[str]) -> str:
    return "(" + "\nUNION ALL ".join(parts) + ")"


def _names(condition: str, name: str) -> str:
    text = f"string_agg(column_name, ',' ORDER BY ordinal) FILTER (WHERE {condition})"
    return f"coalesce({text}, '') AS {name}"


def _column_stats(sets: list[dict], cleaned: bool) -> str:
    """One row per column, each counted by its own GROUP BY."""
    parts = []
    for s in sets:
        names = ", ".join(c for c, _ in s["columns"])
        rel = s["rel"]
        if cleaned:
            rel = f"(SELECT DISTINCT {names} FROM {rel} WHERE {s['target']} IS NOT NULL)"
        for i, (column, dtype) in enumerate(s["columns"], start=1):
            size = "8" if dtype in ("int", "float", "datetime") else "strlen(v)"
            parts.append(
                f"SELECT '{s['c']}' AS collection_id, '{s['d']}' AS dataset_id,"
                f" CAST({i} AS INTEGER) AS ordinal, '{column}' AS column_name, '{dtype}' AS dtype,"
                f" {column == s['target']} AS is_target, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows,"
                " CAST(coalesce(sum(n) FILTER (WHERE v IS NULL), 0) AS BIGINT) AS n_missing,"
                " count(v) AS n_unique, min(n) FILTER (WHERE v IS NOT NULL) AS min_count,"
                " max(n) FILTER (WHERE v IS NOT NULL) AS max_count,"
                f" CAST(coalesce(sum(n * {size}), 0) AS BIGINT) AS bytes"
                f" FROM (SELECT {column} AS v, count(*) AS n FROM {rel} GROUP BY {column})"
            )
    return _union(parts)


PROFILE = _column_stats(WHOLE, cleaned=False)


def _raw_rows(sets: list[dict]) -> str:
    return _union(
        [
            f"SELECT '{s['c']}' AS collection_id, '{s['d']}' AS dataset_id, count(*) AS raw_rows,"
            f" count({s['target']}) AS target_rows FROM {s['rel']}"
            for s in sets
        ]
    )


def _duplicates(sets: list[dict]) -> str:
    parts = []
    for s in sets:
        names = ", ".join(c for c, _ in s["columns"])
        parts.append(
            f"SELECT '{s['c']}' AS collection_id, '{s['d']}' AS dataset_id,"
            " CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows"
            f" FROM (SELECT count(*) AS n FROM {s['rel']} GROUP BY {names})"
        )
    return _union(parts)


TASK = """CASE WHEN {dtype} IN ('string', 'bool') THEN 'classification'
  WHEN {dtype} = 'float' THEN 'regression'
  WHEN {dtype} = 'int' AND ({unique} <= 15 OR {unique} < {rows} * 0.05) THEN 'classification'
  WHEN {dtype} = 'int' THEN 'regression' ELSE 'unknown' END"""
TARGET = "max({0}) FILTER (WHERE is_target)"


def _task(rows: str) -> str:
    return TASK.format(dtype=TARGET.format("dtype"), unique=TARGET.format("n_unique"), rows=rows)


def _flags(sets: list[dict]) -> str:
    return f"""(SELECT *, NOT (is_sparse OR is_constant OR is_id) AS is_kept FROM (
  SELECT *, NOT is_target AND NOT is_sparse AND NOT is_constant AND n_unique = n_rows AND n_rows > 1
    AND dtype <> 'float' AS is_id FROM (
  SELECT *, NOT is_target AND NOT is_sparse AND n_unique = 1 AS is_constant FROM (
  SELECT *, NOT is_target AND n_rows > 0 AND n_missing > 0.5 * n_rows AS is_sparse
  FROM {_column_stats(sets, cleaned=True)}))))"""


def _screen(sets: list[dict], min_features: int = 5, max_rows: int | None = None) -> str:
    """Screening record; the gates in order."""
    too_many = f"OR n_instances > {max_rows}" if max_rows else ""
    return f"""(SELECT *, CASE WHEN reason IS NULL THEN 'validated' ELSE 'rejected' END AS status FROM (
  SELECT *, CASE WHEN task NOT IN ('classification', 'regression') THEN 'task_unsupported'
    WHEN n_classes <= 1 THEN 'target_constant'
    WHEN task = 'classification' AND n_classes > 20 THEN 'too_many_classes'
    WHEN task = 'classification' AND smallest_class < 5 THEN 'class_too_small'
    WHEN smallest_class < 2 THEN 'singleton_target'
    WHEN n_instances < 500 {too_many} THEN 'row_count'
    WHEN n_features < {min_features} OR n_features > 100 THEN 'feature_count' END AS reason FROM (
  SELECT collection_id, dataset_id, {TARGET.format('column_name')} AS target_variable,
    {_task('max(raw_rows)')} AS task, max(raw_rows) AS raw_rows,
    max(raw_rows - target_rows) AS missing_target_rows, max(target_rows - n_rows) AS duplicate_rows,
    max(n_rows) AS n_instances, {TARGET.format('n_unique')} AS n_classes,
    {TARGET.format('min_count')} AS smallest_class,
    count(*) FILTER (WHERE is_kept AND NOT is_target) AS n_features,
    round(CAST(sum(n_missing) FILTER (WHERE is_kept) AS DOUBLE)
      / sum(n_rows) FILTER (WHERE is_kept), 4) AS missing_rate,
    count(*) FILTER (WHERE is_kept AND NOT is_target AND dtype IN ('int', 'float')) AS numeric,
    count(*) FILTER (WHERE is_kept AND NOT is_target AND dtype = 'string') AS categorical,
    {_names('is_sparse', 'sparse_columns')}, {_names('is_constant', 'constant_columns')},
    {_names('is_id', 'id_columns')}
  FROM {_flags(sets)} JOIN {_raw_rows(sets)} USING (collection_id, dataset_id)
  GROUP BY collection_id, dataset_id)))"""


WHOLE_SCREEN = _screen(WHOLE, max_rows=10000)
LARGE_SCREEN = _screen(WHOLE)
NARROW_SCREEN = _screen(WHOLE, min_features=2)


def _cells(sets: list[dict], cleaned: bool = False) -> str:
    parts = []
    for s in sets:
        names = ", ".join(c for c, _ in s["columns"])
        rel = s["rel"]
        if cleaned:
            rel = f"(SELECT DISTINCT {names} FROM {rel} WHERE {s['target']} IS NOT NULL)"
        for i, (column, dtype) in enumerate(s["columns"], start=1):
            parts.append(
                f"SELECT '{s['c']}' AS collection_id, '{s['d']}' AS dataset_id,"
                f" CAST({i} AS INTEGER) AS ordinal, '{column}' AS column_name, '{dtype}' AS dtype,"
                f" CAST({column} AS VARCHAR) AS value FROM {rel}"
            )
    return _union(parts)


# Texts that a CSV reader takes for missing.
NA_TEXTS = """('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',
  '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"""


_DIGEST = "CAST(sum(CAST('0x' || substr(h, {}, 8) AS BIGINT)) AS BIGINT) AS {}"
DIGESTS = f"{_DIGEST.format(1, 'digest_a')}, {_DIGEST.format(9, 'digest_b')}"


def _csv_text(column: str, dtype: str) -> str:
    """The value of a column as text, after it was written as CSV."""
    if dtype == "datetime":
        return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
    return f"CASE WHEN {column} NOT IN {NA_TEXTS} THEN {column} END" if dtype == "string" else f"CAST({column} AS VARCHAR)"


def _row_digests(sets: list[dict], screened: str | None = None, csv: bool = False) -> str:
    """Per dataset: columns, rows and digests of whole rows; cleaned where there is a screening."""
    if screened:
        read = "CASE WHEN dtype = 'datetime' THEN 'string' ELSE dtype END" if csv else "dtype"
        kept = f"""SELECT {KEY}, list(ordinal) AS kept,
  string_agg(column_name || ':' || {read}, ',' ORDER BY ordinal) AS columns FROM {_flags(sets)}
  JOIN (SELECT {KEY} FROM {screened} WHERE status = 'validated') USING ({KEY}) WHERE is_kept GROUP BY {KEY}"""
    else:
        kept = "\nUNION ALL ".join(
            "SELECT '{}' AS collection_id, '{}' AS dataset_id, {} AS kept, '{}' AS columns".format(
                s["c"],
                s["d"],
                list(range(1, len(s["columns"]) + 1)),
                ",".join(f"{c}:{'string' if csv and t == 'datetime' else t}" for c, t in s["columns"]),
            )
            for s in sets
        )
    parts = []
    for s in sets:
        names = ", ".join(c for c, _ in s["columns"])
        rel = f"(SELECT DISTINCT {names} FROM {s['rel']} WHERE {s['target']} IS NOT NULL)" if screened else s["rel"]
        texts = [
            _csv_text(c, t) if csv and not (screened and t == "datetime") else f"CAST({c} AS VARCHAR)"
            for c, t in s["columns"]
        ]
        row = " || ".join(
            f"CASE WHEN list_contains(kept, {i}) THEN chr(31) || coalesce('=' || {text}, '-') ELSE '' END"
            for i, text in enumerate(texts, start=1)
        )
        parts.append(
            f"SELECT '{s['c']}' AS collection_id, '{s['d']}' AS dataset_id, md5({row}) AS h"
            f" FROM {rel} JOIN kept_columns ON collection_id = '{s['c']}' AND dataset_id = '{s['d']}'"
        )
    return f"""WITH kept_columns AS MATERIALIZED ({kept})
SELECT {KEY}, columns, count(*) AS n_rows, {DIGESTS}
FROM {_union(parts)} JOIN kept_columns USING ({KEY}) GROUP BY {KEY}, columns"""


def _title(text: str) -> str:
    words = f"list_transform(string_split({text}, ' '), lambda w: upper(w[1]) || lower(w[2:]))"
    return f"array_to_string({words}, ' ')"


def _sanitize(text: str) -> str:
    joined = rf"regexp_replace(lower(trim({text})), '[\s\-()]+', '_', 'g')"
    words = rf"regexp_replace({joined}, '[^\w]', '', 'g')"
    return f"trim(regexp_replace({words}, '_+', '_', 'g'), '_')"


NAMED_CATALOG = f"""(SELECT DISTINCT status AS collection_id, {_sanitize('name')} AS dataset_id FROM {LISTING}
  UNION SELECT 'suppliers', {_sanitize('s_name')} FROM supplier)"""
LATEST = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY did DESC) AS rn
  FROM (SELECT *, {_sanitize('name')} AS dataset_id FROM {LISTING})) WHERE rn = 1)"""
LATEST_ACTIVE = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY did DESC) AS rn
  FROM (SELECT *, {_sanitize('name')} AS dataset_id FROM {LISTING} WHERE status = 'active'
    AND n_instances BETWEEN 500 AND 10000 AND n_features BETWEEN 5 AND 100)) WHERE rn = 1)"""

SIZE_CHECKS = [
    ("n_instances >= 500",) * 2,
    ("n_instances <= 10000",) * 2,
    ("n_features >= 5",) * 2,
    ("n_features <= 100",) * 2,
]
SPEC_CHECKS = {
    "binary_clean_core": [
        ("task = 'classification'", "task == classification"),
        ("task_subtype = 'binary'", "task_subtype == binary"),
        ("missing_rate <= 0.05", "missing_rate <= 0.05"),
        *SIZE_CHECKS,
    ],
    "multiclass_imbalanced_core": [
        ("task = 'classification'", "task == classification"),
        ("task_subtype = 'multiclass'", "task_subtype == multiclass"),
        ("imbalance_ratio >= 3.0", "imbalance_ratio >= 3.0"),
        *SIZE_CHECKS,
    ],
    "regression_standard_core": [("task = 'regression'", "task == regression"), *SIZE_CHECKS],
}


def _reason(collection: str) -> str:
    cases = " ".join(f"WHEN NOT ({sql}) THEN '{text}'" for sql, text in SPEC_CHECKS[collection])
    return f"CASE {cases} END"


MATCHES = _union(
    [
        f"SELECT '{c}' AS collection_id, *, {_reason(c)} AS reason, {_reason(c)} IS NULL AS passed FROM {METRICS}"
        for c in SPEC_CHECKS
    ]
)
CRITERIA_ROWS = ", ".join(
    "('{}', {}, '{}', '{}', '{}')".format(c, i, *text.split(" "))
    for c, checks in SPEC_CHECKS.items()
    for i, (_, text) in enumerate(checks, start=1)
)

PART_CATALOG = f"(SELECT task AS collection_id, dataset_id, 'cataloged' AS status FROM {METRICS})"
PART_OUTCOMES = f"""(SELECT task AS collection_id, dataset_id,
  CASE WHEN n_features >= 5 THEN 'validated' ELSE 'rejected' END AS status
  FROM {METRICS} WHERE status = 'active')"""
STATUS_UPDATE = f"""SELECT collection_id, dataset_id, coalesce(o.status, c.status) AS status
FROM {PART_CATALOG} c LEFT JOIN {PART_OUTCOMES} o USING (collection_id, dataset_id)"""


def _ledger(sets: list[dict], profile: str) -> str:
    return f"""SELECT collection_id, dataset_id, max(n_rows) AS n_instances, count(*) AS n_features,
  round(CAST(sum(n_missing) AS DOUBLE) / sum(n_rows), 4) AS missing_rate,
  bool_or(n_unique = 1) AS has_constants, bool_or(n_unique = n_rows AND n_rows > 1) AS has_high_cardinality,
  FALSE AS has_citation, 'unknown' AS license, 'cataloged' AS status,
  'raw/' || collection_id || '/' || dataset_id AS data_path,
  'profiles/' || collection_id || '/' || dataset_id AS profile_path
FROM {profile} GROUP BY collection_id, dataset_id"""


CLASSED = "n_classes > 0 AND (dtype NOT IN ('int', 'float') OR n_classes <= 20)"
INFERRED_INT = "regexp_full_match(value, '[+-]?[0-9]+')"
INFERRED_NUMBER = r"regexp_full_match(value, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')"
NARROW_ENTRIES = f"(SELECT * FROM {NARROW_SCREEN} WHERE status = 'validated')"
DIRTY_NAMES = ", ".join(c.split()[0] for c in DIRTY_SCHEMA.split(",") if c.split()[0] not in ("c_const", "c_sparse"))
LINEITEM_NAMES = ", ".join(c.split()[0] for c in SCHEMAS["lineitem"].split(","))
CONFUSION = """(SELECT l_linestatus, l_returnflag AS label, CASE WHEN l_discount > 0.05 THEN 'R'
  WHEN l_tax > 0.04 THEN 'A' ELSE 'N' END AS guess FROM lineitem)"""


def _bound(field: str, low: bool, default: int, name: str) -> str:
    pin, loose, strict, shift = ("max", ">=", ">", "+ 1") if low else ("min", "<=", "<", "- 1")
    outer = "greatest" if low else "least"
    return (
        f"CAST(coalesce({pin}(num) FILTER (WHERE field = '{field}' AND op = '=='),"
        f" {outer}({pin}(CASE WHEN op = '{loose}' THEN num WHEN op = '{strict}' THEN num {shift} END)"
        f" FILTER (WHERE field = '{field}'), {default})) AS BIGINT) AS {name}"
    )


COLLECTION_BOUNDS = f"""SELECT collection_id,
  {_bound('n_instances', True, 500, 'min_rows')}, {_bound('n_instances', False, 10000, 'max_rows')},
  {_bound('n_features', True, 5, 'min_features')}, {_bound('n_features', False, 100, 'max_features')},
  CAST(max(CASE WHEN field = 'task_subtype' AND value = '''binary''' THEN 2 END) AS BIGINT) AS n_classes
FROM (SELECT *, CASE WHEN field IN ('n_instances', 'n_features') THEN CAST(trim(value) AS BIGINT) END AS num
  FROM {WRITTEN}) GROUP BY collection_id"""
MATCH_PARTS = f"""SELECT 'part_' || p_partkey AS collection_id, dataset_id FROM part JOIN {METRICS}
  ON n_instances BETWEEN p_size * 200 AND p_size * 200 + 400
  AND n_features >= p_partkey % 110 AND n_features < p_partkey % 110 + 4
  AND task = CASE WHEN p_partkey % 2 = 0 THEN 'regression' ELSE 'classification' END"""
BROKEN_REASONS = ["no_header", "row_too_wide", "unclosed_quote", "invalid_utf8", "unreadable"]

ORACLE = {
    "listing_scan": f"""SELECT did, name, n_instances, n_features, number_downloads FROM {LISTING}
WHERE n_instances BETWEEN 500 AND 10000 AND n_features BETWEEN 5 AND 100 AND status = 'active'
  AND n_classes = 2""",
    "listing_scan_by_collection": f"""SELECT b.collection_id, did, n_instances, l.n_features
FROM {LISTING} l JOIN ({COLLECTION_BOUNDS}) b
  ON n_instances BETWEEN min_rows AND max_rows AND l.n_features BETWEEN min_features AND max_features
  AND (b.n_classes IS NULL OR l.n_classes = b.n_classes)
WHERE status = 'active'""",
    "discovered": "SELECT DISTINCT collection_id, dataset_id, TRUE AS has_data FROM " + _cells(CSV_SETS),
    "csv_fleet_cells": _row_digests(CSV_SETS, csv=True),
    "cells": f"""SELECT {KEY}, ordinal, column_name, dtype, count(*) AS n_rows, {DIGESTS}
FROM (SELECT *, md5(chr(31) || coalesce('=' || value, '-')) AS h FROM {_cells(TABLE_SETS)})
GROUP BY {KEY}, ordinal, column_name, dtype""",
    "inferred_dtypes": f"""SELECT collection_id, dataset_id, ordinal, column_name,
  CASE WHEN bool_and({INFERRED_INT}) THEN 'int' WHEN bool_and({INFERRED_NUMBER}) THEN 'float'
    ELSE 'string' END AS dtype
FROM {_cells(TABLE_SETS)} GROUP BY collection_id, dataset_id, ordinal, column_name""",
    "criteria_table": f"""SELECT collection_id, CAST(cond_no AS INTEGER) AS cond_no, field, op, value, n_passing
FROM (VALUES {CRITERIA_ROWS}) AS t(collection_id, cond_no, field, op, value)
JOIN (SELECT collection_id, count(*) FILTER (WHERE passed) AS n_passing FROM {MATCHES}
  GROUP BY collection_id) USING (collection_id)""",
    "raw_sink": "SELECT * FROM customer",
    "catalog_flat": _ledger(WHOLE, PROFILE),
    "catalog_sink": _ledger(WHOLE, PROFILE),
    "profile_sink": _ledger(WHOLE, PROFILE),
    "processed_sink": _row_digests(WHOLE, NARROW_SCREEN),
    "manifest_sink": f"""SELECT collection_id, total_matched_before_clean, final_dataset_count, dataset_id,
  n_instances
FROM (SELECT collection_id, count(*) AS total_matched_before_clean,
  count(*) FILTER (WHERE status = 'validated') AS final_dataset_count
  FROM {NARROW_SCREEN} GROUP BY collection_id)
LEFT JOIN (SELECT collection_id, dataset_id, n_instances FROM {NARROW_ENTRIES}) USING (collection_id)""",
    "export_rows": _row_digests(DERIVED_SETS, NARROW_SCREEN),
    "export_all_rows": _row_digests(WHOLE, NARROW_SCREEN),
    "export_missing": f"SELECT collection_id, dataset_id FROM {NARROW_ENTRIES} WHERE collection_id = 'derived'",
    "resolved_collections": f"SELECT DISTINCT collection_id AS source_collection FROM {NARROW_SCREEN}",
    "status_update": STATUS_UPDATE,
    "status_filter": f"SELECT * FROM ({STATUS_UPDATE}) WHERE status = 'validated'",
    "filter_compare": f"""SELECT dataset_id FROM {METRICS} WHERE n_instances > 400 AND n_instances < 9000
  AND n_features >= 5 AND missing_rate <= 0.1 AND n_classes <> 7 AND imbalance_ratio = 3""",
    "filter_text_ci": f"""SELECT dataset_id FROM {METRICS} WHERE lower(task) = 'classification'
  AND lower(task_subtype) <> 'binary' AND NOT temporal""",
    "filter_all_of": f"""SELECT dataset_id FROM {METRICS} WHERE task = 'classification'
  AND task_subtype = 'binary' AND missing_rate <= 0.05 AND n_instances BETWEEN 500 AND 10000
  AND n_features BETWEEN 5 AND 100""",
    "filter_any_of": f"""SELECT dataset_id FROM {METRICS} WHERE n_instances >= 1000
  AND (task = 'regression' OR (task_subtype = 'multiclass' AND imbalance_ratio >= 5))""",
    "filter_between": f"""SELECT dataset_id FROM {METRICS} WHERE n_instances BETWEEN 500 AND 10000
  AND missing_rate BETWEEN 0.02 AND 0.1""",
    "filter_unknown_field": f"SELECT dataset_id FROM {METRICS} WHERE n_features <= 50",
    "filter_expr": f"""SELECT dataset_id FROM {METRICS} WHERE task = 'classification'
  AND task_subtype = 'binary' AND missing_rate <= 0.05 AND n_instances >= 500 AND n_instances <= 10000
  AND n_features >= 5 AND n_features <= 100""",
    "filter_expr_bare": f"SELECT dataset_id FROM {METRICS} WHERE task = 'classification'",
    "filter_reason": f"SELECT dataset_id, {_reason('multiclass_imbalanced_core')} AS reason FROM {METRICS}",
    "match_collections": f"SELECT collection_id, dataset_id, passed, reason FROM {MATCHES}",
    "match_passing": f"SELECT collection_id, dataset_id FROM {MATCHES} WHERE passed",
    "match_criteria_table": f"SELECT collection_id, dataset_id, passed, reason FROM {MATCHES}",
    "explain_criteria_table": f"SELECT collection_id, dataset_id, passed, reason FROM {MATCHES}",
    "match_part_collections": MATCH_PARTS,
    "sorted_by_collection": f"""SELECT collection_id, dataset_id, row_number() OVER (PARTITION BY collection_id ORDER BY
  CASE WHEN collection_id = 'multiclass_imbalanced_core' THEN -imbalance_ratio END, n_instances, dataset_id) AS sort_rank
FROM {MATCHES} WHERE passed""",
    "csv_failed": "SELECT 'csv' AS collection_id, dataset_id, reason FROM (VALUES "
    + ", ".join(f"('{t}', '{BROKEN_REASONS[i % 6]}')" for i, t in enumerate(SCHEMAS) if i % 6 < 5)
    + ") AS t(dataset_id, reason)",
    "stored_status": STATUS_UPDATE,
    "features_only": _row_digests(
        [dataset("features", "lineitem", "lineitem", SCHEMAS["lineitem"].replace(" l_returnflag string,", ""))]
    ),
    "export_readback": _row_digests(WHOLE, NARROW_SCREEN, csv=True),
    "coerce_values": f"""SELECT cond_no, field,
  CASE WHEN field IN ('n_instances', 'n_features', 'missing_rate') THEN
    TRY_CAST(CASE WHEN regexp_full_match(trim(value), '[0-9.e-]+') THEN trim(value) END AS DOUBLE) END AS num_value,
  CASE WHEN field = 'temporal' THEN CASE lower(trim(value)) WHEN 'true' THEN TRUE WHEN 'y' THEN TRUE
    WHEN 'no' THEN FALSE END END AS bool_value,
  CASE WHEN field IN ('task', 'task_subtype') THEN trim(trim(value), '"''') END AS text_value
FROM {WRITTEN}""",
    "collection_bounds": COLLECTION_BOUNDS,
    "license_gate": f"""SELECT did, name FROM {LISTING}
WHERE (coalesce(licence, '') <> '' OR coalesce(license, '') <> '')
  AND (coalesce(citation, '') <> '' OR coalesce(paper_url, '') <> '')""",
    "non_empty": f"SELECT dataset_id, n_features * 10 AS n_instances FROM {METRICS} WHERE n_features > 0",
    "drop_missing_target": f"SELECT * FROM {DIRTY} WHERE tgt IS NOT NULL",
    "dedup_rows": f"SELECT DISTINCT * FROM {DIRTY}",
    "drop_sparse_columns": f"SELECT {KEY}, column_name FROM {_flags(WHOLE)} WHERE is_sparse",
    "drop_constant_columns": f"SELECT {KEY}, column_name FROM {_flags(WHOLE)} WHERE is_constant",
    "drop_id_columns": f"SELECT {KEY}, column_name FROM {_flags(WHOLE)} WHERE is_id",
    "clean_classification": f"SELECT {DIRTY_NAMES} FROM (SELECT DISTINCT * FROM {DIRTY} WHERE tgt IS NOT NULL)",
    "clean_regression": f"SELECT DISTINCT {LINEITEM_NAMES} FROM lineitem WHERE l_quantity IS NOT NULL",
    "gate_table": f"""SELECT task, target_variable, n_classes, smallest_class, n_instances, n_features, reason,
  status FROM {_screen(DERIVED_SETS[3:])}""",
    "output_fields": f"""SELECT dataset_id, name, task, task_subtype, CAST(NULL AS VARCHAR) AS target_variable,
  CAST(NULL AS VARCHAR) AS source_repository, CAST(NULL AS VARCHAR) AS source_id, n_instances, n_features,
  n_classes, missing_rate, imbalance_ratio, temporal, grouped, academic_usage, license, status
FROM {METRICS}""",
    "academic_join": f"""SELECT collection_id, c.dataset_id, coalesce(nullif(citation, ''), 'unknown') AS citation,
  coalesce(nullif(paper_url, ''), 'unknown') AS paper_url,
  coalesce(nullif(licence, ''), nullif(license, ''), 'unknown') AS license
FROM {NAMED_CATALOG} c LEFT JOIN {LATEST_ACTIVE} l ON c.dataset_id = l.dataset_id""",
    "target_lookup": f"""SELECT collection_id, dataset_id, column_name AS target_variable
FROM {PROFILE} WHERE is_target
UNION ALL SELECT 'tables', lower(r_name), 'unknown' FROM region""",
    "missing_source": f"""SELECT task AS collection_id, dataset_id, 'cataloged' AS status FROM {METRICS}
WHERE status <> 'active'""",
    "column_profile": f"""SELECT {KEY}, ordinal, column_name, dtype, is_target, n_rows, n_missing, n_unique,
  min_count, max_count FROM {PROFILE}""",
    "table_shape": f"""SELECT {KEY}, max(n_rows) AS n_instances, count(*) - 1 AS n_features FROM {PROFILE}
GROUP BY {KEY}""",
    "column_missing": f"""SELECT {KEY}, CAST(sum(n_missing) AS BIGINT) AS missing_cells,
  {_names('n_missing > 0', 'columns_with_missing')} FROM {PROFILE} GROUP BY {KEY}""",
    "missing_rate": f"""SELECT {KEY}, round(CAST(sum(n_missing) AS DOUBLE) / sum(n_rows), 4) AS missing_rate
FROM {PROFILE} GROUP BY {KEY}""",
    "column_nunique": f"SELECT {KEY}, ordinal, column_name, n_unique FROM {PROFILE}",
    "class_counts": f"SELECT tgt, count(*) AS n_rows FROM {DIRTY} WHERE tgt IS NOT NULL GROUP BY tgt",
    "class_summary": """SELECT count(*) AS n_classes, min(n) AS smallest_class, max(n) AS largest_class
FROM (SELECT count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type)""",
    "imbalance_ratio": """SELECT round(CAST(max(n) AS DOUBLE) / min(n), 6) AS imbalance_ratio
FROM (SELECT count(*) AS n FROM events WHERE props IS NOT NULL GROUP BY props)""",
    "p_to_n_ratio": f"""SELECT {KEY}, round(CAST(count(*) - 1 AS DOUBLE) / max(n_rows), 9) AS p_to_n_ratio
FROM {PROFILE} GROUP BY {KEY}""",
    "duplicate_rows": "SELECT * FROM " + _duplicates(WHOLE),
    "constant_columns": f"SELECT {KEY}, {_names('n_unique = 1', 'constant_columns')} FROM {PROFILE} GROUP BY {KEY}",
    "high_cardinality_columns": f"""SELECT {KEY},
  {_names('n_unique = n_rows AND n_rows > 1', 'high_cardinality_columns')} FROM {PROFILE} GROUP BY {KEY}""",
    "feature_types": f"""SELECT {KEY}, count(*) FILTER (WHERE dtype IN ('int', 'float')) AS numeric,
  count(*) FILTER (WHERE dtype = 'string') AS categorical, count(*) FILTER (WHERE n_unique = 2) AS binary,
  count(*) FILTER (WHERE dtype = 'datetime') AS datetime FROM {PROFILE} GROUP BY {KEY}""",
    "size_estimate": f"""SELECT {KEY}, round(CAST(sum(bytes) AS DOUBLE) / 1048576, 3) AS memory_usage_mb
FROM {PROFILE} GROUP BY {KEY}""",
    "infer_task": f"""SELECT {KEY}, {TARGET.format('column_name')} AS target_variable, {_task('max(n_rows)')} AS task
FROM {PROFILE} GROUP BY {KEY}""",
    "dataset_metrics": f"""SELECT {KEY}, n_instances, n_features, n_classes, missing_rate, p_to_n_ratio,
  CASE WHEN {CLASSED} THEN 'classification' ELSE 'regression' END AS task,
  CASE WHEN {CLASSED} THEN CASE WHEN n_classes = 2 THEN 'binary' WHEN n_classes > 2 THEN 'multiclass'
    ELSE 'unknown' END WHEN n_classes > 0 THEN 'continuous' ELSE 'unknown' END AS task_subtype,
  CASE WHEN {CLASSED} AND n_classes >= 2 THEN round(CAST(largest AS DOUBLE) / smallest, 9) ELSE 1.0 END
    AS imbalance_ratio,
  FALSE AS temporal, FALSE AS grouped, TRUE AS academic_usage
FROM (SELECT {KEY}, max(n_rows) AS n_instances, count(*) - 1 AS n_features,
  {TARGET.format('n_unique')} AS n_classes, {TARGET.format('dtype')} AS dtype,
  {TARGET.format('min_count')} AS smallest, {TARGET.format('max_count')} AS largest,
  round(CAST(sum(n_missing) AS DOUBLE) / sum(n_rows), 9) AS missing_rate,
  round(CAST(count(*) - 1 AS DOUBLE) / max(n_rows), 9) AS p_to_n_ratio
  FROM {PROFILE} GROUP BY {KEY})""",
    "dataset_profile": f"""SELECT {KEY}, {_task('max(n_rows)')} AS task,
  {TARGET.format('column_name')} AS target_variable, max(n_rows) AS n_instances, count(*) AS n_features,
  round(CAST(sum(n_missing) AS DOUBLE) / sum(n_rows), 4) AS missing_rate,
  max(duplicate_rows) AS duplicate_rows, round(CAST(sum(bytes) AS DOUBLE) / 1048576, 3) AS memory_usage_mb,
  count(*) FILTER (WHERE dtype IN ('int', 'float')) AS numeric,
  count(*) FILTER (WHERE dtype = 'string') AS categorical, count(*) FILTER (WHERE n_unique = 2) AS binary,
  count(*) FILTER (WHERE dtype = 'datetime') AS datetime, {_names('n_unique = 1', 'constant_columns')},
  {_names('n_unique = n_rows AND n_rows > 1', 'high_cardinality_columns')},
  {_names('n_missing > 0', 'columns_with_missing')}
FROM {PROFILE} JOIN {_duplicates(WHOLE)} USING (collection_id, dataset_id) GROUP BY {KEY}""",
    "dataset_tags": f"""SELECT dataset_id, concat_ws(',', CASE WHEN imbalance_ratio >= 3 THEN 'imbalanced' END,
  CASE WHEN missing_rate <= 0.05 THEN 'clean' END, CASE WHEN n_instances <= 1500 THEN 'small' END,
  CASE WHEN n_instances >= 5000 THEN 'large' END, CASE WHEN n_features >= 50 THEN 'high_dimensional' END,
  CASE WHEN n_features <= 10 THEN 'low_dimensional' END, CASE WHEN temporal THEN 'temporal' END,
  CASE WHEN grouped THEN 'grouped' END) AS tags FROM {METRICS}""",
    "gate_outcomes": f"SELECT {KEY}, status, reason FROM {WHOLE_SCREEN}",
    "gate_outcomes_large": f"SELECT {KEY}, status, reason FROM {LARGE_SCREEN}",
    "gate_outcomes_ledger": f"""SELECT {KEY},
  CASE WHEN dataset_id = 'part' THEN 'rejected' ELSE status END AS status,
  CASE WHEN dataset_id = 'part' THEN 'profile_missing' ELSE reason END AS reason FROM {NARROW_SCREEN}
UNION ALL SELECT 'tables', lower(n_name), 'rejected', 'source_missing' FROM nation""",
    "screening_record": f"SELECT * FROM {LARGE_SCREEN}",
    "cleaning_report": f"""SELECT {KEY}, missing_target_rows, duplicate_rows, sparse_columns, constant_columns,
  id_columns FROM {WHOLE_SCREEN}""",
    "clean_fleet": _row_digests(WHOLE, NARROW_SCREEN),
    "frozen_metadata": f"""SELECT {KEY}, {_title("replace(dataset_id, '_', ' ')")} AS name, task, target_variable,
  n_instances, n_features, missing_rate, numeric, categorical, status
FROM {LARGE_SCREEN} WHERE status = 'validated'""",
    "collection_totals": f"""SELECT collection_id, count(*) AS total_matched_before_clean,
  count(*) FILTER (WHERE status = 'validated') AS final_dataset_count
FROM {WHOLE_SCREEN} GROUP BY collection_id""",
    "manifest": f"""SELECT collection_id || '_resolved_v1' AS manifest_id, collection_id AS source_collection,
  total_matched_before_clean, final_dataset_count, CAST(4 AS INTEGER) AS n_filters, position, dataset_id,
  n_instances
FROM (SELECT collection_id, count(*) AS total_matched_before_clean,
  count(*) FILTER (WHERE status = 'validated') AS final_dataset_count FROM {LARGE_SCREEN}
  GROUP BY collection_id)
LEFT JOIN (SELECT collection_id, dataset_id, n_instances, CAST(row_number() OVER (PARTITION BY collection_id
  ORDER BY dataset_id) - 1 AS INTEGER) AS position FROM {LARGE_SCREEN} WHERE status = 'validated')
USING (collection_id)""",
    "manifest_top_k": f"""SELECT {KEY}, CAST(position AS INTEGER) AS position FROM (SELECT {KEY},
  row_number() OVER (PARTITION BY collection_id ORDER BY dataset_id) AS position
  FROM {LARGE_SCREEN} WHERE status = 'validated') WHERE position <= 2""",
    "top_popular": f"""SELECT collection_id, dataset_id, number_downloads, CAST(popularity AS INTEGER) AS popularity
FROM (SELECT *, row_number() OVER (PARTITION BY collection_id ORDER BY number_downloads DESC, did) AS popularity
  FROM {MATCHES} WHERE passed AND status = 'active' AND n_instances BETWEEN 500 AND 10000
  AND n_features BETWEEN 5 AND 100 AND (coalesce(licence, '') <> '' OR coalesce(license, '') <> '')
  AND (coalesce(citation, '') <> '' OR coalesce(paper_url, '') <> '')) WHERE popularity <= 30""",
    "listing_latest": f"SELECT dataset_id, did, name, citation FROM {LATEST}",
    "preferred_sort": f"""SELECT collection_id, dataset_id, imbalance_ratio, n_instances,
  row_number() OVER (PARTITION BY collection_id ORDER BY imbalance_ratio DESC, n_instances, dataset_id) AS sort_rank
FROM {MATCHES} WHERE passed AND collection_id = 'multiclass_imbalanced_core'""",
    "sanitize_name": "SELECT p_partkey, "
    + _sanitize("' ' || p_name || ' (' || p_type || ')--' || p_brand || '! '")
    + " AS folder FROM part",
    "slugify": """SELECT p_partkey, CASE WHEN p_size = 1 THEN 'collection'
  ELSE trim(regexp_replace(lower('--' || p_name || ' & ' || p_brand || '!'), '[^a-z0-9]+', '_', 'g'), '_') END
  AS slug FROM part""",
    "display_name": "SELECT p_partkey, "
    + _title("replace(" + _sanitize("p_name || ' ' || p_type") + ", '_', ' ')")
    + " AS title FROM part",
    "split_80_20": """SELECT o_orderkey, o_orderpriority, CASE WHEN rank <= ceil(size * 0.8) THEN 'train'
  ELSE 'test' END AS part
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(CAST(o_orderkey AS VARCHAR)),
  o_orderkey) AS rank, count(*) OVER (PARTITION BY o_orderpriority) AS size FROM orders)""",
    "classification_scores": f"""WITH classes AS (SELECT DISTINCT l_linestatus, label AS cls FROM {CONFUSION}
  UNION SELECT DISTINCT l_linestatus, guess FROM {CONFUSION}),
per AS (SELECT c.l_linestatus, c.cls, CAST(count(*) FILTER (WHERE label = cls AND guess = cls) AS DOUBLE) AS hits,
  count(*) FILTER (WHERE label = cls) AS actual, count(*) FILTER (WHERE guess = cls) AS predicted
  FROM classes c JOIN {CONFUSION} d ON c.l_linestatus = d.l_linestatus GROUP BY c.l_linestatus, c.cls)
SELECT l_linestatus, round(sum(hits) / sum(actual), 9) AS accuracy,
  round(avg(CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END), 9) AS macro_precision,
  round(avg(CASE WHEN actual > 0 THEN hits / actual ELSE 0 END), 9) AS macro_recall,
  round(avg(CASE WHEN actual + predicted > 0 THEN 2 * hits / (actual + predicted) ELSE 0 END), 9) AS macro_f1
FROM per GROUP BY l_linestatus""",
    "roc_auc": """WITH ranks AS (SELECT l_linestatus, l_returnflag = 'R' AS is_pos,
  rank() OVER (PARTITION BY l_linestatus ORDER BY l_extendedprice)
  + (count(*) OVER (PARTITION BY l_linestatus, l_extendedprice) - 1) / 2.0 AS mid FROM lineitem),
sums AS (SELECT l_linestatus, CAST(sum(mid) FILTER (WHERE is_pos) AS DOUBLE) AS ranksum,
  CAST(count(*) FILTER (WHERE is_pos) AS DOUBLE) AS p, CAST(count(*) FILTER (WHERE NOT is_pos) AS DOUBLE) AS n
  FROM ranks GROUP BY l_linestatus)
SELECT l_linestatus, round((ranksum - p * (p + 1) / 2) / (p * n), 9) AS auc FROM sums""",
    "regression_scores": """SELECT l_returnflag,
  round(1 - sum((l_extendedprice - guess) ** 2) / (var_pop(l_extendedprice) * count(*)), 6) AS r2,
  round(sqrt(avg((l_extendedprice - guess) ** 2)), 3) AS rmse, round(avg(abs(l_extendedprice - guess)), 3) AS mae
FROM (SELECT *, l_quantity * 1500 + 1000 AS guess FROM lineitem) GROUP BY l_returnflag""",
}
