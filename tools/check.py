"""Run registered queries against their SQL in DuckDB: ``python tools/check.py sf_dir [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablevet.plans.inputs import TABLES  # noqa: E402
from tablevet.plans.oracle import ORACLE  # noqa: E402
from tablevet.plans.queries import REGISTRY  # noqa: E402


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.maxResultSize", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tablevet-"))
        .getOrCreate()
    )


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def canonical(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, sf_dir: str, name: str) -> tuple[bool, str]:
    start = time.time()
    df = REGISTRY[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    if name not in ORACLE:
        return True, f"{len(rows)} rows, no SQL, {spent:.1f} s"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = con.execute(ORACLE[name])
    sql_names = [c[0] for c in cursor.description]
    sql_types = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    types = " ".join(f"{f.name}:{f.dataType.simpleString()}/{sql_types.get(f.name)}" for f in df.schema)
    if sorted(df.columns) != sorted(sql_names):
        return False, f"columns {sorted(df.columns)} / {sorted(sql_names)}"
    got, want = canonical(rows, df.columns), canonical(expected, sql_names)
    if got != want:
        odd = [(g, w) for g, w in zip(got, want) if g != w][:3]
        return False, f"rows {len(got)} / {len(want)}, {odd} {types}"
    return True, f"{len(got)} rows, {spent:.1f} s  {types}"


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        try:
            ok, text = compare(spark, sf_dir, name)
        except Exception as error:  # report every query
            ok, text = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, text, flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
