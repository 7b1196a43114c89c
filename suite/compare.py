"""Run queries in Spark and DuckDB over one folder and compare the rows."""

from __future__ import annotations

import atexit
import glob
import os
import shutil
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def local_session(shared: str | None = None) -> SparkSession:
    """A session in this JVM; ``shared`` is the folder of intermediate tables, else one that goes when the process ends."""
    if shared is None:
        shared = tempfile.mkdtemp(prefix="playcohort-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    spark = (
        SparkSession.builder.master("local[8]").appName("suite").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true").config("spark.checkpoint.dir", f"file://{shared}").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(df: DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr)


def compare(spark: SparkSession, con, folder: str, name: str, fn, sql: str | None) -> tuple[bool, str]:
    start = time.time()
    df = fn(spark, folder)
    got = rows_of(df)
    took = time.time() - start
    if sql is None:
        return True, f"{len(got)} rows, no SQL, {took:.1f}s"
    names, want = oracle_rows(con, sql)
    if names != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {names}"
    if got != want:
        a, b = set(got), set(want)
        return False, f"{len(got)} rows against {len(want)}; {names}\n  only here {sorted(a - b, key=repr)[:3]}\n  only SQL  {sorted(b - a, key=repr)[:3]}"
    return True, f"{len(got)} rows, {took:.1f}s"


def main(folder: str, wanted: list[str]) -> int:
    from suite import load_all

    reg = load_all()
    spark, con, bad = local_session(), duck(folder), 0
    for name, fn in reg.QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            ok, note = compare(spark, con, folder, name, fn, reg.ORACLES.get(name))
        except Exception as error:  # report every query, whatever one of them raises
            ok, note = False, f"{type(error).__name__}: {str(error)[:900]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failures", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
