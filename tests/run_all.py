"""python -m tests.run_all SF_DIR [NAME...]: all registered queries in one session, in the order of registration, against their SQL.

Not collected by pytest: it is what a long-lived session meets, one query after another. Prints a line for each query that fails, and a summary.
"""

import math
import sys
import tempfile
import time
from pathlib import Path

import __spark_entry__ as entry
import duckdb
from pyspark.sql import SparkSession


def tidy(v):
    if type(v).__name__ == "Decimal":
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.7g}")
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


def main(sf: str, names: list[str]) -> int:
    home = tempfile.mkdtemp(prefix="spark-")
    spark = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.sql.warehouse.dir", f"{home}/warehouse").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    db = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        db.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    sql, bad, done = entry.oracle_sql(), [], 0
    for name, f in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = f(spark, sf)
            cols = sorted(df.columns)
            got = sorted(repr([tidy(r[c]) for c in cols]) for r in df.collect())
            if name in sql:
                said = db.sql(sql[name])
                want = sorted(repr([tidy(r[said.columns.index(c)]) for c in cols]) for r in said.fetchall()) if sorted(said.columns) == cols else said.columns
                if got != want:
                    bad.append(name)
                    print(f"{name}: {len(got)} rows differ from {len(want)}: {next((x for x in zip(got, want, strict=False) if x[0] != x[1]), '')}"[:600], flush=True)
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"{name}: {type(e).__name__} {str(e)[:600]}", flush=True)
        done += 1
        if time.time() - began > 20:
            print(f"{name} took {time.time() - began:.0f} s", flush=True)
    print(f"{done} queries, {len(bad)} failed: {bad}")
    return int(bool(bad))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
