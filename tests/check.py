"""Run registered queries against their SQL: ``python tests/check.py [sf_dir] [name ...]``."""

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import compare
from pyspark.sql import SparkSession

import __spark_entry__ as entry

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="check-"))
    .config("spark.driver.memory", "8g")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = compare.connect(sf_dir)
oracles = entry.oracle_sql()
bad = []
for name, build in entry.queries().items():
    if names and name not in names:
        continue
    start = time.time()
    try:
        df = build(spark, sf_dir)
        columns, rows = compare.spark_rows(df)
        took = time.time() - start
        if name not in oracles:
            print(f"rows-only {name}: {len(rows)} rows {took:.1f}s")
            continue
        start = time.time()
        d_columns, d_rows = compare.duck_rows(con, oracles[name])
        duck = time.time() - start
        types = compare.spark_types(df)
        d_types = compare.duck_types(con, oracles[name])
        ok = columns == d_columns and rows == d_rows and types == d_types and len(rows) > 0
        print(f"{'ok ' if ok else 'BAD'} {name}: {len(rows)}/{len(d_rows)} rows spark {took:.1f}s duck {duck:.1f}s")
        if not ok:
            bad.append(name)
            if columns != d_columns:
                print("   columns", columns, d_columns)
            if types != d_types:
                print("   types", types, d_types)
            only_s, only_d = set(rows) - set(d_rows), set(d_rows) - set(rows)
            for tag, some in (("spark", only_s), ("duck", only_d)):
                for row in sorted(some)[:3]:
                    print("   only", tag, len(some), str(row)[:600])
    except Exception as error:  # noqa: BLE001
        bad.append(name)
        print(f"ERR {name}: {str(error)[:1500]}")
print("bad:", bad)
