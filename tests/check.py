"""Run registered queries against their SQL: python tests/check.py [folder] [name part ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import connect, differences
from pyspark.sql import SparkSession

import __spark_entry__ as entry

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, bad = connect(folder), entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        at = time.time()
        try:
            df = fn(spark, folder)
            found = differences(df, db, sql[name]) if name in sql else [] if df.count() >= 0 else ["?"]
        except Exception as e:  # noqa: BLE001
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - at:.1f}s", "" if name in sql else "(no SQL)", flush=True)
        for line in found:
            print("     ", line[:900], flush=True)
        bad += [name] if found else []
    print("failed:", bad)
