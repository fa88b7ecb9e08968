"""Run the registered queries and print time and comparison: run_queries.py SF_DIR [name...]"""

import sys
import time
import traceback

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")

from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = connect(sf_dir), entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                verdict = compare(con, df, oracles[name]) or "equal"
            else:
                rows = df.collect()
                verdict = f"no sql, {len(rows)} rows, {[tuple(r) for r in rows[:4]]}"
        except Exception as error:
            verdict = "ERROR " + "".join(traceback.format_exception_only(error))[:600] + " ".join(l for l in str(error).splitlines() if "Caused" in l or "Serialization" in l or "- " in l[:6])[:3000]
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
