"""Compare every registered query with its oracle from a default session
(no aurum settings: 200 shuffle partitions, default AQE), as a caller's own
session would run them. Floats are compared exactly.

Usage: python scripts/verify_default_session.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import SparkSession

    from scripts import compare_oracle

    compare_oracle.EXACT = True
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    res = compare_oracle.compare(spark, sf_dir, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    print(f"shuffle_partitions={spark.conf.get('spark.sql.shuffle.partitions')} "
          f"ok={sum(v[0] == 'OK' for v in res.values())} bad={bad}")


if __name__ == "__main__":
    main()
