"""Time every registered query. Prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayside.queries import all_queries  # noqa: E402
from quayside.session import local_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"})
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    queries = {n: q for n, q in all_queries().items() if not chosen or n in chosen}
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()

    seconds = {}
    for name, query in queries.items():
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", os.path.basename(folder.rstrip("/")))
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
