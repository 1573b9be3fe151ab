"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local threads. Every query runs
twice: ``queries`` and ``value`` are of the second run, when the JVM has compiled the code, and
``first_run`` has the same for the first.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from vinlake.contract.queries import QUERIES  # noqa: E402
from vinlake.session import get_session  # noqa: E402

# All queries of the warehouse. The operators of the corpus are measured by their own tests.
HEADLINES = list(QUERIES)


def timed(spark: SparkSession, name: str, folder: str) -> float:
    """Seconds to plan and run a query, its rows read but not kept."""
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begin, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    spark = get_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    first, second = ({name: timed(spark, name, folder) for name in names} for _ in range(2))
    result = {"metric": "headline_queries_total", "value": round(sum(second.values()), 3), "unit": "sec"}
    result |= {"queries": second, "sf": os.path.basename(folder.rstrip("/")), "first_run": first}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
