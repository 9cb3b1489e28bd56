"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Every query is run in full into a sink that discards its rows. The tables come as one file each, which one
task would read; they are landed in several files first, as a lake holds them, before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from jobmeld.functions.text import unescape  # noqa: E402
from jobmeld.queries.registry import QUERIES  # noqa: E402
from jobmeld.session import build_session  # noqa: E402
from jobmeld.sources.store import SnapshotStore  # noqa: E402

HEADLINE = [
    "nrm1_name_key",
    "nrm4_address",
    "nrm5_clean_html",
    "nrm7_clean_text",
    "fn7_salary",
    "dd1_job",
    "agg2_mutual_unique",
    "idr1_name",
    "idr8_all_matchers",
    "idr9_cascade",
    "idr11_merge_parity",
    "ups1_survivorship",
    "ups3_coalesce",
    "ups5_job_feed",
    "jn5_job_company",
    "ext2_jobs_topcv",
    "ext8_labelled_values",
    "ext10_links",
    "enr1_education",
    "enr2_category",
    "enr4_skills",
    "udf3_scorer_errors",
    "st3_upsert",
    "pip4_master_jobs",
]

# input rows of the two published rates: clean and normalise, identify
RATED = {
    "normalise": ("nrm1_name_key", ["supplier", "customer", "documents"]),
    "identify": ("idr9_cascade", ["supplier", "customer"]),
}


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"]


def landed(spark, sf: str, files: int) -> str:
    """The tables in several files each."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for t in TABLES:
        spark.read.parquet(f"{sf}/{t}.parquet").repartition(files).write.parquet(f"{folder}/{t}.parquet")
    return folder


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start-up of the session and of its Python workers is not a query's time
    region = spark.read.parquet(f"{sf}/region.parquet").repartition(int(spark.sparkContext.defaultParallelism))
    region.select(unescape(F.col("r_name"))).write.format("noop").mode("overwrite").save()
    tables = landed(spark, sf, int(spark.sparkContext.defaultParallelism))
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    # the published simple query, over a table that is there: not part of the total
    tables_of = SnapshotStore(spark, f"{tables}/store")
    tables_of.write(spark.read.parquet(f"{tables}/orders.parquet"), "master/recruit")
    view = tables_of.register("master/recruit")
    start = time.perf_counter()
    spark.sql(f"SELECT o_orderstatus, count(*), max(o_totalprice) FROM {view} GROUP BY o_orderstatus").collect()
    sql_seconds = round(time.perf_counter() - start, 3)
    rates = {}
    for label, (name, tables) in RATED.items():
        rows = sum(spark.read.parquet(f"{sf}/{t}.parquet").count() for t in tables)
        rates[f"{label}_records_per_sec"] = round(rows / times[name], 1)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rates": rates,
                "sql_query_sec": sql_seconds,
                "sf": os.path.basename(sf.rstrip("/")),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
