"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local threads. The load of
the star tables is timed first and once, on a cold JVM. Every query then runs once to
warm up and is timed from plan building to the last result row; reports read the loaded
star, builders (d_, f_, c_) start from the raw tables.
"""

from __future__ import annotations

import datetime
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from dimstar.plans import reports as r  # noqa: E402
from dimstar.plans.load import load_star  # noqa: E402
from dimstar.registry import QUERIES  # noqa: E402
from dimstar.session import configure  # noqa: E402

QUARTER = datetime.date(1999, 8, 1)
WEEKS = (datetime.date(1999, 6, 1), datetime.date(1999, 10, 1))
# Reports with the selections their authors run: one quarter, one key, one brand.
SELECTED = {
    "one_quarter_r01": lambda s: r.below_quota_coverage(s, quarter=QUARTER),
    "one_display_r02": lambda s: r.rolling_trend(s, display=WEEKS),
    "one_quarter_r03": lambda s: r.attainment_ranking(s, quarter=QUARTER),
    "one_rep_r04": lambda s: r.transfer_attribution(s, durable_key="REP-1"),
    "one_hcp_r05": lambda s: r.co_promotion_credit(s, group_key=7),
    "one_quarter_r07": lambda s: r.yoy_attainment(s, quarter=QUARTER),
    "one_brand_r11": lambda s: r.indication_impact(s, brand="PROMO"),
    "one_quarter_r12": lambda s: r.drill_across_top_decile(s, quarter=QUARTER),
}
HEADLINE = [
    *[n for n in QUERIES if n.startswith("r") and not n.endswith("_current_only")],
    "w_ntile_decile",
    "w_running_total_one_group",
    "d_scd2",
    "d_surrogate_key",
    "f_weekly_snapshot",
    "f_monthly_rollup",
    "f_timespan_compress",
    "f_stamp_keys",
    "f_apply_corrections",
    "c_rollup_drift",
]


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("dimstar-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    star = load_star(configure(spark), folder)
    seconds = {"load_star": round(time.perf_counter() - start, 3)}
    builds = {n: lambda n=n: QUERIES[n].run(spark, folder) for n in HEADLINE}
    builds |= {n: lambda f=f: f(star) for n, f in SELECTED.items()}
    for name, build in builds.items():
        timed(build)
        seconds[name] = round(timed(build), 3)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
                "lineitem_rows": lines,
            }
        )
    )


if __name__ == "__main__":
    main()
