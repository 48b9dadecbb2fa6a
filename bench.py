"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local threads).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from statloom.queries import all_queries

HEADLINE = [
    "d7_trade_by_partner", "d7_trade_by_commodity", "d7_trade_by_partner_group",
    "d7_trade_semiconductors", "d7_trade_minerals", "d8_trade_by_region", "d8_trade_annual",
    "a1_marginals", "a3_annual_balance", "a4_to_quarter_sum", "a6_n_distinct", "a7_share_where",
    "a9_code_profile", "a10_coverage_audit", "a11_reconcile", "o3_top_partners",
    "w1_yoy", "w4_roll_sum", "w6_make_unique", "w7_pick_spread", "r5_fill_down",
    "r6_split_header_rows", "j2_natural_full", "j7_anti_semi", "f1_squish", "f7_parse_number",
    "s4_scan_vintages", "s9_extract_links", "s14_pending", "d9_accounts_quarterly_exp",
    "d11_inflation_large", "d16_ngcor_mean", "d17_ngdebt", "d18_tax_types", "d25_inspect", "d26_compile", "d19_crops_annual", "d20_prices_monthly",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("statloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    known[HEADLINE[0]].run(spark, sf).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        known[name].run(spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds over headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
        "spark": spark.version, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
