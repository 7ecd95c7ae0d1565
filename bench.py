"""Benchmark: wall time of the headline queries, written to the no-op sink.

Prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (names, or
``all``) choose data, cores and queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom.queries import QUERIES  # noqa: E402
from tallyloom.session import build_session  # noqa: E402

HEADLINE = """
flagship_topk_entities entity_rollup rollup_ratios lifetime_rollup contacts_top10 dedupe_first dedupe_last dedupe_unrepeated
name_incoming google_report_rows google_placement_rows align_schema null_fill report_csv_rows anti_existing new_vs_existing
render_campaigns post_insights name_lookup first_success strip_emoji text_clean link_extract date_build html_clean html_repair
stat_array_map actions_long targeting_segments posts_rows load_append load_upsert load_increment load_counts load_snapshot
load_partitioned sms_campaign_rows sms_click_refresh newsletter_candidates run_totals stream_equals_batch
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "").split()
    names = list(QUERIES) if wanted == ["all"] else wanted or HEADLINE
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")}
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    # One small pass starts the JVM's and the Python workers' machinery.
    QUERIES["entity_rollup"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
