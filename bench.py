"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
runs over whole tables and its result is computed in full but not kept.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

import checks
from matchloom.session import build_session

HEADLINES = """C1_wide_team_stats J7_join_families J7_A1_collapse_families J2_with_presence_flags J3_missing_matches
    J4_attach_league_by_match_id J8_lineup_with_stats A1_collapse A2_wage_totals A4_null_profile A12_load_progress
    P12_conform P14_frames_differ P16_select_stat_columns D2_first_per_key W1_forward_fill W3_dense_index
    O3_first_n_per_group U1_relaxed_union F11_event_players M1_score_intensity M3_posterior_mean M5_lineup_arrays
    S1_read_csv_union S7_write_sorted S11_ingest_increment H1_page_links C1_extract_team_stats""".split()


def seconds(spark, directory: str, name: str) -> float:
    start = time.perf_counter()
    checks.QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds(spark, directory, HEADLINES[0])  # warm-up
    timed = {n: round(statistics.median(seconds(spark, directory, n) for _ in range(repeats)), 3) for n in HEADLINES}
    scale = re.search(r"sf([0-9.]+)", directory)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": float(scale[1]) if scale else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
