"""Time the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
write (full computation, no collect). Before timing, every headline query
runs once on the smallest tables (BENCH_WARMUP_DIR, default sf0.001) so JIT
and codegen warm-up is not charged to whichever query comes first; a
query's time is the median over BENCH_REPEAT runs. The line also has the other
queries' times (one run), the headline queries' on a tenth of the data
(BENCH_SMALL_DIR), and DuckDB's for the same SQL.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lavra.plans import catalog  # noqa: E402
from lavra.session import build_session  # noqa: E402

HEADLINE = [
    "procurement_report", "report_class", "dedup_first", "json_flatten", "keyword_filter",
    "classify_works", "br_decimal_parse", "iso_ts_parse", "multi_date_parse", "strip_text",
    "concat_skip_blank", "centroid", "left_join_nullsafe", "html_links", "header_row",
    "contiguous_watermark", "outcome_diagnostics", "window_plan", "ledger_pending",
    "latest_variant", "coverage", "topn_preview", "nullable_int", "zip_members",
    "mining_report", "permits_report", "tenders_silver", "investments_silver",
]


def duckdb_seconds(sf_dir: str, names: list[str]) -> dict[str, float]:
    """DuckDB's time for the same SQL over the same files, an outside yardstick."""
    import duckdb

    from lavra.plans.oracle import SQL
    from lavra.plans.tables import TABLES

    con, out = duckdb.connect(), {}
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    for name in names:
        if name in SQL:
            t0 = time.perf_counter()
            con.sql(SQL[name]).fetchall()
            out[name] = round(time.perf_counter() - t0, 3)
    return out


def timed(spark, name: str, sf_dir: str, repeat: int) -> float:
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        catalog.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", cpus, app_name="lavra-bench",
                          extra={"spark.driver.memory": "16g"})
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in HEADLINE:
        catalog.run(name, spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {name: timed(spark, name, sf_dir, repeat) for name in HEADLINE}
    # as far as BENCH_EXTRA_SEC goes: the headline queries on a tenth of the data (what is fixed
    # cost and what grows), and the other queries once each, outside the headline total
    until = time.perf_counter() + float(os.environ.get("BENCH_EXTRA_SEC", "150"))
    small = os.environ.get("BENCH_SMALL_DIR", sf_dir.replace("sf0.1", "sf0.01"))
    tenth, others = {}, {}
    for name in HEADLINE if small != sf_dir and os.path.isdir(small) else []:
        if time.perf_counter() < until:
            tenth[name] = timed(spark, name, small, 1)
    for name in catalog.QUERIES:
        if name not in HEADLINE and time.perf_counter() < until:
            others[name] = timed(spark, name, sf_dir, 1)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "others": others, "tenth_of_data": tenth,
                      "duckdb": duckdb_seconds(sf_dir, list(catalog.QUERIES)),
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
