"""Time the headline work on the tables in $BENCH_SF_DIR and print one JSON line.

Two kinds of timings, in seconds, each with a cold run and the median of warm runs:

* jobs on landed tables: full model build, risk summary, what is left of the quality suite after a
  build, stream replay, a log read as it came and folded (``$BENCH_RUNS`` warm runs, default 5);
* catalog queries straight from the input tables (2 warm runs).

Query results go to the noop sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ledgerwake import Params, catalog  # noqa: E402
from ledgerwake.plans import pipeline, reports  # noqa: E402
from ledgerwake.session import build_session  # noqa: E402
from ledgerwake.sources import landing, market  # noqa: E402
from ledgerwake.sources.scratch import scratch_dir, staged  # noqa: E402
from ledgerwake.streaming import feeds, sinks  # noqa: E402

QUERIES = [
    "stg_trades", "int_daily_prices", "int_cash_balances", "fact_positions_daily",
    "fact_portfolio_value_daily", "fact_pnl_daily", "rolling_volatility", "drawdown",
    "value_history", "holdings", "risk_summary", "qc_unique", "price_upsert",
    "keyed_insert_rejected", "stream_dedup", "stream_replay_prices", "stream_keyed_insert",
    "qc_summary",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def jobs(spark, sf_dir: str) -> dict[str, Callable[[], None]]:
    """The planned measurements. Their inputs are landed once, outside of the clock."""
    raw = {name: staged(getattr(market, name)(spark, sf_dir), name)
           for name in ("raw_trades", "raw_prices", "raw_cash_events")}
    models = pipeline.run(spark, raw, scratch_dir(spark, "models"))
    feed = feeds.FEEDS["trades"]
    recorded = scratch_dir(spark, "messages")
    catalog.trade_messages(spark, sf_dir).write.parquet(recorded)

    def replay() -> None:
        sinks.start_feed(
            spark, feed, {"fmt": "parquet", "path": recorded}, scratch_dir(spark, "landed"),
            scratch_dir(spark, "checkpoint"), sinks.ONCE).awaitTermination()

    # Two logs of the same messages, each delivered twice: as it came, and folded but for the rest.
    logs = {name: f"{scratch_dir(spark, name)}/{feed.table.name}" for name in ("log", "folded")}
    messages = spark.read.parquet(recorded)
    last = F.pmod(F.xxhash64("offset"), F.lit(10)) == 0
    for name, out in logs.items():
        for part in (messages.unionByName(messages).filter(~last), messages.filter(last)):
            path = scratch_dir(spark, "messages")
            part.write.parquet(path)
            sinks.start_feed(spark, feed, {"fmt": "parquet", "path": path}, out,
                             scratch_dir(spark, "checkpoint"), sinks.ONCE).awaitTermination()
            if name == "folded" and not landing.manifest(spark, out).version:
                landing.compact(spark, out, feed.table)

    return {
        "read_log": lambda: consume(landing.resolved(spark, logs["log"], feed.table)),
        "read_folded_log": lambda: consume(landing.resolved(spark, logs["folded"], feed.table)),
        "model_build": lambda: pipeline.run(spark, raw, scratch_dir(spark, "models")),
        "risk_report": lambda: consume(reports.risk_summary_from_values(
            models["fact_portfolio_value_daily"], Params())),
        "quality_suite": lambda: consume(pipeline.check(models)),
        "stream_replay": replay,
    }


def timed(work: Callable[[], None], runs: int) -> tuple[float, float]:
    """Cold time and median warm time."""
    times = []
    for _ in range(runs + 1):
        began = time.perf_counter()
        work()
        times.append(time.perf_counter() - began)
    return round(times[0], 3), round(statistics.median(times[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session("bench", f"local[{cpus}]", cpus, spark__ui__enabled="false",
                          spark__driver__memory="12g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}

    def measure(name: str, work: Callable[[], None], runs: int) -> None:
        cold[name], warm[name] = timed(work, runs)
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)

    for name, work in jobs(spark, sf_dir).items():
        measure(name, work, runs)
    for name in QUERIES:
        measure(name, lambda: consume(catalog.QUERIES[name](spark, sf_dir)), min(runs, 2))
    trades = market.table(spark, sf_dir, "lineitem").count()
    print(json.dumps({
        "metric": "warm_median_total", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "trades": trades,
        "stream_rows_per_sec": round(trades / warm["stream_replay"]),
        "build_trades_per_sec": round(trades / warm["model_build"]),
        "cpus": cpus, "driver_memory": "12g", "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
