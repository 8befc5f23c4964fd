"""Time the alternatives the library offers against each other.

    python tools/compare.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time
from datetime import datetime

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import tidemark as tm  # noqa: E402
from bench import session  # noqa: E402
from tidemark.sources.drops import DROP_VERSION, drop_schema  # noqa: E402
from tidemark.sources.files import scratch_path  # noqa: E402


def timed(label, action, repeats=1):
    best = min(_seconds(action) for _ in range(repeats))
    print(f"{label:48s} {best:7.2f} s", flush=True)


def _seconds(action):
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main(sf_dir):
    spark = session("8")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    run(tm.latest_per_key(events, ["user_id"], ["ts", "event_id"]))

    for strategy in ("aggregate", "window"):
        timed(
            f"newest per user, {strategy}",
            lambda: run(
                tm.latest_per_key(events, ["user_id"], ["ts", "event_id"], strategy=strategy)
            ),
            repeats=3,
        )

    few = scratch_path(spark, "compare_batch")
    keys = F.pmod(F.xxhash64("event_id"), F.lit(10_000)) == 0
    events.filter(keys).withColumn("ts", F.expr("ts + INTERVAL 1 DAY")).write.parquet(few)
    state = tm.StateTable(
        spark, scratch_path(spark, "compare_state"), events.schema, ["event_id"], ["ts"]
    )
    timed("state of all events", lambda: state.apply(events))
    timed("read it", lambda: run(state.read()))
    timed(
        "one key in 10,000 into it", lambda: state.apply(spark.read.parquet(few)), repeats=3
    )
    timed("read it with three deltas", lambda: run(state.read()))
    timed("fold them", state.fold)

    base, day = scratch_path(spark, "compare_drops"), datetime(2024, 1, 1)
    end = day.replace(hour=23)
    tm.write_drops(tm.generate_rows(tm.hour_calendar(spark, day, end), seed=1), base)

    def fresh(purpose):
        return tm.StateTable(
            spark,
            scratch_path(spark, purpose),
            drop_schema(tm.EMPLOYEE_SCHEMA),
            keys=["id"],
            version=list(DROP_VERSION),
        )

    timed("24 hours of drops, one pass", lambda: tm.backfill(fresh("once"), base, day, end))
    timed(
        "24 hours of drops, hour by hour",
        lambda: tm.backfill_hourly(fresh("hourly"), base, day, end),
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
