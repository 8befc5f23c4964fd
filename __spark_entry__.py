"""Queries over the driver's tables, one per operator, with the SQL that checks them.

How the upsert maps onto ``events``: the key is ``user_id``, the hourly partition is the
hour of ``ts``, and ``(ts, event_id)`` or ``(hour label, event_id)`` is the version.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import tidemark as tm  # noqa: E402
from tidemark.sources.drops import DROP_VERSION, drop_schema, reader_schema  # noqa: E402
from tidemark.sources.files import delete_tree, names, scratch_path  # noqa: E402

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
BATCH_START = "2024-01-30 18:00:00"  # what came before is state, the rest is the batch
RESTART = "2024-01-16 00:00:00"  # between the two runs of a stream
BASE_TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
SEED = 7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(*EVENT_COLUMNS)


def _time(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _label():
    return tm.partition_label(F.col("ts"))


def _newest(df: DataFrame) -> DataFrame:
    return tm.latest_per_key(df, ["user_id"], ["ts", "event_id"])


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).withColumn("time_stamp", _label())


def _before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).filter(F.col("ts") < _time(BATCH_START))


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).filter(F.col("ts") >= _time(BATCH_START))


# -- scans and projections ---------------------------------------------------------


def scan_project(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")


def partition_label(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", _label().alias("time_stamp"))


def label_time(spark, sf_dir):
    """The label of every order's hour, and back to a time."""
    label = tm.partition_label(F.col("o_orderdate"))
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", label.alias("time_stamp"), tm.label_time(label).alias("hour_start")
    )


def file_index(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select(
        "c_custkey", tm.file_index(F.col("c_name"), r"#(\d+)$").alias("file_index")
    )


def typed_state_scan(spark, sf_dir):
    events = _events(spark, sf_dir)
    text = events.select(*[F.col(c).cast("string").alias(c) for c in events.columns])
    return tm.cast_columns(text, events.schema)


def drop_scan(spark, sf_dir):
    """Events dropped as hourly CSV folders and scanned back with their origin."""
    base, schema = _dropped(spark, sf_dir, "drop_scan")
    return tm.read_drops(spark, base, schema).drop("_corrupt_record")


def _in_files(events):
    """Events with the hour and the number of the drop they go into, two files an hour."""
    number = F.when(F.minute("ts") < 30, 1).otherwise(2)
    return events.withColumn("time_stamp", _label()).withColumn("file_index", number)


def _dropped(spark, sf_dir, purpose):
    """All events as CSV drops; the base and the schema of the data."""
    base, events = scratch_path(spark, purpose), _events(spark, sf_dir)
    tm.write_drops(_in_files(events), base)
    return base, events.schema


def origin_file(spark, sf_dir):
    """The drop every event came from: the name of its file and the number in that."""
    base, schema = _dropped(spark, sf_dir, "origin_file")
    name = F.col("_metadata.file_name")
    return (
        spark.read.schema(reader_schema(schema))
        .options(header=True, basePath=base)
        .csv(base)
        .select("event_id", name.alias("file_name"), tm.file_index(name).alias("file_index"))
    )


# -- hours -------------------------------------------------------------------------


def partition_row_counts(spark, sf_dir):
    return tm.hourly_row_counts(_events(spark, sf_dir), "ts")


def partition_calendar(spark, sf_dir):
    """Every hour between the first and the last event."""
    hours = tm.hours_of(_events(spark, sf_dir), "ts")
    return tm.partition_calendar(hours, partition_row_counts(spark, sf_dir))


def interval_report(spark, sf_dir):
    return tm.interval_report(_events(spark, sf_dir), "ts", "3 hours")


# -- newest row per key ------------------------------------------------------------


def latest_per_key(spark, sf_dir):
    return _newest(_events(spark, sf_dir))


def latest_per_key_window(spark, sf_dir):
    return tm.latest_per_key(
        _events(spark, sf_dir), ["user_id"], ["ts", "event_id"], strategy="window"
    )


def _with_hour(spark, sf_dir):
    return _events(spark, sf_dir).withColumn("hour", tm.hour_start(F.col("ts")))


def _hour_as_label(df):
    return df.select(*EVENT_COLUMNS, tm.partition_label(F.col("hour")).alias("time_stamp"))


def latest_per_key_hour(spark, sf_dir):
    newest = tm.latest_per_key(
        _with_hour(spark, sf_dir), ["hour", "user_id"], ["ts", "event_id"]
    )
    return _hour_as_label(newest)


def upsert_fold(spark, sf_dir):
    """All hours folded in one pass: the newest row per user over the whole table."""
    newest = tm.latest_per_key(_with_hour(spark, sf_dir), ["user_id"], ["hour", "event_id"])
    return _hour_as_label(newest)


# -- merging -----------------------------------------------------------------------


def bootstrap_load(spark, sf_dir):
    """The first batch, here the whole table, becomes the state."""
    first = _events(spark, sf_dir)
    state = _event_state(spark, "bootstrap_load", first.schema)
    state.apply(first, label="first")
    return state.read()


def carry_over(spark, sf_dir):
    return tm.carry_over(_newest(_before(spark, sf_dir)), _batch(spark, sf_dir), ["user_id"])


def _null_keyed(df):
    """A seventh of the events without a user."""
    return df.withColumn("user_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")))


def carry_over_null_keys(spark, sf_dir):
    """NULL keys on both sides, treated as a key like any other."""
    existing = _newest(_null_keyed(_before(spark, sf_dir)))
    return tm.carry_over(existing, _null_keyed(_batch(spark, sf_dir)), ["user_id"], null_safe=True)


def upsert_null_keys(spark, sf_dir):
    existing = _newest(_null_keyed(_before(spark, sf_dir)))
    incoming = _newest(_null_keyed(_batch(spark, sf_dir)))
    return tm.upsert(existing, incoming, ["user_id"], null_keys="match")


def union_merge(spark, sf_dir):
    return tm.union_merge(_newest(_before(spark, sf_dir)), _newest(_batch(spark, sf_dir)))


def upsert_batch(spark, sf_dir):
    return tm.upsert(
        _newest(_before(spark, sf_dir)), _newest(_batch(spark, sf_dir)), ["user_id"]
    )


def upsert_stale_batch(spark, sf_dir):
    """Version mode: the earlier rows arrive after the later ones and lose to them."""
    return tm.upsert(
        _newest(_batch(spark, sf_dir)),
        _newest(_before(spark, sf_dir)),
        ["user_id"],
        version=["ts", "event_id"],
    )


def upsert_audit(spark, sf_dir):
    return tm.upsert_audit(
        _newest(_before(spark, sf_dir)), _batch(spark, sf_dir), ["user_id"]
    )


def _event_state(spark, purpose, schema, version=("ts", "event_id"), **options):
    return tm.StateTable(
        spark, scratch_path(spark, purpose), schema, ["user_id"], list(version), **options
    )


def _two_batches(spark, sf_dir, purpose, **options):
    before = _before(spark, sf_dir)
    state = _event_state(spark, purpose, before.schema, **options)
    state.apply(before, label="before")
    state.apply(_batch(spark, sf_dir), label="batch")
    return state


def state_upsert(spark, sf_dir):
    """The same merge as ``upsert_batch``, published as two versions of a state."""
    return _two_batches(spark, sf_dir, "state_upsert").read()


def state_audit(spark, sf_dir):
    return _two_batches(spark, sf_dir, "state_audit").audit()


def state_fold(spark, sf_dir):
    """The two batches folded into a new base, on top of which the first comes again."""
    state = _two_batches(spark, sf_dir, "state_fold")
    state.fold()
    state.apply(_before(spark, sf_dir), label="again")
    return state.read()


def state_rejects(spark, sf_dir):
    """What a state counts of drops with rows without a key, without a version, and with
    fields that do not parse."""

    def unless(name, divisor):
        return F.when(F.col("event_id") % divisor != 0, F.col(name))

    events = _events(spark, sf_dir)
    value = F.coalesce(unless("value", 13).cast("string"), F.lit("n/a"))
    damaged = _in_files(events).withColumns(
        {"ts": unless("ts", 11), "user_id": unless("user_id", 7), "value": value}
    )
    base = scratch_path(spark, "damaged_drops")
    tm.write_drops(damaged, base)
    state = _event_state(spark, "state_rejects", events.schema)
    state.apply(tm.read_drops(spark, base, events.schema), label="damaged")
    return state.audit()


def upsert_ties(spark, sf_dir):
    """Two batches, in either of which many rows of a user have the same version, the hour:
    the other columns decide, across the batches as within them."""
    rows = _labelled(spark, sf_dir)
    state = _event_state(spark, "upsert_ties", rows.schema, ["time_stamp"])
    odd = F.col("event_id") % 2 == 1
    for part in (odd, ~odd):
        state.apply(rows.filter(part))
    return state.read()


def arrival_batch(spark, sf_dir):
    """Arrival mode: the earlier rows arrive after the later ones and replace them."""
    before = _before(spark, sf_dir)
    state = _event_state(spark, "arrival_batch", before.schema, mode="arrival")
    state.apply(_batch(spark, sf_dir))
    state.apply(before)
    return state.read()


def _drop_state(spark, schema, purpose, **options):
    return _event_state(
        spark, purpose, drop_schema(schema), DROP_VERSION, tiebreak=["event_id"], **options
    )


def streaming_upsert(spark, sf_dir):
    """CSV drops streamed into a state in two runs over one checkpoint.  Before the second one
    further drops arrive and the record that the last micro-batch was done is lost, so Spark
    repeats it.  The result is the fold."""
    base, events = scratch_path(spark, "streaming_drops"), _in_files(_events(spark, sf_dir))
    schema = _events(spark, sf_dir).schema
    state = _drop_state(spark, schema, "streaming_state")
    checkpoint = scratch_path(spark, "streaming_checkpoint")
    early = F.col("ts") < _time(RESTART)
    for part in (events.filter(early), events.filter(~early)):
        tm.write_drops(part, base)
        done = [int(n) for n in names(spark, f"{checkpoint}/commits") if n.isdigit()]
        if done:
            delete_tree(spark, f"{checkpoint}/commits/{max(done)}")
        stream = tm.stream_drops(spark, base, schema, max_files=500)
        tm.upsert_stream(stream, state, checkpoint).awaitTermination()
    return state.read()


def drop_backfill(spark, sf_dir):
    """The whole path: events as CSV drops, back-fill in one pass, CSV export of the state,
    read back with declared types."""
    base, schema = _dropped(spark, sf_dir, "backfill_drops")
    state = _drop_state(spark, schema, "backfill_state")
    tm.backfill(state, base, schema=schema)
    target = scratch_path(spark, "backfill_export")
    tm.export_csv(state.read(), target)
    return tm.read_csv(spark, target, drop_schema(schema))


def _hourly(spark, sf_dir, events, purpose):
    """Drops of ``events`` merged in arrival mode, as a schedule does it: hour by hour from the
    first to the last event of the table."""
    ends = _events(spark, sf_dir).agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    base = scratch_path(spark, f"{purpose}_drops")
    tm.write_drops(_in_files(events), base)
    state = _drop_state(spark, events.schema, f"{purpose}_state", mode="arrival")
    if ends.first is None:
        return state, None
    start = ends.first.replace(minute=0, second=0, microsecond=0)
    return state, tm.backfill_hourly(state, base, start, ends.last, events.schema)


def hourly_backfill(spark, sf_dir):
    state, _ = _hourly(spark, sf_dir, _events(spark, sf_dir), "hourly_backfill")
    return state.read()


def hourly_report(spark, sf_dir):
    """Every hour of a back-fill over drops of one kind of event, with what it brought and
    where there was none."""
    signups = _events(spark, sf_dir).filter(F.col("event_type") == "signup")
    state, report = _hourly(spark, sf_dir, signups, "hourly_report")
    audit = state.audit().select(
        F.col("label").alias("time_stamp"), "incoming_rows", "latest_rows", "final_rows"
    )
    return report.join(audit, "time_stamp", "left")


# -- generated drops ---------------------------------------------------------------


def _event_hours(spark, sf_dir):
    return _labelled(spark, sf_dir).select("time_stamp").distinct()


def generate_rows(spark, sf_dir):
    """Synthetic drops for every hour in which something happened."""
    return tm.generate_rows(_event_hours(spark, sf_dir), SEED)


# -- looking at tables, moving tables ----------------------------------------------


def preview(spark, sf_dir):
    return tm.preview(_table(spark, sf_dir, "orders"), ["o_orderkey"])


def schema_profile(spark, sf_dir):
    """Events exported to CSV and profiled with guessed types."""
    target = scratch_path(spark, "schema_profile")
    tm.export_csv(_events(spark, sf_dir), target)
    return tm.schema_profile(tm.read_inferred(spark, target))


def csv_roundtrip(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer")
    return _through_csv(spark, customer, "csv_roundtrip")


def _through_csv(spark, table, purpose):
    target = scratch_path(spark, purpose)
    tm.export_csv(table, target)
    return tm.read_csv(spark, target, table.schema)


def export_in_place(spark, sf_dir):
    """A CSV folder merged with a batch and written over itself."""
    target, before = scratch_path(spark, "export_in_place"), _before(spark, sf_dir)
    tm.export_csv(_newest(before), target)
    held = tm.read_csv(spark, target, before.schema)
    tm.export_csv(tm.upsert(held, _newest(_batch(spark, sf_dir)), ["user_id"]), target)
    return tm.read_csv(spark, target, before.schema)


def csv_documents(spark, sf_dir):
    """Texts with line breaks, quotes, blanks and whatever else they hold."""
    return _through_csv(spark, _table(spark, sf_dir, "documents"), "csv_documents")


def csv_pages(spark, sf_dir):
    return _through_csv(spark, _table(spark, sf_dir, "pages"), "csv_pages")


def csv_conversations(spark, sf_dir):
    return _through_csv(spark, _table(spark, sf_dir, "conversations"), "csv_conversations")


def csv_single_file(spark, sf_dir):
    """A report of one row per hour as one CSV file."""
    report = partition_row_counts(spark, sf_dir)
    target = scratch_path(spark, "csv_single_file")
    tm.export_csv(report, target, single_file=True)
    return tm.read_csv(spark, target, report.schema)


def validate_row_counts(spark, sf_dir):
    return tm.validate_row_counts({name: _table(spark, sf_dir, name) for name in BASE_TABLES})


def _with_year(df, column, year):
    return df.withColumn(year, F.year(F.col(column)))


def partitioned_write(spark, sf_dir):
    target = scratch_path(spark, "partitioned_write")
    orders = _with_year(_table(spark, sf_dir, "orders"), "o_orderdate", "order_year")
    tm.partitioned_write(orders, target, "order_year")
    return (
        spark.read.schema(orders.schema)
        .parquet(target)
        .groupBy("order_year")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("o_orderkey").alias("min_key"),
            F.max("o_orderkey").alias("max_key"),
        )
    )


def partitioned_rewrite(spark, sf_dir):
    """A second write brings one year, changed: its folder is replaced, the others stay."""
    target = scratch_path(spark, "partitioned_rewrite")
    orders = _with_year(_table(spark, sf_dir, "orders"), "o_orderdate", "order_year")
    tm.partitioned_write(orders, target, "order_year")
    again = orders.filter((F.col("order_year") == 1995) & (F.col("o_totalprice") >= 100000))
    tm.partitioned_write(again, target, "order_year")
    return spark.read.schema(orders.schema).parquet(target)


def _unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


def table_load(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer")
    name, path = _unique("customer_profile"), scratch_path(spark, "customer_profile")
    tm.table_load(customer, name, path)
    loaded = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return loaded


def _loaded_twice(spark, first, second, purpose):
    name, path = _unique(purpose), scratch_path(spark, purpose)
    tm.table_load(first, name, path)
    tm.table_load(second, name, path)
    loaded = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return loaded


def table_reload(spark, sf_dir):
    """A second load under a table that exists points it at the new rows."""
    customer = _table(spark, sf_dir, "customer")
    return _loaded_twice(spark, customer, customer.filter("c_nationkey < 10"), "table_reload")


def table_reshape(spark, sf_dir):
    """A second load with another column takes the table's name."""
    customer = _table(spark, sf_dir, "customer")
    wider = customer.withColumn("key_text", F.col("c_custkey").cast("string"))
    return _loaded_twice(spark, customer, wider, "table_reshape")


def table_flow(spark, sf_dir):
    """Five tables, each with the steps its spec asks for."""

    def read(name):
        return _table(spark, sf_dir, name)

    def target(name):
        return scratch_path(spark, name)

    customers, parts = _unique("customer_profile"), _unique("part_report")
    report = tm.run_flow(
        spark,
        [
            tm.TableSpec(
                "orders",
                target("orders"),
                "transform",
                validate=True,
                partition_by="order_year",
                rule=lambda df: _with_year(df, "o_orderdate", "order_year"),
            ),
            tm.TableSpec(
                "lineitem",
                target("lineitem"),
                "transform",
                validate=True,
                partition_by="ship_year",
                rule=lambda df: _with_year(df, "l_shipdate", "ship_year"),
            ),
            tm.TableSpec("customer", customers, "load", validate=True, path=target("customer")),
            tm.TableSpec(
                "events",
                target("events"),
                "transform",
                partition_by="snapshot_date",
                rule=lambda df: df.withColumn("snapshot_date", F.to_date("ts")),
            ),
            tm.TableSpec("part", parts, "load", path=target("part")),
        ],
        read,
    )
    for name in (customers, parts):
        spark.sql(f"DROP TABLE {name}")
    return report


# -- contract ----------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the newest row per user over all hours."""
    return upsert_fold(spark, "/root/testdata/sf0.001")


def _llm():
    """Queries and SQL of the ``llm`` subpackage, or None where it is not installed."""
    try:
        import corpus_pipeline  # noqa: F401  counts as part of the subpackage
        from tidemark.llm import queries as llm
    except ModuleNotFoundError as error:
        if error.name not in ("corpus_pipeline", "tidemark.llm", "tidemark.llm.queries"):
            raise
        return None
    return llm


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return library_queries() | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    llm = _llm()
    return library_sql() | (llm.oracle_sql() if llm else {})


def library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_project": scan_project,
        "partition_label": partition_label,
        "label_time": label_time,
        "file_index": file_index,
        "origin_file": origin_file,
        "typed_state_scan": typed_state_scan,
        "drop_scan": drop_scan,
        "partition_row_counts": partition_row_counts,
        "partition_calendar": partition_calendar,
        "interval_report": interval_report,
        "latest_per_key": latest_per_key,
        "latest_per_key_window": latest_per_key_window,
        "latest_per_key_hour": latest_per_key_hour,
        "upsert_fold": upsert_fold,
        "bootstrap_load": bootstrap_load,
        "carry_over": carry_over,
        "carry_over_null_keys": carry_over_null_keys,
        "upsert_null_keys": upsert_null_keys,
        "union_merge": union_merge,
        "upsert_batch": upsert_batch,
        "upsert_stale_batch": upsert_stale_batch,
        "upsert_audit": upsert_audit,
        "state_upsert": state_upsert,
        "state_audit": state_audit,
        "state_fold": state_fold,
        "state_rejects": state_rejects,
        "upsert_ties": upsert_ties,
        "arrival_batch": arrival_batch,
        "hourly_backfill": hourly_backfill,
        "hourly_report": hourly_report,
        "streaming_upsert": streaming_upsert,
        "generate_rows": generate_rows,
        "drop_backfill": drop_backfill,
        "preview": preview,
        "schema_profile": schema_profile,
        "csv_roundtrip": csv_roundtrip,
        "export_in_place": export_in_place,
        "csv_documents": csv_documents,
        "csv_pages": csv_pages,
        "csv_conversations": csv_conversations,
        "csv_single_file": csv_single_file,
        "validate_row_counts": validate_row_counts,
        "partitioned_write": partitioned_write,
        "partitioned_rewrite": partitioned_rewrite,
        "table_load": table_load,
        "table_reload": table_reload,
        "table_reshape": table_reshape,
        "table_flow": table_flow,
    }


_COLS = ", ".join(EVENT_COLUMNS)
_LABEL = "strftime(ts, '%Y-%m-%d-%H')"
_NEWEST = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
_IN_BATCH = f"ts >= TIMESTAMP '{BATCH_START}'"
_E_AND_I = f"""
    WITH e AS (SELECT {_COLS} FROM events WHERE ts < TIMESTAMP '{BATCH_START}' {_NEWEST}),
         i AS (SELECT {_COLS} FROM events WHERE {_IN_BATCH} {_NEWEST})
"""
_NULL_KEYED = _E_AND_I.replace(
    "FROM events", "FROM (SELECT * REPLACE (CASE WHEN event_id % 7 != 0 THEN user_id END AS user_id)"
    " FROM events)"
)
_NOT_ARRIVED = "NOT EXISTS (SELECT 1 FROM i WHERE i.user_id IS NOT DISTINCT FROM e.user_id)"
_FOLD = f"""
    SELECT {_COLS}, {_LABEL} AS time_stamp FROM events
    QUALIFY row_number() OVER (
        PARTITION BY user_id ORDER BY {_LABEL} DESC, event_id DESC) = 1
"""
_HALF = "CASE WHEN minute(ts) < 30 THEN 1 ELSE 2 END"
_COUNTS = f"""
    SELECT {_LABEL} AS time_stamp, count(*) AS n_rows FROM events GROUP BY 1
"""


def _hex(digest: str, start: int, length: int) -> str:
    return f"(('0x' || substr({digest}, {start}, {length}))::BIGINT)"


def _generated() -> str:
    return f"""
    WITH hours AS (SELECT DISTINCT {_LABEL} AS time_stamp FROM events),
    file_list AS (
        SELECT time_stamp, unnest(generate_series(
            1, {_hex(f"md5('{SEED}|' || time_stamp)", 1, 6)} % 5 + 1))::INTEGER AS file_index
        FROM hours),
    row_list AS (
        SELECT time_stamp, file_index, unnest(generate_series(
            1, {_hex(f"md5('{SEED}|' || time_stamp || '|' || file_index)", 1, 6)} % 16 + 5
            ))::INTEGER AS id
        FROM file_list),
    digests AS (
        SELECT *, md5('{SEED}|' || time_stamp || '|' || file_index || '|' || id) AS d
        FROM row_list),
    generated AS (
        SELECT id,
               ['Alice', 'Bob', 'Charlie', 'Diana', 'Eve', 'Frank', 'Grace', 'Hank', 'Ivy',
                'Jack'][{_hex("d", 1, 6)} % 10 + 1] AS name,
               ({_hex("d", 7, 6)} % 39 + 22)::INTEGER AS age,
               ['Engineering', 'Marketing', 'Sales', 'HR', 'Finance', 'Operations'][{_hex("d", 13, 6)} % 6 + 1] AS department,
               ({_hex("d", 19, 8)} % 9000001 + 3000000)::DOUBLE / 100.0::DOUBLE AS salary,
               ({_hex("d", 27, 6)} % 401 + 200)::DOUBLE / 10.0::DOUBLE AS working_hours,
               time_stamp, file_index
        FROM digests)
    """


def _dropped_fold(label: str) -> str:
    return f"""
        SELECT {_COLS}, {label} AS time_stamp, {_HALF} AS file_index FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id
            ORDER BY {label} DESC, {_HALF} DESC, event_id DESC) = 1"""


def _count_of(table: str, where: str = "true") -> str:
    return f"(SELECT count(*) FROM {table} WHERE {where})"


def library_sql() -> dict[str, str]:
    flow_steps = [
        ("orders", "validate", _count_of("orders")),
        ("orders", "transform", _count_of("orders")),
        ("lineitem", "validate", _count_of("lineitem")),
        ("lineitem", "transform", _count_of("lineitem")),
        ("customer", "validate", _count_of("customer")),
        ("customer", "load", _count_of("customer")),
        ("events", "transform", _count_of("events")),
        ("part", "load", _count_of("part")),
    ]
    event_types = [
        "CASE WHEN max(event_id) > 2147483647 THEN 'bigint' ELSE 'int' END",
        "'timestamp'",
        "CASE WHEN max(user_id) > 2147483647 THEN 'bigint' ELSE 'int' END",
        "'string'",
        "'double'",
        "'string'",
    ]
    return {
        "scan_project": "SELECT event_id, user_id, event_type FROM events",
        "partition_label": f"SELECT event_id, {_LABEL} AS time_stamp FROM events",
        "label_time": """
            SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d-%H') AS time_stamp,
                   date_trunc('hour', o_orderdate) AS hour_start
            FROM orders""",
        "file_index": r"""
            SELECT c_custkey,
                   TRY_CAST(regexp_extract(c_name, '#(\d+)$', 1) AS INTEGER) AS file_index
            FROM customer""",
        "origin_file": f"""
            SELECT event_id, 'data_' || {_HALF} || '.csv' AS file_name, {_HALF} AS file_index
            FROM events""",
        "typed_state_scan": """
            SELECT CAST(CAST(event_id AS VARCHAR) AS BIGINT) AS event_id,
                   CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts,
                   CAST(CAST(user_id AS VARCHAR) AS BIGINT) AS user_id,
                   event_type,
                   CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value,
                   props
            FROM events""",
        "drop_scan": f"""
            SELECT {_COLS}, {_LABEL} AS time_stamp,
                   {_HALF} AS file_index
            FROM events""",
        "partition_row_counts": _COUNTS,
        "partition_calendar": f"""
            WITH hours AS (
                SELECT strftime(h, '%Y-%m-%d-%H') AS time_stamp
                FROM (SELECT unnest(generate_series(
                    date_trunc('hour', min(ts)), date_trunc('hour', max(ts)),
                    INTERVAL 1 HOUR)) AS h FROM events)),
            counts AS ({_COUNTS})
            SELECT time_stamp, coalesce(n_rows, 0) AS n_rows, n_rows IS NULL AS missing
            FROM hours LEFT JOIN counts USING (time_stamp)""",
        "interval_report": """
            SELECT time_bucket(INTERVAL 3 HOUR, ts) AS interval_start,
                   time_bucket(INTERVAL 3 HOUR, ts) + INTERVAL 3 HOUR AS interval_end,
                   CAST(10800 AS BIGINT) AS duration_seconds,
                   count(*) AS n_rows
            FROM events GROUP BY 1""",
        "latest_per_key": f"SELECT {_COLS} FROM events {_NEWEST}",
        "latest_per_key_window": f"SELECT {_COLS} FROM events {_NEWEST}",
        "latest_per_key_hour": f"""
            SELECT {_COLS}, {_LABEL} AS time_stamp FROM events
            QUALIFY row_number() OVER (
                PARTITION BY {_LABEL}, user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "upsert_fold": _FOLD,
        "bootstrap_load": f"SELECT {_COLS} FROM events {_NEWEST}",
        "carry_over": f"""
            {_E_AND_I} SELECT * FROM e
            WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.user_id = e.user_id)""",
        "carry_over_null_keys": f"{_NULL_KEYED} SELECT * FROM e WHERE {_NOT_ARRIVED}",
        "upsert_null_keys": f"""
            {_NULL_KEYED} SELECT * FROM e WHERE {_NOT_ARRIVED} UNION ALL SELECT * FROM i""",
        "union_merge": f"{_E_AND_I} SELECT * FROM e UNION ALL SELECT * FROM i",
        "upsert_batch": f"""
            {_E_AND_I} SELECT * FROM e WHERE user_id NOT IN (SELECT user_id FROM i)
            UNION ALL SELECT * FROM i""",
        "upsert_stale_batch": f"SELECT {_COLS} FROM events {_NEWEST}",
        "upsert_audit": f"""
            {_E_AND_I}
            SELECT (SELECT count(*) FROM events WHERE {_IN_BATCH}) AS incoming_rows,
                   (SELECT count(*) FROM i) AS latest_rows,
                   (SELECT count(*) FROM e) AS existing_rows,
                   (SELECT count(*) FROM e WHERE user_id NOT IN (SELECT user_id FROM i))
                       AS remaining_rows,
                   (SELECT count(*) FROM (SELECT user_id FROM e UNION SELECT user_id FROM i))
                       AS final_rows""",
        "state_upsert": f"SELECT {_COLS} FROM events {_NEWEST}",
        "state_audit": f"""
            {_E_AND_I}
            SELECT CAST(0 AS BIGINT) AS version, 'before' AS label,
                   (SELECT count(*) FROM events WHERE ts < TIMESTAMP '{BATCH_START}')
                       AS incoming_rows,
                   CAST(0 AS BIGINT) AS rejected_rows,
                   CAST(0 AS BIGINT) AS unversioned_rows,
                   CAST(0 AS BIGINT) AS malformed_rows,
                   (SELECT count(*) FROM e) AS latest_rows,
                   CAST(0 AS BIGINT) AS existing_rows,
                   CAST(0 AS BIGINT) AS remaining_rows,
                   (SELECT count(*) FROM e) AS final_rows
            UNION ALL
            SELECT 1, 'batch', (SELECT count(*) FROM events WHERE {_IN_BATCH}), 0, 0, 0,
                   (SELECT count(*) FROM i), (SELECT count(*) FROM e),
                   (SELECT count(*) FROM e WHERE user_id NOT IN (SELECT user_id FROM i)),
                   (SELECT count(*) FROM (SELECT user_id FROM e UNION SELECT user_id FROM i))""",
        "state_fold": f"SELECT {_COLS} FROM events {_NEWEST}",
        "state_rejects": """
            SELECT CAST(0 AS BIGINT) AS version, 'damaged' AS label, count(*) AS incoming_rows,
                   count(*) FILTER (event_id % 7 = 0) AS rejected_rows,
                   count(*) FILTER (event_id % 11 = 0) AS unversioned_rows,
                   count(*) FILTER (event_id % 13 = 0) AS malformed_rows,
                   count(DISTINCT user_id) FILTER (event_id % 7 != 0) AS latest_rows,
                   CAST(0 AS BIGINT) AS existing_rows, CAST(0 AS BIGINT) AS remaining_rows,
                   count(DISTINCT user_id) FILTER (event_id % 7 != 0) AS final_rows
            FROM events""",
        "upsert_ties": _FOLD,
        "arrival_batch": f"""
            {_E_AND_I} SELECT * FROM i WHERE user_id NOT IN (SELECT user_id FROM e)
            UNION ALL SELECT * FROM e""",
        "hourly_backfill": _dropped_fold(_LABEL),
        "hourly_report": f"""
            WITH hours AS (
                SELECT strftime(h, '%Y-%m-%d-%H') AS time_stamp
                FROM (SELECT unnest(generate_series(
                    date_trunc('hour', min(ts)), date_trunc('hour', max(ts)),
                    INTERVAL 1 HOUR)) AS h FROM events)),
            signups AS (SELECT user_id, {_LABEL} AS time_stamp FROM events WHERE event_type = 'signup'),
            per_hour AS (
                SELECT time_stamp, count(*) AS incoming_rows, count(DISTINCT user_id) AS latest_rows
                FROM signups GROUP BY 1),
            fresh AS (
                SELECT time_stamp, count(*) AS n
                FROM (SELECT user_id, min(time_stamp) AS time_stamp FROM signups GROUP BY 1) GROUP BY 1)
            SELECT time_stamp, incoming_rows IS NULL AS missing, incoming_rows, latest_rows,
                   CASE WHEN incoming_rows IS NOT NULL THEN CAST(
                       sum(coalesce(n, 0)) OVER (ORDER BY time_stamp) AS BIGINT) END AS final_rows
            FROM hours LEFT JOIN per_hour USING (time_stamp) LEFT JOIN fresh USING (time_stamp)""",
        "streaming_upsert": _dropped_fold(_LABEL),
        "generate_rows": f"{_generated()} SELECT * FROM generated",
        "drop_backfill": _dropped_fold(_LABEL),
        "preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20",
        "schema_profile": " UNION ALL ".join(
            f"SELECT {i} AS position, '{name}' AS column_name, {kind} AS type_name,"
            f" count(*) AS n_rows, count({name}) AS n_values FROM events"
            for i, (name, kind) in enumerate(zip(EVENT_COLUMNS, event_types))
        ),
        "csv_roundtrip": "SELECT * FROM customer",
        "export_in_place": f"""
            {_E_AND_I} SELECT * FROM e WHERE user_id NOT IN (SELECT user_id FROM i)
            UNION ALL SELECT * FROM i""",
        "csv_documents": "SELECT * FROM documents",
        "csv_pages": "SELECT * FROM pages",
        "csv_conversations": "SELECT * FROM conversations",
        "csv_single_file": _COUNTS,
        "validate_row_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) >= 1 AS passed FROM {t}"
            for t in BASE_TABLES
        ),
        "partitioned_write": """
            SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_rows,
                   min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
            FROM orders GROUP BY 1""",
        "partitioned_rewrite": """
            SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders
            WHERE year(o_orderdate) != 1995 OR o_totalprice >= 100000""",
        "table_load": "SELECT * FROM customer",
        "table_reload": "SELECT * FROM customer WHERE c_nationkey < 10",
        "table_reshape": "SELECT *, CAST(c_custkey AS VARCHAR) AS key_text FROM customer",
        "table_flow": " UNION ALL ".join(
            f"SELECT '{source}' AS source, '{step}' AS step, {n} AS n_rows, true AS passed"
            for source, step, n in flow_steps
        ),
    }
