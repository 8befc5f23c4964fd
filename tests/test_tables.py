import pytest
from pyspark.sql import functions as F

import tidemark as tm
from conftest import rows


def test_row_count_validation(spark):
    tables = {"some": spark.range(3), "none": spark.range(0)}
    assert rows(tm.validate_row_counts(tables)) == [("none", 0, False), ("some", 3, True)]
    assert rows(tm.validate_row_counts(tables, 4)) == [("none", 0, False), ("some", 3, False)]


def test_partitioned_write_replaces_only_what_it_brings(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(30).selectExpr("id", "concat('2026-05-0', id % 3) AS day")
    assert tm.partitioned_write(df, path, "day") == 30
    assert tm.partitioned_write(df.filter("day = '2026-05-01' AND id < 5"), path, "day") == 2
    counts = spark.read.schema(df.schema).parquet(path).groupBy("day").count()
    assert rows(counts) == [("2026-05-00", 10), ("2026-05-01", 2), ("2026-05-02", 10)]
    assert len(list((tmp_path / "t" / "day=2026-05-00").glob("*.parquet"))) == 1


def test_table_load(spark, tmp_path):
    df = spark.range(5)
    assert tm.table_load(df, "load_target", str(tmp_path / "t")) == 5
    assert tm.table_load(df.filter("id < 2"), "load_target", str(tmp_path / "t")) == 2
    assert rows(spark.table("load_target")) == [(0,), (1,)]
    spark.sql("DROP TABLE load_target")


def test_a_failed_load_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tm.table_load(spark.range(5), "load_safe", path)
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        tm.table_load(broken, "load_safe", path)
    assert spark.table("load_safe").count() == 5
    tm.table_load(spark.table("load_safe").filter("id < 3"), "load_safe", path)  # its own rows
    assert spark.table("load_safe").count() == 3
    tm.table_load(spark.range(2).withColumn("more", F.lit("x")), "load_safe", path)
    assert rows(spark.table("load_safe")) == [(0, "x"), (1, "x")]
    assert len(list((tmp_path / "t").glob("load-*"))) <= 3
    spark.sql("DROP TABLE load_safe")
    tm.table_load(spark.range(4), "load_default")
    assert spark.table("load_default").count() == 4
    spark.sql("DROP TABLE load_default")


def test_flow_runs_steps_in_order_and_stops_a_bad_table(spark, tmp_path):
    frames = {
        "sales": spark.range(9).withColumn("sale_date", F.col("id") % 2),
        "empty": spark.range(0).withColumn("return_date", F.col("id")),
        "customers": spark.range(4),
    }
    report = tm.run_flow(
        spark,
        [
            tm.TableSpec(
                "sales", str(tmp_path / "sales"), "transform", validate=True,
                partition_by="sale_date", rule=lambda df: df.filter("id > 0"),
            ),
            tm.TableSpec(
                "empty", str(tmp_path / "empty"), "transform", validate=True,
                partition_by="return_date",
            ),
            tm.TableSpec("customers", "flow_customers", "load", path=str(tmp_path / "c")),
        ],
        frames.get,
    )
    assert [tuple(r) for r in report.collect()] == [
        ("sales", "validate", 9, True),
        ("sales", "transform", 8, True),
        ("empty", "validate", 0, False),
        ("customers", "load", 4, True),
    ]
    assert spark.read.parquet(str(tmp_path / "sales")).count() == 8
    assert not (tmp_path / "empty").exists()
    assert spark.table("flow_customers").count() == 4
    spark.sql("DROP TABLE flow_customers")


def test_flow_specs_are_checked():
    with pytest.raises(ValueError, match="mode"):
        tm.TableSpec("a", "b", "copy")
    with pytest.raises(ValueError, match="partition_by"):
        tm.TableSpec("a", "b", "transform")


def test_profile(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 2.5, None)], "id int, v double, s string")
    assert rows(tm.schema_profile(df)) == [
        (0, "id", "int", 2, 2),
        (1, "v", "double", 2, 1),
        (2, "s", "string", 2, 1),
    ]


def test_preview(spark):
    df = spark.range(50).repartition(5)
    assert [r.id for r in tm.preview(df, ["id"]).collect()] == list(range(20))
    assert tm.preview(df, ["id"], 3).count() == 3


def test_interval_report(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp_ntz'2026-05-01 15:00:00',"
        " timestamp_ntz'2026-05-01 17:59:59', timestamp_ntz'2026-05-01 18:00:00')) AS ts"
    )
    report = tm.interval_report(df, "ts").selectExpr(
        "cast(interval_start AS string)", "cast(interval_end AS string)", "duration_seconds", "n_rows"
    )
    assert rows(report) == [
        ("2026-05-01 15:00:00", "2026-05-01 18:00:00", 10800, 2),
        ("2026-05-01 18:00:00", "2026-05-01 21:00:00", 10800, 1),
    ]


def test_calendar_flags_missing_hours(spark):
    hours = spark.createDataFrame([("a",), ("b",)], "time_stamp string")
    counts = spark.createDataFrame([("a", 2)], "time_stamp string, n_rows long")
    assert rows(tm.partition_calendar(hours, counts)) == [("a", 2, False), ("b", 0, True)]


def test_rows_per_hour(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp_ntz'2026-05-01 15:00:00',"
        " timestamp_ntz'2026-05-01 15:59:59', timestamp_ntz'2026-05-02 00:00:00', NULL)) AS ts"
    )
    assert rows(tm.hourly_row_counts(df, "ts")) == [
        ("2026-05-01-15", 2),
        ("2026-05-02-00", 1),
        (None, 1),
    ]


def test_other_columns_never_leave_the_table_without_an_entry(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tm.table_load(spark.range(5), "load_swap", path)
    wider = spark.range(2).withColumn("more", F.lit("x"))
    sql, seen = type(spark).sql, []

    def watched(self, text, *args, **options):
        if "RENAME TO load_swap" in text and "_new" in text and not seen:
            seen.append(text)
            raise RuntimeError("lost")
        return sql(self, text, *args, **options)

    monkeypatch.setattr(type(spark), "sql", watched)
    with pytest.raises(RuntimeError, match="lost"):
        tm.table_load(wider, "load_swap", path)
    assert spark.table("load_swap").count() == 5
    tm.table_load(wider, "load_swap", path)
    assert rows(spark.table("load_swap")) == [(0, "x"), (1, "x")]
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith("load_swap")]
    assert left == ["load_swap"]
    spark.sql("DROP TABLE load_swap")
