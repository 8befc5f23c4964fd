import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tidemark as tm
from conftest import person, rows
from tidemark.sources.files import clear_scratch, create_text, listing, scratch_path


def test_rows_know_their_hour_and_file(spark, drop):
    drop("2026-05-01-00", 1, [person(1)])
    base = drop("2026-05-01-01", 12, [person(2)])
    df = tm.read_drops(spark, base)
    assert rows(df, "id", "time_stamp", "file_index") == [
        (1, "2026-05-01-00", 1),
        (2, "2026-05-01-01", 12),
    ]
    assert df.schema["time_stamp"].dataType == T.StringType()


def test_only_wanted_hours_are_read_and_missing_ones_are_skipped(spark, drop):
    for hour in range(3):
        base = drop(f"2026-05-01-0{hour}", 1, [person(hour)])
    wanted = ["2026-05-01-01", "2026-05-01-09"]
    assert rows(tm.read_drops(spark, base, hours=wanted), "id") == [(1,)]
    assert tm.available_hours(spark, base, wanted) == ["2026-05-01-01"]
    assert len(tm.available_hours(spark, base)) == 3
    many = tm.hour_labels(datetime(2026, 5, 1), datetime(2026, 5, 9))
    assert len(tm.available_hours(spark, base, many)) == 3


def test_no_hours_at_all_is_an_empty_table(spark, drop):
    df = tm.read_drops(spark, drop.base, hours=["2026-05-01-00"])
    assert df.count() == 0
    assert df.columns[:6] == tm.EMPLOYEE_SCHEMA.names


def test_empty_hour_folder(spark, drop, tmp_path):
    base = drop("2026-05-01-00", 1, [person(1)])
    (tmp_path / "drops" / "time_stamp=2026-05-01-01").mkdir()
    hours = ["2026-05-01-00", "2026-05-01-01"]
    assert tm.available_hours(spark, base, hours) == hours
    assert tm.read_drops(spark, base, hours=hours).count() == 1


def test_file_name_that_does_not_match_has_no_index(spark, drop):
    base = drop("2026-05-01-00", 1, [person(1)], name="part-0.csv")
    assert rows(tm.read_drops(spark, base), "id", "file_index") == [(1, None)]


def test_header_in_another_order_is_an_error(spark, drop):
    drop("2026-05-01-00", 1, [person(1)])
    header = ["name", "id", "age", "department", "salary", "working_hours"]
    base = drop("2026-05-01-00", 2, [["Bob", 2, 30, "HR", 1.0, 2.0]], header=header)
    with pytest.raises(Exception, match="(?s)CSV header does not conform"):
        tm.read_drops(spark, base).collect()
    with pytest.raises(Exception, match="(?s)CSV header does not conform"):
        tm.read_drops(spark, base).select("id").collect()


def test_bad_field_is_null_and_its_line_is_kept(spark, drop):
    base = drop("2026-05-01-00", 1, [person(1, age="abc"), person(2)])
    df = tm.read_drops(spark, base)
    assert rows(df, "id", "age") == [(1, None), (2, 30)]
    bad = [r for r in df.collect() if r["_corrupt_record"] is not None]
    assert [(r.id, r["_corrupt_record"]) for r in bad] == [(1, "1,Ann,abc,Sales,1000.5,40.0")]


def test_export_and_typed_reads(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([tuple(person(i)) for i in range(9)], tm.EMPLOYEE_SCHEMA)
    tm.export_csv(df, path)
    assert rows(tm.read_all_strings(spark, path, tm.EMPLOYEE_SCHEMA)) == rows(df)
    inferred = tm.read_inferred(spark, path)
    assert inferred.schema.simpleString() == tm.EMPLOYEE_SCHEMA.simpleString()
    assert rows(inferred) == rows(df)


def test_single_file_export(spark, tmp_path):
    path = str(tmp_path / "out")
    tm.export_csv(spark.range(100).repartition(4), path, single_file=True)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 1
    assert spark.read.option("header", True).csv(path).count() == 100


def test_export_over_its_own_input_keeps_all_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    tm.export_csv(spark.range(100), path)
    again = spark.read.schema("id long").option("header", True).csv(path)
    tm.export_csv(again.unionByName(spark.range(100, 150)), path)
    assert spark.read.schema("id long").option("header", True).csv(path).count() == 150
    assert [e.name for e in listing(spark, str(tmp_path))] == ["out"]


def test_export_to_a_relative_path(spark, tmp_path):
    before = spark._jvm.org.apache.hadoop.fs.Path("out").getFileSystem(
        spark._jsc.hadoopConfiguration()
    )
    home = before.getWorkingDirectory()
    before.setWorkingDirectory(spark._jvm.org.apache.hadoop.fs.Path(str(tmp_path)))
    try:
        for n in (5, 7):
            tm.export_csv(spark.range(n), "out")
            assert spark.read.schema("id long").option("header", True).csv("out").count() == n
        assert (tmp_path / "out").is_dir()
    finally:
        before.setWorkingDirectory(home)


def test_failed_export_leaves_the_previous_one(spark, tmp_path):
    path = str(tmp_path / "out")
    tm.export_csv(spark.range(10), path)
    with pytest.raises(Exception, match="boom"):
        tm.export_csv(spark.range(10).select(F.raise_error(F.lit("boom")).cast("int").alias("id")), path)
    assert spark.read.schema("id long").option("header", True).csv(path).count() == 10


def test_export_keeps_microseconds(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00.123456' AS a,"
        " timestamp'2024-01-01 00:00:00.654321' AS b"
    )
    tm.export_csv(df, path)
    assert rows(spark.read.schema(df.schema).option("header", True).csv(path)) == rows(df)


VALUES = ["a\nb", " pad ", "", None, 'q"uo"te', '"', "back\\slash", '\\"', "a,b", "\r\n x\r", "\t", "#", "é漢\u2028"]


def test_export_keeps_every_value(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(itertools.product(VALUES, VALUES))],
        "id int, a string, b string",
    ).select("a", "id", "b")
    tm.export_csv(df, path)
    assert rows(tm.read_csv(spark, path, df.schema)) == rows(df)
    assert rows(tm.read_all_strings(spark, path, df.schema)) == rows(df)


def test_drops_keep_line_breaks_and_empty_strings(spark, tmp_path):
    base = str(tmp_path / "d")
    df = spark.createDataFrame(
        [(i, v, "2026-05-01-00", 1) for i, v in enumerate(VALUES)],
        "id int, v string, time_stamp string, file_index int",
    )
    tm.write_drops(df, base)
    got = tm.read_drops(spark, base, T.StructType(df.schema.fields[:2]))
    assert rows(got.drop("_corrupt_record")) == rows(df)
    assert all(r["_corrupt_record"] is None for r in got.collect())


def test_cast_gives_null_for_what_does_not_fit(spark):
    df = spark.createDataFrame([("x", "2.5")], "b string, a string")
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.IntegerType())])
    out = tm.cast_columns(df, schema)
    assert out.schema == schema
    assert rows(out) == [(2.5, None)]


def test_text_is_created_once(spark, tmp_path):
    path = str(tmp_path / "x" / "1.json")
    assert create_text(spark, path, "{}")
    assert not create_text(spark, path, "[]")
    assert (tmp_path / "x" / "1.json").read_text() == "{}"


def test_scratch_lies_in_a_shared_folder_and_can_be_cleared(spark):
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first != second
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert first.startswith(shared or spark.conf.get("spark.sql.warehouse.dir"))
    spark.range(1).write.parquet(first)
    clear_scratch(spark)
    assert listing(spark, first) == []


def drops_of(spark, n, hours=3, files_per_hour=2):
    return spark.range(n).selectExpr(
        "cast(id AS int) AS id",
        "concat('v', id) AS v",
        f"concat('2026-05-01-0', id % {hours}) AS time_stamp",
        f"cast(id % {files_per_hour} + 1 AS int) AS file_index",
    )


def files_in(base):
    return sorted(str(p.relative_to(base)) for p in base.rglob("data*") if p.is_file())


DATA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])


def test_drops_are_named_by_hour_and_number(spark, tmp_path):
    base = tmp_path / "d"
    df = drops_of(spark, 60).repartition(7)
    tm.write_drops(df, str(base))
    assert files_in(base) == [
        f"time_stamp=2026-05-01-0{h}/data_{n}.csv" for h in range(3) for n in (1, 2)
    ]
    assert [p.name for p in tmp_path.iterdir()] == ["d"]  # nothing is left beside it
    got = tm.read_drops(spark, str(base), DATA)
    assert rows(got.drop("_corrupt_record")) == rows(df)


def test_drops_are_added_and_never_overwritten(spark, tmp_path):
    base = tmp_path / "d"
    tm.write_drops(drops_of(spark, 20, hours=2), str(base))
    more = drops_of(spark, 30, hours=3).filter("time_stamp LIKE '%2'")
    tm.write_drops(more, str(base))
    assert tm.read_drops(spark, str(base), DATA).count() == 30
    before = files_in(base)
    with pytest.raises(FileExistsError, match="2026-05-01-02/data_1"):
        tm.write_drops(drops_of(spark, 40, hours=4), str(base))
    assert files_in(base) == before and [p.name for p in tmp_path.iterdir()] == ["d"]
    third = more.withColumn("file_index", F.lit(3))  # another number in an hour that is there
    tm.write_drops(third, str(base))
    assert len(files_in(base)) == len(before) + 1


def test_a_failed_write_leaves_the_base_alone(spark, tmp_path):
    base = tmp_path / "d"
    bad = drops_of(spark, 9).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        tm.write_drops(bad, str(base))
    assert list(tmp_path.iterdir()) == []


def test_rows_without_a_number_and_no_rows(spark, tmp_path):
    base = tmp_path / "d"
    df = drops_of(spark, 4, hours=1).withColumn("file_index", F.lit(None).cast("int"))
    tm.write_drops(df, str(base))
    assert files_in(base) == ["time_stamp=2026-05-01-00/data_.csv"]
    assert rows(tm.read_drops(spark, str(base), DATA), "id", "file_index") == [(i, None) for i in range(4)]
    tm.write_drops(df.limit(0), str(tmp_path / "none"))
    assert tm.read_drops(spark, str(tmp_path / "none"), DATA).count() == 0


def test_one_large_drop_is_read_by_many_tasks(spark, tmp_path):
    base = str(tmp_path / "d")
    df = drops_of(spark, 60_000, hours=1, files_per_hour=1)
    tm.write_drops(df, base)
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "100k")
    try:
        split = tm.read_drops(spark, base, DATA)
        assert split.rdd.getNumPartitions() >= 5
        assert split.agg(F.count("*"), F.sum("id"), F.count_distinct("v")).first() == (
            60_000, sum(range(60_000)), 60_000,
        )
        bad = [r for r in split.select("*").collect() if r["_corrupt_record"] or r.file_index != 1]
        assert bad == []
        assert tm.read_drops(spark, base, DATA, multiline=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set(size, before)


def test_line_breaks_are_noted_when_drops_are_written(spark, tmp_path):
    plain, broken = str(tmp_path / "p"), str(tmp_path / "b")
    df = drops_of(spark, 10, hours=1)
    tm.write_drops(df, plain)
    tm.write_drops(df, broken)
    late = df.withColumn("file_index", F.lit(9)).withColumn("v", F.lit("a\nb"))
    tm.write_drops(late, broken)  # the note covers drops that are added later
    for base, multiline in ((plain, False), (broken, True)):
        assert (tmp_path / base / "_multiline").exists() is multiline
        assert all(r["_corrupt_record"] is None for r in tm.read_drops(spark, base, DATA).collect())
    assert tm.read_drops(spark, broken, DATA).filter("v = 'a\nb'").count() == 10


def test_short_and_long_lines_are_malformed(spark, drop):
    base = drop("2026-05-01-00", 1, [person(1), [2, "Bob"], person(3) + ["more"]])
    df = tm.read_drops(spark, base).cache()
    assert rows(df.filter("_corrupt_record IS NULL"), "id") == [(1,)]
    assert rows(df.filter("_corrupt_record IS NOT NULL"), "id") == [(2,), (3,)]
