import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tidemark as tm
from conftest import plan_of, rows

BOTH = pytest.mark.parametrize("strategy", ["aggregate", "window"])


@BOTH
def test_highest_version_wins(spark, strategy):
    df = spark.createDataFrame(
        [("old", 1, 1), ("new", 1, 3), ("mid", 1, 2), ("only", 2, 1)],
        "v string, id int, file_index int",
    )
    out = tm.latest_per_key(df, ["id"], ["file_index"], strategy=strategy)
    assert out.columns == df.columns
    assert rows(out) == [("new", 1, 3), ("only", 2, 1)]


@BOTH
def test_missing_version_ranks_last(spark, strategy):
    df = spark.createDataFrame(
        [(1, None, "x"), (1, -5, "y"), (2, None, "z")], "id int, n int, v string"
    )
    assert rows(tm.latest_per_key(df, ["id"], ["n"], strategy=strategy)) == [
        (1, -5, "y"),
        (2, None, "z"),
    ]


@BOTH
def test_declared_tiebreak_decides(spark, strategy):
    df = spark.createDataFrame(
        [(1, 7, 1, "z"), (1, 7, 2, "a")], "id int, n int, line int, v string"
    )
    assert rows(tm.latest_per_key(df, ["id"], ["n"], ["line"], strategy)) == [(1, 7, 2, "a")]


@BOTH
def test_undeclared_tie_does_not_depend_on_order(spark, strategy):
    data = [(1, 7, chr(97 + i)) for i in range(20)]
    for ordered in (data, data[::-1]):
        df = spark.createDataFrame(ordered, "id int, n int, v string").repartition(7)
        assert rows(tm.latest_per_key(df, ["id"], ["n"], strategy=strategy)) == [(1, 7, "t")]


@BOTH
def test_version_over_several_columns_and_keys(spark, strategy):
    df = spark.createDataFrame(
        [("a", 1, "h1", 9, 0.5), ("a", 1, "h2", 1, 1.5), ("b", 1, "h1", 1, 2.5)],
        "k string, id int, h string, n int, v double",
    )
    assert rows(tm.latest_per_key(df, ["k", "id"], ["h", "n"], strategy=strategy)) == [
        ("a", 1, "h2", 1, 1.5),
        ("b", 1, "h1", 1, 2.5),
    ]


@BOTH
def test_columns_that_cannot_be_ordered_are_carried(spark, strategy):
    df = spark.sql(
        "SELECT 1 AS id, 1 AS n, map('a', 1) AS m UNION ALL SELECT 1, 2, map('b', 2)"
    )
    assert tm.latest_per_key(df, ["id"], ["n"], strategy=strategy).first().m == {"b": 2}


def test_key_columns_alone(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert rows(tm.latest_per_key(df, ["id"], [])) == [(1,), (2,)]


def test_tally_counts_input_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, None)], "id int, n int")
    out = tm.latest_per_key(
        df, ["id"], ["n"], tally={"rows": F.lit(True), "bad": F.col("n").isNull()}
    )
    assert rows(out) == [(1, 2, 2, 0), (2, None, 1, 1)]


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="unknown strategy"):
        tm.latest_per_key(spark.range(1), ["id"], [], strategy="x")


def test_each_task_reduces_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS id", "id AS n", "cast(id AS string) AS v")
    plan = plan_of(tm.latest_per_key(df, ["id"], ["n"]))
    assert plan.count("Exchange") == 1
    assert "partial_max" in plan.split("Exchange")[1]
    plan = plan_of(tm.latest_per_key(df, ["id"], ["n"], strategy="window"))
    assert plan.count("Exchange") == 1
    assert "Partial" in plan.split("Exchange")[1]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.integers(0, 4),
            st.one_of(st.none(), st.integers(-3, 3)),
            st.sampled_from("abc"),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_equals_brute_force(spark, data):
    best = {}
    for key, n, v in data:
        rank = (n is not None, n or 0, v)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, (key, n, v))
    want = sorted(row for _, row in best.values())
    df = spark.createDataFrame(data, "id int, n int, v string").repartition(3)
    for strategy in ("aggregate", "window"):
        got = rows(tm.latest_per_key(df, ["id"], ["n"], strategy=strategy))
        assert sorted(got) == want
