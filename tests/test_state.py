import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tidemark as tm
from conftest import plan_of, rows
from tidemark.plans.state import AUDIT_COUNTS, BATCH_COUNTS

SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("v", T.StringType()),
        T.StructField("hour", T.StringType()),
        T.StructField("n", T.IntegerType()),
    ]
)


def make(spark, path, **options):
    options = {"keys": ["id"], "version": ["hour", "n"], **options}
    return tm.StateTable(spark, str(path), SCHEMA, **options)


def batch(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def counts(state):
    """The audit of the newest batch."""
    last = state.audit().orderBy(F.desc("version")).first()
    return tuple(last[name] for name in AUDIT_COUNTS)


def test_first_batch_becomes_the_state(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    assert not state.exists()
    assert rows(state.read()) == []
    assert state.audit().count() == 0
    result = state.apply(batch(spark, (1, "a", "h0", 1), (1, "b", "h0", 2), (2, "c", "h0", 1)))
    assert result == dict(zip(BATCH_COUNTS, (3, 0, 0, 0, 2)))
    assert state.exists()
    assert rows(state.read()) == [(1, "b", "h0", 2), (2, "c", "h0", 1)]
    assert state.read().schema == SCHEMA
    assert counts(state) == (3, 0, 0, 0, 2, 0, 0, 2)


def test_replace_carry_over_and_add(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    state.apply(batch(spark, *[(i, "old", "h0", 1) for i in range(10)]))
    state.apply(batch(spark, (3, "new", "h1", 1), (20, "new", "h1", 1)), label="h1")
    assert rows(state.read().groupBy("v").count()) == [("new", 2), ("old", 9)]
    assert counts(state) == (2, 0, 0, 0, 2, 10, 9, 11)
    assert rows(state.read(0).groupBy("v").count()) == [("old", 10)]
    audit = state.audit().orderBy("version").collect()
    assert [(r.version, r.label, r.final_rows) for r in audit] == [(0, None, 10), (1, "h1", 11)]


def test_an_older_batch_loses_in_version_mode_and_wins_on_arrival(spark, tmp_path):
    first = batch(spark, *[(i, "later", "h1", 1) for i in range(5)])
    second = batch(spark, *[(i, "earlier", "h0", 1) for i in range(1, 7)])
    version = make(spark, tmp_path / "v")
    arrival = make(spark, tmp_path / "a", mode="arrival")
    for state in (version, arrival):
        state.apply(first)
    for state in (version, arrival):
        state.apply(second)
    assert counts(version)[4:] == (6, 5, 5, 7)
    assert counts(arrival)[4:] == (6, 5, 1, 7)
    assert rows(version.read().groupBy("v").count()) == [("earlier", 2), ("later", 5)]
    assert rows(arrival.read().groupBy("v").count()) == [("earlier", 6), ("later", 1)]


def data_bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_a_batch_writes_in_proportion_to_itself(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    state.apply(spark.range(200_000).selectExpr("id", "uuid() AS v", "'h0' AS hour", "1 AS n"))
    before = data_bytes(tmp_path / "s" / "data")
    few = spark.range(0, 200_000, 10_000).selectExpr("id", "'new' AS v", "'h1' AS hour", "1 AS n")
    state.apply(few)
    assert data_bytes(tmp_path / "s" / "data") - before < before / 200
    assert state.read().count() == 200_000
    assert state.read().filter("v = 'new'").count() == 20


def test_a_small_delta_does_not_shuffle_the_base(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    state.apply(spark.range(5000).selectExpr("id", "'a' AS v", "'h0' AS hour", "1 AS n"))
    state.apply(batch(spark, (3, "new", "h1", 1)))
    plan = plan_of(state.read())
    assert "LeftAnti, BuildRight" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("mode", ["version", "arrival"])
def test_folding_changes_neither_rows_nor_counts(spark, tmp_path, mode):
    batches = [
        [(i, f"{h}.{i}", f"h{h}", n) for i in range(h, 40, h + 1) for n in (1, 2)]
        for h in (2, 0, 3, 1)
    ]
    plain = make(spark, tmp_path / "p", mode=mode)
    folded = make(spark, tmp_path / "f", mode=mode)
    folded.fold()
    for number, data in enumerate(batches):
        assert plain.apply(batch(spark, *data)) == folded.apply(batch(spark, *data))
        folded.fold()
        assert rows(plain.read()) == rows(folded.read())
        if number == 2:
            folded.fold()  # nothing to do
            folded.expire(keep=1)
    kept = [c for c in AUDIT_COUNTS]
    assert rows(plain.audit(), *kept) == rows(folded.audit(), *kept)


def test_null_keys_are_rejected_and_counted(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    state.apply(batch(spark, (1, "a", "h0", 1), (None, "x", "h0", 1)))
    state.apply(batch(spark, (None, "y", "h1", 1), (None, "z", "h1", 2)))
    assert counts(state) == (2, 2, 0, 0, 0, 1, 1, 1)
    assert rows(state.read()) == [(1, "a", "h0", 1)]


def test_null_keys_can_match(spark, tmp_path):
    state = make(spark, tmp_path / "s", null_keys="match")
    state.apply(batch(spark, (1, "a", "h0", 1), (None, "old", "h0", 1)))
    state.apply(batch(spark, (None, "new", "h1", 1)))
    assert rows(state.read()) == [(1, "a", "h0", 1), (None, "new", "h1", 1)]


def test_missing_versions_and_bad_lines_are_counted(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a", "h0", None, None), (2, "b", "h0", 1, "2,b,x"), (2, "c", "h0", 2, None)],
        "id int, v string, hour string, n int, _corrupt_record string",
    )
    state = make(spark, tmp_path / "s")
    state.apply(df)
    assert counts(state) == (3, 0, 1, 1, 2, 0, 0, 2)


def test_empty_batch(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    state.apply(batch(spark))
    assert counts(state) == (0, 0, 0, 0, 0, 0, 0, 0)
    assert state.exists()
    assert rows(state.read()) == []
    state.apply(batch(spark, (1, "a", "h0", 1)))
    state.apply(batch(spark))
    assert counts(state) == (0, 0, 0, 0, 0, 1, 1, 1)
    assert rows(state.read()) == [(1, "a", "h0", 1)]


def test_batch_columns_in_another_order_and_type(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    state.apply(spark.sql("SELECT 1L AS n, 'h0' AS hour, 7L AS id, 'a' AS v"))
    assert rows(state.read()) == [(7, "a", "h0", 1)]


def test_failed_batch_leaves_the_state_alone(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    state.apply(batch(spark, (1, "a", "h0", 1)))
    broken = batch(spark, (1, "b", "h1", 1)).withColumn(
        "v", F.raise_error(F.lit("boom")).cast("string")
    )
    with pytest.raises(Exception, match="boom"):
        state.apply(broken)
    assert state.versions() == [0]
    assert rows(state.read()) == [(1, "a", "h0", 1)]
    state.apply(batch(spark, (1, "b", "h1", 1)))
    assert rows(state.read()) == [(1, "b", "h1", 1)]


def test_attempt_without_commit_is_not_read(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    state.apply(batch(spark, (1, "a", "h0", 1)))
    stray = tmp_path / "s" / "data" / "attempt=0000000001-deadbeef"
    batch(spark, (9, "z", "h9", 1)).write.parquet(str(stray))
    assert state.versions() == [0]
    assert rows(state.read()) == [(1, "a", "h0", 1)]


def test_second_writer_of_one_version_fails(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    state.apply(batch(spark, (1, "a", "h0", 1)))
    with pytest.raises(tm.CommitConflict):
        state._publish(0, "late", dict.fromkeys(BATCH_COUNTS, 0), ["0000000000-late"], {})


def test_a_half_written_commit_is_neither_read_nor_in_the_way(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    state.apply(batch(spark, (1, "a", "h0", 1)))
    (tmp_path / "s" / "commits" / "0000000001.json.0abc.tmp").write_text('{"ver')
    assert state.versions() == [0]
    state.apply(batch(spark, (1, "b", "h1", 1)))
    assert rows(state.read()) == [(1, "b", "h1", 1)]
    assert state.audit().count() == 2


def test_repeated_micro_batch_is_skipped(spark, tmp_path):
    state = make(spark, tmp_path / "s", mode="arrival")
    first = state.apply(batch(spark, (1, "a", "h0", 1)), stream=("x", 0))
    state_again = state.apply(batch(spark, (1, "again", "h0", 1)), stream=("x", 0))
    assert state_again == first
    state.apply(batch(spark, (2, "b", "h0", 1)), stream=("y", 0))
    state.apply(batch(spark, (3, "c", "h0", 1)))
    state.apply(batch(spark, (4, "d", "h0", 1)), stream=("x", 1))
    assert state.versions() == [0, 1, 2, 3]
    assert [r[1] for r in rows(state.read())] == ["a", "b", "c", "d"]


def test_expire_keeps_what_is_needed_and_lists_what_can_be_read(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    for h in range(5):
        state.apply(batch(spark, *[(i, f"v{h}", f"h{h}", 1) for i in range(h, 12, h + 1)]))
        if h == 2:
            state.fold()
    newest, previous = rows(state.read()), rows(state.read(4))
    busy = tmp_path / "s" / "data" / "attempt=0000000006-busy"
    busy.mkdir()
    state.expire(keep=2)
    assert busy.exists()
    assert state.versions() == [4, 5]
    assert rows(state.read()) == newest and rows(state.read(4)) == previous
    with pytest.raises(ValueError, match="no version 0"):
        state.read(0)
    state.expire(keep=1)
    assert state.versions() == [5]
    assert rows(state.read()) == newest
    assert rows(state.audit(), "version") == [(0,), (1,), (2,), (4,), (5,)]


def test_changed_declaration_is_refused(spark, tmp_path):
    make(spark, tmp_path / "s").apply(batch(spark, (1, "a", "h0", 1)))
    with pytest.raises(ValueError, match="was created with"):
        make(spark, tmp_path / "s", keys=["v"]).read()
    with pytest.raises(ValueError, match="no version 7"):
        make(spark, tmp_path / "s").read(7)


def test_ties_and_missing_versions_do_not_depend_on_the_order_of_batches(spark, tmp_path):
    parts = [
        [(1, "a", "h1", 1), (2, "x", None, None), (3, "p", "h0", 2)],
        [(1, "b", "h1", 1), (2, "y", None, None), (3, "q", "h0", 1)],
        [(1, "a", "h1", 1), (2, None, None, None), (3, "r", "h0", 2)],
    ]
    for number, order in enumerate(itertools.permutations(parts)):
        for tiebreak in ([], ["n"]):
            state = make(
                spark, tmp_path / f"{number}{len(tiebreak)}", version=["hour"], tiebreak=tiebreak
            )
            for part in order:
                state.apply(batch(spark, *part))
            assert rows(state.read()) == [(1, "b", "h1", 1), (2, "y", None, None), (3, "r", "h0", 2)]


@pytest.mark.parametrize(
    "bad",
    [
        {"mode": "x"},
        {"null_keys": "x"},
        {"keys": []},
        {"version": []},
        {"keys": ["nope"]},
        {"tiebreak": ["nope"]},
    ],
)
def test_bad_options(spark, tmp_path, bad):
    with pytest.raises(ValueError):
        make(spark, tmp_path, **bad)


def test_column_names_of_the_state_are_refused(spark, tmp_path):
    schema = T.StructType(SCHEMA.fields + [T.StructField("attempt", T.StringType())])
    with pytest.raises(ValueError, match="attempt"):
        tm.StateTable(spark, str(tmp_path), schema, ["id"], ["n"])


def test_any_order_of_batches_gives_one_state(spark, tmp_path):
    hours = [
        [(i, f"{h}-{i}", f"h{h}", 1 + i % 2) for i in range(h, 9, h + 1)] for h in range(3)
    ]
    results = set()
    for number, order in enumerate(itertools.permutations(range(3))):
        state = make(spark, tmp_path / str(number))
        for h in [*order, order[0]]:
            state.apply(batch(spark, *hours[h]))
        results.add(tuple(rows(state.read())))
    assert len(results) == 1


BATCHES = st.lists(
    st.lists(st.tuples(st.integers(0, 6), st.integers(1, 3)), max_size=8), min_size=1, max_size=4
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(BATCHES, st.randoms(use_true_random=False))
def test_version_equals_a_maximum_in_python(spark, tmp_path_factory, batches, random):
    state = make(spark, tmp_path_factory.mktemp("s") / "t")
    arriving = [
        [(k, f"{h}", f"h{h}", n) for k, n in data] for h, data in enumerate(batches)
    ]
    random.shuffle(arriving)
    want = {}
    for data in arriving:
        state.apply(batch(spark, *data))
        for row in data:
            if row[0] not in want or want[row[0]][2:] <= row[2:]:
                want[row[0]] = row
    assert sorted(rows(state.read())) == sorted(want.values())


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(BATCHES)
def test_arrival_equals_a_fold_in_python(spark, tmp_path_factory, batches):
    state = make(spark, tmp_path_factory.mktemp("s") / "t", mode="arrival")
    want = {}
    for h, data in enumerate(batches):
        arriving = [(k, f"{h}", f"h{h}", n) for k, n in data]
        state.apply(batch(spark, *arriving))
        want.update({r[0]: r for r in sorted(arriving, key=lambda r: r[3])})
    assert sorted(rows(state.read())) == sorted(want.values())


def scans_of(df):
    return plan_of(df).count("FileScan")


def test_large_deltas_and_folds_scan_everything_once(spark, tmp_path):
    state = make(spark, tmp_path / "s")
    half = spark.range(4000).selectExpr("id", "uuid() AS v", "'h0' AS hour", "1 AS n")
    state.apply(half)
    state.apply(half.withColumn("hour", F.lit("h1")))
    assert scans_of(state.read()) == 1  # base and delta in one scan
    assert rows(state.read().groupBy("hour").count()) == [("h1", 4000)]
    assert not state.fold_due()  # it is not much in bytes


def test_a_fold_is_due_after_many_deltas(spark, tmp_path, monkeypatch):
    from tidemark.plans import state as module

    monkeypatch.setattr(module, "MAX_DELTAS", 3)
    state = make(spark, tmp_path / "s")
    assert not state.fold_due()
    for h in range(4):
        assert not state.fold_due()
        state.apply(batch(spark, (h, "a", f"h{h}", 1)))
    state.apply(batch(spark, (0, "z", "h9", 1)))
    assert state.fold_due()
    before = rows(state.read())
    assert scans_of(state.read()) == 1
    state.fold()
    assert not state.fold_due() and rows(state.read()) == before
    monkeypatch.setattr(module, "LEAST_BYTES", 1)
    state.apply(spark.range(5000).selectExpr("id", "uuid() AS v", "'h9' AS hour", "1 AS n"))
    assert state.fold_due()


@pytest.mark.parametrize("mode", ["version", "arrival"])
def test_many_batches_at_once_equal_one_after_the_other(spark, tmp_path, mode):
    hours = ["h2", "h0", "h3", "h1"]  # in this order, and one of them without rows
    data = [
        (i % 13 if i % 10 else None, f"{h}.{i}", h, i % 3 if i % 7 else None)
        for h in ("h2", "h0", "h1")
        for i in range(len(h), 40)
    ]
    df = batch(spark, *data)
    one, many = make(spark, tmp_path / "o", mode=mode), make(spark, tmp_path / "m", mode=mode)
    for state in (one, many):
        state.apply(batch(spark, (5, "first", "h1", 9)))
    for hour in hours:
        one.apply(df.filter(F.col("hour") == hour), label=hour)
    many.apply_each(df, "hour", hours)
    assert one.versions() == many.versions() == [0, 1, 2, 3, 4]
    for version in one.versions():
        assert rows(one.read(version)) == rows(many.read(version))
    assert rows(one.audit()) == rows(many.audit())
    for state in (one, many):
        state.fold()
        state.apply(batch(spark, (5, "last", "h9", 1)))
    assert rows(one.read()) == rows(many.read()) and rows(one.audit()) == rows(many.audit())
    assert many.versions() == list(range(7))
    many.expire(keep=3)
    assert many.versions() == [4, 5, 6] and rows(many.read(4)) == rows(one.read(4))
    with pytest.raises(ValueError, match="no version 2"):
        many.read(2)
    many.apply_each(df.limit(0), "hour", [])
    assert many.versions() == [4, 5, 6]
