"""Keys of line dedup, cut from the bytes of a line."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tidemark.llm import line_dedup  # noqa: E402


@pytest.mark.parametrize("threshold, min_chars", [(2, 4), (2, 12), (3, 16)])
def test_keys_from_bytes_are_those_of_characters(spark, threshold, min_chars):
    rnd = random.Random(threshold * min_chars)
    letters = ["ab ", "aé", "é漢😀", "a😀"]
    lines = {
        "".join(rnd.choices(rnd.choice(letters), k=n))
        for n in [*range(min_chars, min_chars + 30), 200]
        for _ in range(5)
    }
    bands = line_dedup.edit_bands(threshold, min_chars, False)
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    df = df.withColumn("size", F.length("line"))
    df = df.withColumns(line_dedup.segment_sizes(F.col("size"), bands))
    for columns in line_dedup.boundary_cuts(F.col("line"), F.col("size"), bands):
        df = df.withColumns(columns)
    places = line_dedup.probe_places(threshold)
    wanted = []
    for i, shorter, shift in places:
        size = F.col("size") - shorter
        base = F.floor(size / (threshold + 1)).cast("int")
        start = (i - 1) * base + shift
        part = F.substring("line", start + 1, size - threshold * base if i > threshold else base)
        # Before the line's first character there is no segment to find.
        wanted.append(F.when(start >= 0, F.xxhash64(F.lit(i), size, part)))
    got = line_dedup.place_keys(F.col("size"), places, threshold, 0)
    rows = df.select("line", got.alias("got"), F.array(*wanted).alias("wanted")).collect()
    assert len(rows) == len(lines)
    for row in rows:
        for place, g, w in zip(places, row.got, row.wanted, strict=True):
            assert w is None or g == w, (row.line, place)


def test_probes_that_meet_the_index_are_found_once(spark, monkeypatch):
    staged = []

    def plan(df, purpose):
        staged.append(df)
        return stage(df, purpose)

    stage = line_dedup.stage
    monkeypatch.setattr(line_dedup, "stage", plan)
    rows = [(i, f"line {i % 7} of some length, {i % 50} times told to whoever would hear it") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        line_dedup.dedup_lines(docs, short_lines=True)
        text = staged[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # Probes against the index, and that against those that met and itself: the first join is
    # shuffled once for both uses, not done again.
    assert text.count("SortMergeJoin") == 3
    reused = [x for x in text.splitlines() if "ReusedExchange" in x]
    assert any("REPARTITION_BY_COL" in x for x in reused)


def test_no_shuffle_of_the_keys_stays(spark):
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows = [(i, f"line {i % 90} of some length, told to whoever would hear it") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = spark.conf.get(cleanup)
    shuffles = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    known = shuffles.size()
    found = line_dedup.dedup_lines(docs, short_lines=True)
    # What the driver's garbage collection takes meanwhile can only make them fewer.
    assert shuffles.size() <= known
    assert spark.conf.get(cleanup) == before
    kept = found.filter("text != ''").count()
    assert 0 < kept < 90
