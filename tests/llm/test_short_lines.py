"""Line dedup over lines of any length."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
from test_corpus_operators import LAST, collected, distance, edited, key  # noqa: E402

from tidemark.llm.line_dedup import dedup_lines  # noqa: E402


def allowed(a, b, threshold, min_chars):
    shorter = min(len(a), len(b))
    if shorter >= min_chars:
        return threshold
    return min(threshold - 1, max(0, shorter // (min_chars // (threshold + 1)) - 1))


def brute(rows, hashes, threshold, min_chars):
    lines = [
        ((LAST if doc_id is None else doc_id, of, at), line)
        for (doc_id, text), of in zip(rows, hashes)
        for at, line in enumerate((text or "").split("\n"))
        if line.strip(" \t\r")
    ]
    out = []
    for (doc_id, text), of in zip(rows, hashes):
        left, n = [], 0
        for at, line in enumerate((text or "").split("\n")):
            me = (LAST if doc_id is None else doc_id, of, at)
            n += bool(line.strip(" \t\r"))
            gone = line.strip(" \t\r") and any(
                o < me
                and abs(len(x) - len(line)) <= threshold
                and distance(x, line) <= allowed(x, line, threshold, min_chars)
                for o, x in lines
            )
            left += [] if gone else [line]
        removed = len((text or "").split("\n")) - len(left)
        out.append((doc_id, n, removed, None if text is None else "\n".join(left)))
    return sorted(out, key=key)


@pytest.mark.parametrize("threshold, min_chars", [(1, 10), (2, 12), (2, 14), (3, 16)])
def test_lines_of_any_length_equal_brute_force(spark, threshold, min_chars):
    rnd = random.Random(threshold + min_chars)
    bases = ["".join(rnd.choice("abcd é") for _ in range(rnd.randrange(1, 24))) for _ in range(40)]
    rows = [(3, None), (4, ""), (None, None), (5, "\n \n\t\n "), (6, "a\na"), (7, " a\na ")]
    for i in range(150):
        lines = [
            "".join(edited(rnd, rnd.choice(bases), rnd.randrange(3), "abcd é"))
            for _ in range(rnd.randrange(4))
        ]
        rows.append((None if i % 20 == 0 else rnd.randrange(90), "\n".join(lines)))
    rows += [rows[30], rows[30], rows[31]]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit(1))
    hashes = [r.h for r in df.select(F.xxhash64("text").alias("h")).collect()]
    got = dedup_lines(df.repartition(4), threshold, min_chars, short_lines=True)
    assert collected(got) == brute(rows, hashes, threshold, min_chars)


def test_the_pipeline_removes_short_repeats(spark):
    notice, near = "All content is provided as is.", "Subscribe to the weekly newsletter!"
    rows = [
        (1, f"{notice}\nHome\n\nfirst text\n{near}"),
        (2, f"{notice}\nHome\n\nsecond text\n{near[:-1]}"),
        (3, f"{notice[:-1]}\nHame\n\nthird text"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(collected(corpus_pipeline.line_dedup(spark, docs, None), "doc_id", "text"))
    assert got[1] == rows[0][1]
    assert got[2] == "\nsecond text"  # one edit from 32 characters on
    assert got[3] == rows[2][1]  # none below


def test_the_greatest_id_and_missing_ones(spark):
    text = "the very same line"
    rows = [(LAST, text), (None, text), (None, text), (LAST - 1, "another line\n" + text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_lines(df, short_lines=True).collect()
    left = sorted(((r.doc_id is None, r.doc_id), r.text) for r in got)
    # Of equal rows all are decided alike: the line stands in an earlier document.
    assert left == [
        ((False, LAST - 1), f"another line\n{text}"), ((False, LAST), ""), ((True, None), ""), ((True, None), ""),
    ]


def test_very_long_and_periodic_lines(spark):
    rows = [(i, line) for i, line in enumerate(["-" * n for n in range(1, 80)])]
    rows += [(100, "ab" * 50_000), (101, "ab" * 50_000 + "c"), (102, "xy" + "ab" * 50_000 + "cd")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in dedup_lines(df, short_lines=True).filter("text != ''").collect()}
    # Of 32 to 47 characters one edit removes a line, from 48 on two do.
    assert kept == {*range(32), 100, 102}
