"""Registered queries against their SQL on the smallest of the given tables, and the stages of
the pipeline against plain versions."""

import os
import random
import sys
import zlib
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import line_crf, nbsvm, queries
from tidemark.llm.sketch_join import Similarity
from tidemark.llm.tree_bpe import read_ranks

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from check import TABLES, compare  # noqa: E402
from test_corpus_operators import brute_components, brute_lines, key  # noqa: E402
from test_text_operators import plain_passages  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"  # the smallest has too few labels to learn from
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason=f"no tables in {SF_DIR}")


def test_all_queries_are_registered():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {"pipeline", *(f"op{i}" for i in range(1, 14))}
    assert names <= set(entry.queries()) and set(queries.oracle_sql()) <= names


@needs_tables
@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    sql = queries.oracle_sql()[name]
    result, _ = compare(spark, duck, SF_DIR, name, queries.queries()[name], sql)
    assert result.startswith("ok"), result


@pytest.mark.skipif(not os.path.isdir(LARGER), reason=f"no tables in {LARGER}")
def test_held_out_quality(spark):
    """Both learners tell good from bad documents they were not trained on."""
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "quality")
    scored = queries.op6_nbsvm(spark, LARGER).filter("held_out").join(labels, "doc_id")
    rows = scored.collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    judged = queries.op1_line_crf(spark, LARGER).filter(nbsvm.fold("doc_id") == 0)
    rows = judged.filter("NOT base_failed").join(labels, "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) >= 0.9 * len(rows)


@needs_tables
def test_token_counts_equal_the_library(spark):
    encoding = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=read_ranks(queries.MULTI_VOCABULARY),
        special_tokens={},
    )
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = {r.doc_id: len(encoding.encode_ordinary(r.text or "")) for r in documents}
    got = {r.doc_id: r.n_tokens for r in queries.op7_separator_scan(spark, SF_DIR).collect()}
    assert got == want


# -- stages --------------------------------------------------------------------------


def corpus():
    rnd = random.Random(12)
    words = [f"word{i}" for i in range(900)]

    def line(n):
        return " ".join(rnd.choice(words) for _ in range(n)).capitalize() + "."

    bench = [(i, line(20)) for i in range(3)]
    shared = line(60)
    rows = []
    for i in range(60):
        lines = [line(rnd.randrange(15, 40)) for _ in range(4)]
        if i % 10 == 1:
            lines.insert(1, shared)
        if i % 10 == 2:
            lines.append(bench[i % 3][1])
        rows.append((i, "\n".join(lines), "en", f"s{i % 3}"))
    rows += [(100 + i, rows[i][1], "en", "s0") for i in range(5)]  # copies
    near = [(200 + i, rows[20 + i][1].replace("word1", "term1", 2), "en", None) for i in range(5)]
    junk = [(300 + i, "BUY!! NOW!! ### $$$ " * 20 + str(i), "en", "s1") for i in range(20)]
    return rows + near + junk, bench


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    rows, bench = corpus()
    odd = [
        (None, rows[0][1], None, None),
        (None, None, None, None),
        (400, None, "en", "s0"),
        (401, "", None, "s0"),
        rows[3],
        rows[3],
    ]
    frame = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string")
    frame = frame.withColumn("n_chars", F.length("text").cast("long"))
    # A column of the caller's own whose name an operator uses as well.
    frame = frame.withColumn("n_words", F.lit(7)).withColumn("row", F.lit("x"))
    frame.write.parquet(f"{folder}/documents.parquet")
    marks = [(r[0], 0 if r[0] >= 300 else 1, 0) for r in rows]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def as_rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


def test_stages_equal_plain_versions(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    bench = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]

    # Quality rules: the base, and the share of the words in content lines.
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    model = line_crf.train(docs, labels.filter(nbsvm.fold("doc_id") != 0))

    def good(text):
        n, _, _, _, repeated = line_crf.base_counts(text)
        masks, sizes = line_crf.line_sequence(text)
        content = sum(s for s, mark in zip(sizes, model.decode(masks)) if mark)
        return n >= 50 and 100 * repeated <= 50 * n and 2 * content >= sum(sizes)

    kept = stages["quality rules"](spark, docs, tables)
    assert kept.columns == columns
    got = as_rows(kept, columns)
    assert got == [r for r in as_rows(docs, columns) if good(r[1])]
    assert 60 <= len(got) < docs.count()

    # Line dedup, with documents that lose every line taken out.
    kept = spark.createDataFrame(kept.collect(), kept.schema)
    before = kept.collect()
    hashes = [r.h for r in kept.select(F.xxhash64("text").alias("h")).collect()]
    plain = brute_lines([(r.doc_id, r.text) for r in before], hashes, 2, 48)
    after = stages["line dedup"](spark, kept, tables)
    assert after.columns == columns
    left = [(d, t) for d, _, removed, t in plain if not (removed and not t.split())]
    assert as_rows(after, ["doc_id", "text"]) == sorted(left, key=key)
    assert all(r.n_chars == len(r.text) for r in after.collect())

    # Near copies, on the texts before dedup, which has taken most of them apart.
    near = stages["near copies"](spark, kept, tables)
    assert near.columns == columns
    how = Similarity(5, 80, 100)
    component = brute_components([(r.doc_id, r.text) for r in before], how)
    stay = {d for d, _, c in component if d is not None and c == d}
    got = near.collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(stay)
    assert not [r for r in got if r.doc_id is None]  # it is a copy of a document with an id

    # Benchmark passages.
    def clean(text):
        hit, _ = plain_passages(text, bench, 13)
        n = len(text.lower().replace("\n", " ").split())
        return not (hit and 20 * len(hit) >= n)

    clear = stages["benchmark passages"](spark, kept, tables)
    assert as_rows(clear, columns) == sorted(
        (tuple(r) for r in before if clean(r.text)), key=key
    )
    assert clear.count() < len(before)

    # Encoding.
    encoding = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=read_ranks(queries.VOCABULARY),
        special_tokens={},
    )
    ids = as_rows(stages["encoding"](spark, docs, tables), ["doc_id", "ids"])
    want = [(r.doc_id, encoding.encode_ordinary(r.text or "")) for r in docs.collect()]
    assert ids == sorted(want, key=key)


def test_run_chains_the_stages(spark, tables):
    rows = corpus_pipeline.run(spark, tables).collect()
    found = [r.doc_id for r in rows]
    assert len(set(found)) == len(found)
    assert not {100, 101, 300, 310, 400, 401, None} & set(found)  # copies, junk, empty texts
    assert {0, 3, 5, 7} <= set(found)  # clean ones, once each


def test_stages_take_an_empty_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, tables)
        assert out.count() == 0
        if name != "encoding":
            assert out.columns == docs.columns
