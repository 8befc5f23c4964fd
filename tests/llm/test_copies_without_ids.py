"""Near copies by id and text: rows without an id, and several texts of one id."""

import random
import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from tidemark.llm.sketch_join import Similarity, near_duplicates  # noqa: E402

HOW = Similarity(4, 85, 100)


def chain(seed, steps=3):
    """Texts of which only neighbours are near enough."""
    rnd = random.Random(seed)
    words = [f"w{seed}x{rnd.randrange(10**6)}" for _ in range(200)]
    texts = [" ".join(words)]
    for i in range(steps - 1):
        words[20 * i : 20 * i + 2] = [f"n{seed}a{i}", f"n{seed}b{i}"]
        words[100 + 20 * i] = f"n{seed}c{i}"
        words[150 + 8 * i] = f"n{seed}d{i}"
        texts.append(" ".join(words))
    return texts


def linked(a, b):
    x, y = ({tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)} for t in (a, b))
    return 100 * len(x & y) >= 85 * len(x | y)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_links_lead_through_rows_without_an_id(spark):
    a, b, c = chain(1)
    assert linked(a, b) and linked(b, c) and not linked(a, c)
    found = near_duplicates(frame(spark, [(1, a), (None, b), (None, b), (3, c)]), HOW)
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, None: 1, 3: 1}


def test_components_without_any_id(spark):
    a, b, c = chain(2)
    other = chain(3)[0]
    df = frame(spark, [(None, a), (None, b), (None, c), (None, other), (None, None), (9, "x y")])
    found = near_duplicates(df, HOW).collect()
    assert {r.component_id for r in found if r.doc_id is None} == {None}
    names = {r.component_text for r in found if r.n_shingles > 1}
    assert len(names) == 2  # the chain is one, the other text another


def test_one_document_of_each_group_stays(spark):
    a, b, c = chain(4)
    d, e, _ = chain(5)
    f, g, _ = chain(6)
    rows = [
        (None, a), (None, b), (7, c), (None, a),  # led by an id
        (None, d), (None, e),  # no id at all
        (5, f), (5, g), (6, f),  # two near texts of one id
        (8, None), (8, None), (None, None), (None, ""), (9, ""),
    ]
    docs = frame(spark, rows).withColumn("hash of text", F.lit("own")).withColumn("none", F.lit(4))
    got = corpus_pipeline.near_copies(spark, docs, None)
    assert got.columns == docs.columns
    out = [tuple(r) for r in got.collect()]
    assert all(r[2:] == ("own", 4) for r in out)
    kept = sorted((r[:2] for r in out), key=str)
    assert (7, c) in kept and not {(None, a), (None, b), (6, f)} & set(kept)
    assert len({(None, d), (None, e)} & set(kept)) == 1
    assert len({(5, f), (5, g)} & set(kept)) == 1
    # Without words nothing is a copy, but equal rows are one.
    assert [r for r in kept if not r[1]] == sorted([(8, None), (None, None), (None, ""), (9, "")], key=str)
    assert len(kept) == 7
