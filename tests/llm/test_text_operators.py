"""Operators that judge each text on its own, against plain versions and hostile rows."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from tidemark.llm import line_crf, nbsvm
from tidemark.llm.decontaminate import contaminated, digest_of, find_passages, item_digest
from tidemark.llm.frames import words_of
from tidemark.llm.license_scan import SuffixAutomaton, scan_licences
from tidemark.llm.separator_scan import head_ids, head_tokens, scan_token_files, write_token_files
from tidemark.llm.tree_bpe import (
    TreeBpe,
    decode_documents,
    encode_documents,
    read_ranks,
    round_trip_digests,
)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

#: Nulls, empty and odd texts, a long one, repeated rows, columns with clashing names.
HOSTILE = [
    (1, "The cat sat.\nThe dog ran.", 7, "x"),
    (1, "The cat sat.\nThe dog ran.", 7, "x"),
    (None, "no id here", None, None),
    (2, None, 0, "y"),
    (None, None, None, None),
    (3, "", 1, ""),
    (4, " \n\t\r\n ", 1, "z"),
    (5, "a" * 5000 + " " + "wort " * 3000, 2, "z"),
    (6, "Released under the MIT License.\nÉtat d'été \u00a0 漢字 🙂 \x00 \u2028 x", 2, "z"),
    (-7, "!!! ### | | |\n\n\nA B C", 2, "z"),
]
SCHEMA = "doc_id long, text string, n_words long, hits string"


@pytest.fixture(scope="module")
def hostile(spark):
    return spark.createDataFrame(HOSTILE, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((v is None, str(v)) for v in row)


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


# -- quality rules -------------------------------------------------------------------


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, repeated = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else None
    inside = {i + k for i, w in enumerate(windows) if twice and w in twice for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, repeated, inside, twice


def test_base_counts_equal_plain_ones():
    rnd = random.Random(1)
    texts = [t for _, t, _, _ in HOSTILE]
    texts += [
        "".join(rnd.choice("ab# \n\té\x0b") for _ in range(rnd.randrange(80))) for _ in range(300)
    ]
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randrange(40))) for _ in range(200)]
    for text in texts:
        n, chars, symbols, repeated, inside, twice = plain_base(text)
        got = line_crf.base_counts(text)
        assert got[:4] == (n, chars, symbols, repeated)
        if twice is not None:
            assert got[4] == len(inside)


def test_repeat_words_with_very_many_words():
    words = [b"%d" % i for i in range(1_100_000)]
    assert line_crf.repeat_words(words + words[:5]) == 10


def test_viterbi_finds_the_best_sequence():
    rnd = np.random.default_rng(3)
    for _ in range(40):
        n = len(line_crf.FEATURES)
        model = line_crf.LineCrf(rnd.normal(size=(2, n)), rnd.normal(size=(2, 2)), rnd.normal(size=2))
        masks = [int(x) for x in rnd.integers(0, 1 << n, size=rnd.integers(1, 8))]
        steps = model.scores(np.array(masks))

        def total(labels):
            moves = sum(model.transition[a, b] for a, b in zip(labels, labels[1:]))
            return model.start[labels[0]] + sum(s[x] for s, x in zip(steps, labels)) + moves

        best = max(itertools.product((0, 1), repeat=len(masks)), key=total)
        assert total(model.decode(masks)) == pytest.approx(total(best))


def test_expectations_equal_enumeration():
    rnd = np.random.default_rng(5)
    n = len(line_crf.FEATURES)
    masks = rnd.integers(0, 1 << n, size=4)
    bits = ((masks[:, None] >> np.arange(n)) & 1).astype(float)
    weights = rnd.normal(size=(2, n)), rnd.normal(size=(2, 2)), rnd.normal(size=2)
    paths = list(itertools.product((0, 1), repeat=4))
    scores = bits @ weights[0].T
    logs = [
        weights[2][p[0]]
        + sum(scores[i, x] for i, x in enumerate(p))
        + sum(weights[1][a, b] for a, b in zip(p, p[1:]))
        for p in paths
    ]
    share = np.exp(logs) / np.exp(logs).sum()
    want = np.zeros((2, 2))
    for p, w in zip(paths, share):
        for a, b in zip(p, p[1:]):
            want[a, b] += w
    got = line_crf._expectations(bits[None], np.ones((1, 4), dtype=bool), *weights)
    assert np.allclose(got[1], want)


def test_training_tells_boilerplate_from_content(spark):
    good = [(i, "\n".join(["Some sentence about things of every kind, number %d." % i] * 1 + ["And more of it, told at length, for whoever reads it."] * 1), 1) for i in range(40)]
    bad = [(100 + i, "HOME | LOGIN | MORE!!\n### $$$ %%% BUY NOW!!\nA | B | C", 0) for i in range(40)]
    df = spark.createDataFrame([r[:2] for r in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in good + bad], "doc_id long, quality int")
    model = line_crf.train(df, labels)
    judged = {r.doc_id: r.content_share for r in line_crf.judge(df, model).collect()}
    assert all(judged[r[0]] == 1 for r in good) and all(judged[r[0]] < 0.5 for r in bad)
    again = line_crf.train(df.repartition(3), labels.repartition(2))
    assert np.array_equal(model.emission, again.emission)


def test_quality_rules_on_hostile_rows(spark, hostile, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = line_crf.train(hostile, labels)
    rows = line_crf.judge(hostile, model).collect()
    assert len(rows) == len(HOSTILE)
    blank = [r for r in rows if r.doc_id in (2, 3, 4)]
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in blank)
    assert line_crf.judge(none, model).count() == 0
    kept = line_crf.judge(hostile, model, keep=hostile.columns)
    assert kept.columns[:4] == hostile.columns


# -- quality classifier --------------------------------------------------------------


def test_nbsvm_learns_and_scores_everything(spark, hostile, none):
    rows = [(i, "plain words in a row, and some more of them %d" % i, 1) for i in range(60)]
    rows += [(100 + i, "win win win $$$ CLICK HERE %d" % i, 0) for i in range(60)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, quality int, toxic int")
    train = labels.filter(nbsvm.fold("doc_id") != 0)
    model = nbsvm.train(df, train)
    got = {r.doc_id: r for r in nbsvm.score(df, model).collect()}
    assert all(got[i].predicted == label for i, _, label in rows)
    strange = nbsvm.score(hostile, model).collect()
    assert len(strange) == len(HOSTILE) and all(0 <= r.score <= 1 for r in strange)
    assert nbsvm.score(none, model).count() == 0
    held_out = df.select("doc_id", nbsvm.fold("doc_id").alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in held_out)


def test_nbsvm_without_labels_or_with_one_class(spark, hostile):
    for rows in ([], [(1, 1), (5, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        model = nbsvm.train(hostile, labels)
        assert len({r.score for r in nbsvm.score(hostile, model).collect()}) == 1


def test_dual_coordinate_descent_reaches_the_optimum():
    rnd = np.random.default_rng(11)
    texts = [np.unique(rnd.integers(0, 50, size=12)) for _ in range(60)]
    labels = [int(7 in t or 13 in t) for t in texts]
    model = nbsvm.fit(texts, labels, cost=0.5, epochs=500)
    y = np.array([1.0 if x else -1.0 for x in labels])
    limit = np.where(y > 0, 0.5 * 60 / (2 * (y > 0).sum()), 0.5 * 60 / (2 * (y < 0).sum()))

    def primal(weights, bias):
        margins = np.array(
            [nbsvm.Model(model.ratios, weights, bias, 1, 0).margin(t) for t in texts]
        )
        loss = np.maximum(0, 1 - y * margins)
        return 0.5 * (weights @ weights + bias**2) + (limit * loss).sum()

    best = primal(model.weights, model.bias)
    for _ in range(200):
        step = rnd.normal(size=nbsvm.PLACES) * (model.weights != 0) * 0.01
        assert primal(model.weights + step, model.bias + rnd.normal() * 0.01) >= best - 1e-3


# -- BPE -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=read_ranks(VOCABULARY), special_tokens={}
    )


@pytest.mark.parametrize("leaf", [1, 2, 3, 24])
def test_tree_encodes_like_the_library(reference, leaf):
    bpe, split = TreeBpe(read_ranks(VOCABULARY), leaf), regex.compile(PATTERN).findall
    rnd = random.Random(leaf)
    texts = [t or "" for _, t, _, _ in HOSTILE] + ["the" * 4000, " " * 3000, "ab" * 3000]
    alphabets = ["a", "ab", "thenion", "abcdefghijklmnopqrstuvwxyz", "aé漢🙂", "x1 \n", "'s'll"]
    for _ in range(400):
        letters = rnd.choice(alphabets)
        texts.append("".join(rnd.choice(letters) for _ in range(rnd.choice([1, 5, 30, 200]))))
    for text in texts:
        ids = bpe.encode_text(split(text))
        assert ids == reference.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_bpe_on_hostile_rows(hostile, none, reference):
    got = collected(round_trip_digests(hostile, VOCABULARY, PATTERN), "*")
    want = []
    for doc_id, text, _, _ in HOSTILE:
        ids = reference.encode_ordinary(text or "")
        joined = " ".join(map(str, ids)).encode()
        digests = [hashlib.sha256(x).hexdigest() for x in (joined, (text or "").encode())]
        want.append((doc_id, len(ids), *digests))
    assert got == sorted(want, key=key)
    encoded = encode_documents(hostile, VOCABULARY, PATTERN)
    back = collected(decode_documents(encoded, VOCABULARY), "*")
    assert back == sorted(((d, t or "") for d, t, _, _ in HOSTILE), key=key)
    assert round_trip_digests(none, VOCABULARY, PATTERN).count() == 0


# -- separator scan ------------------------------------------------------------------


@pytest.mark.parametrize("block", [66, 4096])
def test_scan_counts_what_was_written(spark, hostile, reference, tmp_path, block):
    path = str(tmp_path / "tokens")
    write_token_files(hostile.coalesce(2), path, VOCABULARY, PATTERN, 50_256)
    got = scan_token_files(spark, path, 50_256, block_bytes=block)
    want = [(d, len(reference.encode_ordinary(t or ""))) for d, t, _, _ in HOSTILE]
    assert collected(got, "id", "n_tokens") == sorted(want, key=key)
    places = collected(got, "file", "number")
    assert len(set(places)) == len(places)


@pytest.mark.parametrize("width", [2, 4])
def test_scan_of_files_without_heads(spark, tmp_path, width):
    rnd = random.Random(width)
    want = []
    for name, closed in (("a", True), ("b", False), ("c", True), ("empty", True)):
        ids = [] if name == "empty" else [rnd.choice([1, 2, 3, 9, 9]) for _ in range(200)]
        ids += [9] if closed and ids else [5] if ids else []
        (tmp_path / name).write_bytes(np.array(ids, dtype=f"<u{width}").tobytes())
        text = "".join(map(str, ids))
        documents = text.split("9")
        documents = documents[:-1] if not documents[-1] else documents
        want += [(i, len(x)) for i, x in enumerate(documents)]
    for block in (width, 7 * width, 1 << 16):
        got = scan_token_files(spark, str(tmp_path), 9, width=width, head=0, block_bytes=block)
        assert collected(got, "number", "n_tokens") == sorted(want, key=key)


def test_heads_hold_every_id():
    ids = [0, 1, -1, 49_999, 50_000, 2**63 - 1, -(2**63), None]
    rows = np.array([head_tokens(i) for i in ids])
    assert rows.max() < 50_256 and head_ids(rows) == ids


# -- benchmark passages --------------------------------------------------------------


def plain_passages(text, items, size):
    words = words_of(text)
    hit, ids = set(), set()
    for item_id, item in items:
        own = words_of(item)
        width = min(size, len(own))
        for i in range(len(own) - width + 1 if width else 0):
            for j in range(len(words) - width + 1):
                if words[j : j + width] == own[i : i + width]:
                    hit |= set(range(j, j + width))
                    ids |= {str(item_id)} if item_id is not None else set()
    return hit, sorted(ids)


@pytest.mark.parametrize("block_bytes", [1, 20, 1 << 20])
def test_passages_equal_plain_search(spark, block_bytes):
    rnd = random.Random(7)
    items = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randrange(8)))) for i in range(8)]
    items += [(None, "x y z"), (3, "x É y"), (9, None), (10, " .,! "), (11, items[0][1])]
    texts = [t for _, t, _, _ in HOSTILE]
    texts += [" ".join(rnd.choice("ABcx-É.") for _ in range(rnd.randrange(30))) for _ in range(60)]
    texts += ["é, X\tÉ  y; and x É Y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = find_passages(df, bench, size=4, block_bytes=block_bytes)
    found = found.withColumn("digest", item_digest()).withColumn("bad", contaminated())
    rows = {r.doc_id: r for r in found.collect()}
    for doc_id, text in enumerate(texts):
        hit, ids = plain_passages(text, items, 4)
        row = rows[doc_id]
        assert row.n_words == len(words_of(text)) and row.n_hit == len(hit)
        assert row["items"] == ids and row.digest == digest_of(ids)
        assert {p for x in row.hits for p in range(x["first"], x["stop"])} == hit
        assert row.bad == (len(hit) > 0 and 20 * len(hit) >= row.n_words)
        words = words_of(text)
        spans = [words_of(text[s["start"] : s["stop"]]) for s in row.spans]
        assert spans == [words[x["first"] : x["stop"]] for x in row.hits]


def test_passages_with_clashing_columns_and_empty_tables(spark, hostile, none):
    bench = spark.createDataFrame([(1, "the cat")], "item_id long, text string")
    empty = spark.createDataFrame([], "item_id long, text string")
    found = find_passages(hostile, bench, keep=["doc_id"], spans=False)
    assert sum(r.n_hit > 0 for r in found.collect()) == 2
    kept = find_passages(hostile, bench, keep=hostile.columns)
    assert kept.columns[:4] == hostile.columns and kept.count() == len(HOSTILE)
    assert find_passages(hostile, empty, keep=["doc_id"]).agg({"n_hit": "max"}).first()[0] == 0
    assert find_passages(none, bench, keep=["doc_id"]).count() == 0


# -- licences ------------------------------------------------------------------------


def test_automaton_gives_matching_statistics():
    rnd = random.Random(2)
    for _ in range(60):
        texts = [[rnd.choice("abc") for _ in range(rnd.randrange(12))] for _ in range(3)]
        machine = SuffixAutomaton(texts)
        runs = {
            tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)
        }
        words = [rnd.choice("abcd") for _ in range(30)]
        longest = [
            max((k for k in range(i + 2) if tuple(words[i + 1 - k : i + 1]) in runs), default=0)
            for i in range(len(words))
        ]
        want = [
            (i, n)
            for i, n in enumerate(longest)
            if n >= 2 and (i + 1 == len(words) or longest[i + 1] != n + 1)
        ]
        got = machine.runs(words, 2)
        assert [(place, size) for place, size, _ in got] == want
        for place, size, state in got:
            run = words[place - size + 1 : place + 1]
            ends = {
                (k, j - 1)
                for k, t in enumerate(texts)
                for j in range(size, len(t) + 1)
                if t[j - size : j] == run
            }
            assert machine.ends[state] == ends


def test_licences_on_hostile_rows(spark, hostile, none):
    rows = {r.doc_id: r for r in scan_licences(hostile).collect()}
    assert rows[6].base_labels == rows[6].labels == "mit" and rows[6].first_word == 1
    assert rows[2].n_words == 0 and rows[2].labels == "" and rows[2].first_word is None
    assert scan_licences(none).count() == 0
    assert scan_licences(hostile).count() == len(HOSTILE)


def test_phrases_everywhere_and_licence_texts(spark):
    gpl = (
        "This program is FREE software: you can redistribute it and/or modify it under the terms"
        " of our GNU General Public License as published by the Free Software Foundation."
    )
    rows = [
        (1, "cc by nc by cc by nc; CC-BY-NC"),
        (2, gpl),
        (3, "the general public may modify it and see"),
        (4, "This work is licensed under a Creative Commons Attribution-ShareAlike license"),
        (5, "under the mit licenses"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in scan_licences(df).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word) == (3, 0, 7)
    assert got[2].labels == "gpl" and got[2].base_labels == "" and 0.8 < got[2].score <= 1
    assert got[2].spans[0]["stop"] > got[2].spans[0]["first"]
    assert got[3].labels == "" and got[3].score == 0
    assert got[4].labels == "cc-by-sa"
    assert got[5].n_base == 0
