"""Operators that bring rows together, against brute force and hostile rows."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import url_rules
from tidemark.llm.components import components
from tidemark.llm.interleave import shard_rows
from tidemark.llm.line_dedup import dedup_lines, edit_close
from tidemark.llm.sketch_join import (
    Similarity,
    dense_sketch,
    hamming,
    near_duplicates,
    segment_keys,
    word_hashes,
)

LAST = (1 << 63) - 1


def key(row):
    return tuple((v is None, str(v)) for v in row)


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=key)


def edited(rnd, sequence, times, letters):
    out = list(sequence)
    for _ in range(times):
        place = rnd.randrange(len(out) + 1)
        what = rnd.choice("ids")
        if what == "i" or place == len(out):
            out.insert(place, rnd.choice(letters))
        elif what == "d":
            del out[place]
        else:
            out[place] = rnd.choice(letters)
    return out


# -- near copies ---------------------------------------------------------------------


def brute_components(rows, how):
    sets = [set(how.shingles(text).tolist()) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and how.reaches(common, len(sets[i]), len(sets[j])):
            parent[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(
        (
            (doc_id, len(sets[i]), least[find(i)] if sets[i] else doc_id)
            for i, (doc_id, _) in enumerate(rows)
        ),
        key=key,
    )


@pytest.mark.parametrize("how", [Similarity(), Similarity(4, 85, 100), Similarity(2, 50, 100)])
def test_components_equal_brute_force(spark, how):
    rnd = random.Random(how.part)
    words = [f"w{i}" for i in range(300)]
    rows, number = [(0, None), (1, ""), (2, " \n "), (3, None), (4, "one"), (5, "ONE"), (6, "a b c")], 7
    for size in (3, 8, 20, 60, 150, 400):
        for _ in range(4):
            base = [rnd.choice(words) for _ in range(size)]
            for _ in range(6):
                changed = edited(rnd, base, rnd.randrange(1 + size // 12), words)
                rows.append((number, " ".join(changed)))
                number += 1
                base = changed if rnd.random() < 0.4 else base
    rows += [(number, rows[20][1]), (number + 1, rows[20][1].upper())]
    rows += [(None, rows[25][1]), (None, "nobody else says this at all"), rows[30], rows[30]]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("x"))
    got = near_duplicates(df.repartition(5), how)
    assert collected(got, "doc_id", "n_shingles", "component_id") == brute_components(rows, how)


def test_a_large_group_of_near_copies_and_a_shared_passage(spark):
    rnd = random.Random(9)
    words = [f"v{i}" for i in range(2000)]
    base = [rnd.choice(words) for _ in range(120)]
    passage = [rnd.choice(words) for _ in range(60)]
    rows = [(i, " ".join(edited(rnd, base, rnd.randrange(4), words))) for i in range(150)]
    rows += [
        (1000 + i, " ".join(passage + [rnd.choice(words) for _ in range(60)])) for i in range(100)
    ]
    how = Similarity(4, 85, 100)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collected(near_duplicates(df, how), "doc_id", "n_shingles", "component_id")
    assert got == brute_components(rows, how)


def test_word_hashes_tell_words_apart_and_nothing_else():
    rnd = random.Random(3)
    texts = ["", " ", "a", " a", "a b\x0bc\x1cd\u00a0e", "Éa éa", "x" * 300, "x" * 299 + "y"]
    texts += ["".join(rnd.choice("aAbB \n\té") for _ in range(rnd.randrange(60))) for _ in range(300)]
    texts.append("word " * 300_000 + "z" * 2_000_000 + " end")
    known = {}
    for text in texts:
        words = text.encode().lower().split()
        hashes = word_hashes(text.encode())[0].tolist()
        assert len(hashes) == len(words)
        for word, number in zip(words, hashes):
            assert known.setdefault(word, number) == number
    assert len(set(known.values())) == len(known)


def test_partners_agree_on_a_key_and_sketches_bound_the_difference():
    rnd = random.Random(4)
    how = Similarity(1, 80, 100)
    for _ in range(300):
        size = rnd.choice([1, 2, 5, 9, 30, 100, 300])
        words = [str(rnd.random()) for _ in range(size)]
        other = edited(rnd, words, rnd.randrange(1 + size // 5), [str(rnd.random())])
        a, b = how.shingles(" ".join(words)), how.shingles(" ".join(other))
        common = len(set(a.tolist()) & set(b.tolist()))
        difference = len(a) + len(b) - 2 * common
        if len(a) and len(b):
            assert hamming(dense_sketch(a, how), dense_sketch(b, how)) <= difference
        if common and how.reaches(common, len(a), len(b)):
            assert difference <= how.difference(len(a) + len(b))
            (x, _, p), (y, _, q) = segment_keys(a, how), segment_keys(b, how)
            shared = set(x.tolist()) & set(y.tolist())
            spare = max([k for key, k in zip(x.tolist(), p.tolist()) if key in shared], default=0)
            assert len(shared) > spare and len(q) == len(y)


def test_no_near_copies_in_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, node string")
    assert near_duplicates(df).count() == 0


def test_components_of_paths_stars_and_repeats(spark):
    rnd = random.Random(6)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    links += [(200 + rnd.randrange(80), 200 + rnd.randrange(80)) for _ in range(50)]
    shuffled = [rnd.choice([(a, b), (b, a)]) for a, b in links * 2]
    rnd.shuffle(shuffled)
    got = dict(collected(components(spark.createDataFrame(shuffled, "u long, v long"))))
    root = {x: x for pair in links for x in pair}
    for _ in range(100):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}


# -- line dedup ----------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("threshold", [0, 1, 2, 3])
def test_banded_distance_equals_the_builtin(spark, threshold):
    rnd = random.Random(threshold)
    pairs = []
    for _ in range(800):
        a = "".join(rnd.choice("abé漢") for _ in range(rnd.randrange(20)))
        pairs.append((a, "".join(edited(rnd, a, rnd.randrange(6), "abé漢"))))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(
        edit_close(F.col("a"), F.col("b"), threshold).alias("x"),
        (F.levenshtein("a", "b") <= threshold).alias("y"),
    )
    assert got.filter(~F.col("x").eqNullSafe(F.col("y"))).count() == 0


def brute_lines(rows, hashes, threshold, min_chars):
    lines, out = [], []
    for (doc_id, text), of in zip(rows, hashes):
        at_id = LAST if doc_id is None else doc_id
        for at, line in enumerate((text or "").split("\n")):
            if text is not None and len(line) >= min_chars:
                lines.append(((at_id, of, at), line))
    for (doc_id, text), of in zip(rows, hashes):
        if text is None:
            out.append((doc_id, 0, 0, None))
            continue
        left, n, removed = [], 0, 0
        for at, line in enumerate(text.split("\n")):
            if len(line) < min_chars:
                left.append(line)
                continue
            n += 1
            me = (LAST if doc_id is None else doc_id, of, at)
            if any(
                o < me and abs(len(x) - len(line)) <= threshold and distance(x, line) <= threshold
                for o, x in lines
            ):
                removed += 1
            else:
                left.append(line)
        out.append((doc_id, n, removed, "\n".join(left)))
    return sorted(out, key=key)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_lines_equal_brute_force(spark, threshold):
    rnd = random.Random(threshold)
    bases = ["".join(rnd.choice("abcd é") for _ in range(rnd.randrange(9, 30))) for _ in range(25)]
    rows = [(3, None), (4, ""), (None, None), (5, "\n\n"), (6, "x" * 4000), (7, "x" * 3999 + "y")]
    for i in range(120):
        lines = [
            "".join(edited(rnd, rnd.choice(bases), rnd.randrange(4), "abcd é"))
            for _ in range(rnd.randrange(4))
        ]
        rows.append((None if i % 20 == 0 else rnd.randrange(90), "\n".join(lines)))
    rows += [rows[30], rows[30], rows[31]]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit(1))
    hashes = [r.h for r in df.select(F.xxhash64("text").alias("h")).collect()]
    got = dedup_lines(df.repartition(4), threshold, 10)
    assert collected(got) == brute_lines(rows, hashes, threshold, 10)


def test_lines_of_an_empty_table_and_carried_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, at int")
    assert dedup_lines(empty).count() == 0
    df = spark.createDataFrame([(1, "short", 9), (2, "short", 9)], "doc_id long, text string, at int")
    kept = dedup_lines(df, keep=["doc_id", "at"])
    assert collected(kept, "doc_id", "at", "text") == [(1, 9, "short"), (2, 9, "short")]


# -- sharding ------------------------------------------------------------------------


def check_shards(df, shards, total):
    rows = df.collect()
    assert len(rows) == total
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(i, 0) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(shards))
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    return rows


def test_every_shard_holds_the_mixture(spark):
    rows = [(i, f"t{i}", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = shard_rows(df.repartition(7), shards=10)
    placed = check_shards(got, 10, 1000)
    source = {i: s for i, _, s in rows}
    for name, n in Counter(source.values()).items():
        per_shard = Counter(r.shard for r in placed if source[r.doc_id] == name)
        assert all(abs(per_shard.get(i, 0) - n / 10) <= 1 for i in range(10))
    assert collected(got) == collected(shard_rows(df.coalesce(1), shards=10))


def test_shards_of_hostile_rows(spark):
    rows = [(None, None, None), (None, None, ""), (1, "", None), (1, "é", "a"), (1, "é", "a")]
    df = spark.createDataFrame(rows * 3, "doc_id long, text string, source string")
    df = df.withColumn("span", F.lit(1)).withColumn("part", F.lit("x"))
    placed = check_shards(shard_rows(df, shards=4), 4, 15)
    assert {(r.size, r.text_crc32) for r in placed if r.doc_id is None} == {(8, 0)}
    assert {r.size for r in placed} == {8, 10}
    assert shard_rows(df.limit(0)).count() == 0


# -- URL rules -----------------------------------------------------------------------


def plain_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, after = rest[:cut], rest[cut:]
        path = after[: min([after.find(c) for c in "?#" if c in after], default=len(after))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in url_rules.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, best


URLS = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "http://COM/",
    "http://a.com",
    "http://A.Com/x",
    "https://www.example.com/en/1?x=/fr/",
    "https://m.example.com/en/1",
    "https://notexample.com/en/1",
    "https://example.com/en",
    "http://ÄB.net/es/#a",
    "http://b.net/fr/?q",
    "http://b.net/ES/",
    "http://net/fr/",
    "http://b.net?/fr/",
    "a://b://c.com/x",
    "http://x.org/" + "deep/" * 2000 + "?" + "&".join(f"k{i}=1" for i in range(500)),
]


def test_hosts_paths_and_stated_rules(spark):
    pages = spark.createDataFrame(
        [(i, u, 1) for i, u in enumerate(URLS)] + [(None, URLS[8], 2), (3, URLS[8], 2)],
        "page_id long, url string, tokens int",
    )
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = url_rules.filter_urls(pages, labels).collect()
    assert len(rows) == len(URLS) + 2
    for row in rows:
        if row.page_id is None or row.page_id == 3:
            continue
        host, path, best = plain_rule(URLS[row.page_id])
        assert (row.host, row.path) == (host, path)
        assert row.rule == (best[0] if best else None)
        assert row.verdict == (best[1] if best else "allow")
    assert url_rules.filter_urls(pages.limit(0), labels).count() == 0


def test_mined_rules_equal_brute_force(spark):
    rnd = random.Random(8)
    kinds = {"a": "xyz", "b": "pq", "c": "mnop"}
    rows = []
    for _ in range(300):
        tokens = sorted(f"{k}={rnd.choice(v)}" for k, v in kinds.items() if rnd.random() < 0.8)
        blocked = ("a=x" in tokens and rnd.random() < 0.9) or rnd.random() < 0.2
        rows.append((tokens, blocked))
    df = spark.createDataFrame(rows, "tokens array<string>, blocked boolean")
    want = {}
    for size in (1, 2, 3):
        for part in itertools.combinations(sorted({t for r in rows for t in r[0]}), size):
            fits = [b for t, b in rows if set(part) <= set(t)]
            if sum(fits) >= 10 and sum(fits) / len(fits) >= 0.6:
                want[part] = sum(fits) / len(fits)
    pruned = {
        part: sure
        for part, sure in want.items()
        if not any(set(o) < set(part) and s >= sure for o, s in want.items())
    }
    mined = url_rules.mine(df, min_support=0.0, min_count=10, min_confidence=0.6)
    got = {tuple(r.antecedent): r.confidence for r in mined.collect()}
    assert got == pytest.approx(pruned)
    sets = spark.createDataFrame([(r[0],) for r in rows], "tokens array<string>")
    met = {tuple(r.tokens): r.confidence for r in url_rules.match(sets, mined).collect()}
    for tokens, _ in rows:
        sure = [s for part, s in pruned.items() if set(part) <= set(tokens)]
        assert met.get(tuple(tokens)) == (pytest.approx(max(sure)) if sure else None)


def test_mined_rules_block_and_stated_rules_win(spark):
    bad = [(i, f"http://spam{i % 3}.shady.org/en/{i}?ref=x", None) for i in range(60)]
    good = [(100 + i, f"https://fine.org/en/{i}", None) for i in range(60)]
    com = [(200 + i, f"http://spam.shady.com/en/{i}?ref=x", None) for i in range(20)]
    pages = spark.createDataFrame(bad + good + com, "page_id long, url string, html string")
    marks = [(i, 0, 0) for i, _, _ in bad + com] + [(i, 1, 0) for i, _, _ in good]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_rules.filter_urls(pages, labels).collect()}
    assert all(got[i] == "block" for i, _, _ in bad)
    assert all(got[i] == "allow" for i, _, _ in good + com)
