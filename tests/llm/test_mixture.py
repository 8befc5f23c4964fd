"""The mix against a plain version of it, and its bounds."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixture

SCHEMA = "doc_id long, text string, source string, size string, p int"


def words(n):
    return " \t".join(["w"] * n)


def corpus(n=700):
    rows = []
    for i in range(n):
        source = None if i % 11 == 0 else "hot" if i % 3 else f"s{i % 7}"
        rows.append((i, words(1 + i * 37 % 90), source, None, i))
    rows += [(None, words(3), "hot", "x", None)] * 300  # one key on many rows
    rows += [(None, words(4), None, "x", None)] * 5
    rows += [(1, None, "hot", "", 1), (1, "", "hot", "", 1), (2, " \n\t ", "s1", "", 1)]
    rows += [(3, "", "silent", "", 1), (4, None, "", "", 1), (5, words(20_000), "s2", "", 1)]
    rows += [(i, words(1), "\U0001F600", None, 1) for i in range(70)]
    rows += [(i, words(2), "�", None, 1) for i in range(70)]
    return rows


def plain_targets(sizes, weights, most, budget):
    """Shares by weight; what lies above the limits is shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free = dict.fromkeys(names, 0.0), list(names)
    left = budget * sum(sizes.values())
    while free:
        rate = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * rate >= most * sizes[s]]
        if not over:
            return target | {s: weight[s] * rate for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free = [s for s in free if s not in over]
    return target


def snapped(p):
    return 0.0 if p < 1e-9 else 1.0 if p > 1 - 1e-9 else p


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def plain_mix(rows, weights, most, budget):
    """Taken words and targets by sequential settling, level by level."""
    groups = Counter((r[2], r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in rows)
    sizes = Counter()
    for (source, _, size), m in groups.items():
        sizes[source] += size * m
    target = plain_targets(sizes, weights, most, budget)
    out = []
    for source in sizes:
        rate = target[source] / sizes[source] if sizes[source] else 0.0
        p, base = snapped(rate - math.floor(rate)), math.floor(rate)
        mine = {k: m for k, m in groups.items() if k[0] == source}
        count = -(-sum(k[2] > 0 for k in mine) // 64) or 1
        blocks = defaultdict(list)
        for (_, key, size), m in mine.items():
            high = math.floor(m * p + 1e-9)
            rest = snapped(max(m * p - high, 0.0))
            h = number(f"13|{'null' if key is None else key}|{size}")
            open_one = size > 0 and rest > 0
            out += [(key, size, (base + 1) * size)] * high
            out += [(key, size, base * size)] * (m - high - open_one)
            if open_one:
                blocks[((h >> 20) * count) >> 32].append((-size, h, key, rest))
        while True:
            left = defaultdict(list)
            for block, items in blocks.items():
                held = None
                for item in sorted(items, key=lambda x: (x[0], x[1])):
                    if held is None:
                        held = item
                        continue
                    v, w = -held[0], -item[0]
                    up = min((1 - held[3]) * v, item[3] * w)
                    down = min(held[3] * v, (1 - item[3]) * w)
                    u = number(f"13|{held[1]}|{item[1]}") / 16**13
                    moved = up if u * (up + down) < down else -down
                    both = [
                        (*held[:3], snapped(held[3] + moved / v)),
                        (*item[:3], snapped(item[3] - moved / w)),
                    ]
                    held = next((x for x in both if 0 < x[3] < 1), None)
                    out += [(x[2], -x[0], -x[0] * (base + int(x[3]))) for x in both if x[3] in (0, 1)]
                if held:
                    left[block // 64].append(held)
            if len(blocks) <= 1 and max(blocks, default=0) == 0:
                out += [(x[2], -x[0], -x[0] * (base + math.floor(x[3] + 0.5))) for b in left.values() for x in b]
                break
            blocks = left
    return out, target, sizes


def as_key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("weights, most, budget", [((1, 2, 3), 3, 1.0), ((1, 9), 1.5, 0.4)])
def test_mix_equals_plain(spark, weights, most, budget):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = mixture.mix(df, weights, most, budget).collect()
    want, target, sizes = plain_mix(rows, weights, most, budget)
    assert sorted([(r.doc_id, r.size, r.taken) for r in got], key=as_key) == sorted(want, key=as_key)
    for r in got:
        assert r.target == pytest.approx(target[r.source], rel=1e-12, abs=1e-9)
        assert r.source_size == sizes[r.source] and r.taken == r.copies * r.size
        assert r.taken <= math.ceil(most) * r.size
    taken, largest = Counter(), Counter()
    for r in got:
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for source in sizes:
        assert abs(taken[source] - target[source]) <= largest[source] / 2 + 1e-6
    assert sum(target.values()) == pytest.approx(min(budget, most) * sum(sizes.values()))


def test_reruns_and_other_partitions_agree(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    first = mixture.mix(df.repartition(3)).orderBy(*["doc_id", "size", "taken"]).collect()
    again = mixture.mix(df.orderBy(F.desc("doc_id")).coalesce(1)).orderBy("doc_id", "size", "taken")
    assert first == again.collect()


def test_chances_are_kept(spark):
    """Over many sources of like documents, each place in a block is taken as often as its
    probability says."""
    rows = [(1000 * s + i, words(5 * (i + 1)), f"s{s:03d}", None, 1) for s in range(300) for i in range(6)]
    mixed = mixture.mix(spark.createDataFrame(rows, SCHEMA), weights=(1,), budget=0.4)
    shares = {r.size: r.c for r in mixed.groupBy("size").agg(F.avg("copies").alias("c")).collect()}
    # The last of a source, mostly its smallest, goes to the nearer side instead.
    del shares[5]
    assert all(abs(c - 0.4) < 0.12 for c in shares.values()), shares


def test_edges(spark):
    empty = mixture.mix(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    silent = spark.createDataFrame([(1, None, None, "", 1), (1, "", "a", "", 1)], SCHEMA)
    got = mixture.mix(silent).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 2
    one = mixture.mix(spark.createDataFrame([(7, words(9), "a", "", 1)] * 4, SCHEMA)).collect()
    assert [(r.taken, r.target) for r in one] == [(9, 36.0)] * 4
