"""Shards of tables where one id, or one document, is on very many rows."""

from collections import Counter

import pytest

from tidemark.llm import interleave


@pytest.mark.parametrize("portion", [7, 10_000])
def test_hot_ids_and_equal_rows(spark, monkeypatch, portion):
    monkeypatch.setattr(interleave, "PORTION", portion)
    rows = [(i, f"text {i}", f"s{i % 3}") for i in range(300)]
    rows += [(None, f"no id {i}", "s0") for i in range(250)]  # one id, many texts
    rows += [(7, "the same row", "s1")] * 400 + [(None, None, None)] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = interleave.shard_rows(df.repartition(5), shards=8).collect()
    assert sorted(map(str, got)) == sorted(map(str, interleave.shard_rows(df, shards=8).collect()))
    sizes = Counter(r.shard for r in got)
    assert len(got) == 1000 and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    assert Counter((r.doc_id, r.size) for r in got) == Counter(
        (i, len((t or "").encode()) + 8) for i, t, _ in rows
    )
    # Every shard holds the source of the hot document in its share; its rows stand together.
    source = {(i, len((t or "").encode()) + 8): s for i, t, s in rows if i is not None}
    share = Counter(r.shard for r in got if source.get((r.doc_id, r.size)) == "s1")
    assert all(abs(n - 500 / 8) <= 2 for n in share.values()) and len(share) == 8
