"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Words are runs of a-z, 0-9 and characters beyond ASCII after lower-casing A-Z.  A window is
``size`` consecutive words of a benchmark item; an item of fewer words, but not none, is one
window.  All windows go into one automaton over normalised text (words between single
spaces), every document's normalised text is scanned once, and hits are mapped back to words
and, for the documents that have any, to character offsets of the original text.

The benchmark is a query set of stated size: its windows are sent to every task as a
broadcast, at most ``block_bytes`` of item text at a time.  A larger benchmark is scanned in
several blocks, each with an automaton of its own, one after the other over the same rows;
hits and item lists are carried along and united, so the result does not depend on blocks.

A null text has no words and is never contaminated.  Items with null text or without words
have no windows; an item without an id still hits, but cannot be named or counted.  Several
rows of one item id are one item.  Repeated rows are judged alike; an empty benchmark hits
nothing; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import carried, map_batches, words_of

WINDOW_WORDS = 13
#: Item text whose windows one automaton holds; about 100 times as much memory.
BLOCK_BYTES = 2 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _normal(words: list[bytes]) -> str:
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def automaton(items: list[tuple[str | None, str]], size: int):
    """Automaton over the windows of items; a window's value is its length in characters,
    its number of words and the ids of the items that have it."""
    windows: dict[str, tuple[int, set[str]]] = {}
    for item_id, text in items:
        words = words_of(text)
        width = min(size, len(words))
        for i in range(len(words) - width + 1 if width else 0):
            _, ids = windows.setdefault(_normal(words[i : i + width]), (width, set()))
            if item_id is not None:
                ids.add(item_id)
    found = ahocorasick.Automaton()
    for key, (width, ids) in windows.items():
        found.add_word(key, (len(key), width, frozenset(ids)))
    if windows:
        found.make_automaton()
    return found


def scan(words: list[bytes], machine) -> tuple[list[tuple[int, int]], set[str]]:
    """Hit word ranges (first, past the last; joined where they touch) and item ids."""
    if not words or not len(machine):
        return [], set()
    hits, ids, counted, at = [], set(), 0, 0
    normal = _normal(words)
    for end, (length, width, which) in machine.iter(normal):
        counted += normal.count(" ", at, end)
        at = end
        hits.append((counted - width, counted))
        ids |= which
    return unite(hits), ids


def unite(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if joined and start <= joined[-1][1]:
            joined[-1] = joined[-1][0], max(stop, joined[-1][1])
        else:
            joined.append((start, stop))
    return joined


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """Items in blocks of bounded text size, one block on the driver at a time."""
    block, size = [], 0
    rows = items.select(F.col(id_col).cast("string"), F.col(text_col)).filter(
        F.col(text_col).isNotNull()
    )
    for item_id, text in rows.toLocalIterator():
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    yield block


def find_passages(
    df: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: list[str] | None = None,
    spans: bool = True,
) -> DataFrame:
    """Every row's hits: the columns ``keep`` (default: all), ``n_words``, ``n_hit`` (words
    inside hits), ``hits`` (word ranges, end exclusive), ``items`` (sorted ids) and, unless
    switched off, ``spans`` (character ranges of the original text, end exclusive)."""
    sc = df.sparkSession.sparkContext
    packed, kept = carried(df.columns if keep is None else keep, text_col)
    hit_type = "array<struct<first:bigint,stop:bigint>>"
    rows = df.select(
        packed,
        F.col(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(hit_type).alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    row_type = rows.schema["row"].dataType.simpleString()
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        sent = sc.broadcast(block)

        def make(sent=sent):
            machine = automaton(sent.value, size)

            def work(columns):
                n_words, hits, items = [], [], []
                for text, old, named in zip(columns["text"], columns["hits"], columns["items"]):
                    words = words_of(text)
                    new, ids = scan(words, machine)
                    before = [(x["first"], x["stop"]) for x in old]
                    joined = unite(before + new) if new and before else new or before
                    n_words.append(len(words))
                    hits.append([{"first": a, "stop": b} for a, b in joined])
                    items.append(sorted(ids.union(named)))
                return columns | {"n_words": n_words, "hits": hits, "items": items}

            return work

        rows = map_batches(
            rows,
            make,
            f"row {row_type}, text string, n_words long, hits {hit_type}, items array<string>",
        )
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x.stop - x.first)
    out = rows.withColumn("n_hit", n_hit)
    if spans:
        span_type = "array<struct<start:bigint,stop:bigint>>"

        def make_spans():
            def work(columns):
                found = [
                    _offsets(text, [(x["first"], x["stop"]) for x in hits])
                    for text, hits in zip(columns["text"], columns["hits"])
                ]
                return columns | {"spans": found}

            return work

        schema = f"row {row_type}, text string, n_words long, hits {hit_type}, "
        schema += f"items array<string>, n_hit long, spans {span_type}"
        out = map_batches(out, make_spans, schema)
    found = [F.col(x) for x in out.columns if x not in ("row", "text")]
    return out.select(*kept, *found)


def _offsets(text: str | None, hits: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Character ranges of the original for word ranges of the normalised text."""
    if not hits:
        return []
    data = text.encode()
    places = [m.span() for m in _WORD.finditer(data.lower())]
    spans, chars, at = [], 0, 0
    for first, stop in hits:  # in order, so characters are counted once
        a, b = places[first][0], places[stop - 1][1]
        chars += len(data[at:a].decode())
        width = len(data[a:b].decode())
        spans.append({"start": chars, "stop": chars + width})
        chars, at = chars + width, b
    return spans


def contaminated(hit_share_of: int = 20):
    """At least one of so many words is hit."""
    return (F.col("n_hit") > 0) & (hit_share_of * F.col("n_hit") >= F.col("n_words"))


def item_digest():
    """Digest of the sorted item ids, comma-joined."""
    return F.sha2(F.array_join("items", ","), 256)


def digest_of(items: list[str]) -> str:
    """What ``item_digest`` gives, for tests and callers outside Spark."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
