"""Near-duplicate documents by a parity-sketch join on word shingles.

A text is the set of its distinct shingles.  Every shingle toggles one bit of a sparse sketch,
so the Hamming distance of two sketches never exceeds the symmetric difference of the sets,
and that is at most D = (1 - t) / (1 + t) * (a + b) for sets of sizes a and b with Jaccard
similarity t or more.  Sizes are cut into bands whose bounds grow by 1 / t, so that partners
are in the same band or in neighbouring ones.  Within a band the sketch is cut into more than D
segments: by pigeonhole two partners agree on one.  Documents meet where a segment, compared
by an XOR hash of its bits, agrees.  Candidates are sifted by the Hamming distance of their
folded sketches and verified on their shingles.

There are some segments more than D + 1, so partners agree on several.  Segments without a bit
say nothing and are not sent; as many of the rest as the spare segments still allow are left
out, the most frequent first, which takes away what common passages alone bring together.  A
document with more empty segments than spare ones is sent again with the bits dealt anew, and
at the last level with its empty segments, so no pair can be missed: of two partners, either
one has few empty segments, or both go on.

Equal sets are one class throughout, and sent once per task.  Where many classes agree on a
segment, each is compared with the smallest of them, not with all; what is still unconnected
after that, and only that, is compared pairwise.  So groups of copies cost a number of pairs in
proportion to their size, and no link between different texts is lost.

Shingles are compared by 64-bit hashes, sets for equality by a 128-bit digest.  A null text,
or one without words, has an empty set and is linked with nothing; with fewer words than a
shingle has, the whole sequence is the one shingle.  Rows that repeat an id are rows of their
own; those without an id are linked like others, and their links lead on; where no row of a
component has one, its id is null.  Texts are compared whole, whatever their length.  An empty table gives an empty result.
Columns other than the two named ones are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components, stage
from tidemark.llm.frames import SLICE_ROWS, map_batches

#: Entries of the segment table that one group of keys holds on average.
GROUP_ENTRIES = 1_000_000
#: How often a document with too many empty segments is dealt anew.
LEVELS = 4
#: Rows of entries that a task gathers before it sends them.
FLUSH_ENTRIES = 1_000_000
#: 64-bit words of the brief sketch.
BRIEF_WORDS = 8

_FACTOR = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_SPACE = re.compile(rb"[ \t-\r]")
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
#: A random number for every byte, the same for a letter in both cases, none for white space.
_BYTES = np.random.default_rng(20).integers(0, 1 << 64, size=256, dtype=np.uint64)
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_BYTES[_IS_SPACE] = 0
_POWERS = np.array([pow(_FACTOR, i, 1 << 64) for i in range(256)], dtype=np.uint64)
_CHUNK = 1 << 20


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (between ASCII white space, A-Z in lower case), in order,
    and where the words start: polynomials over the bytes of all words at once."""
    if len(data) > 2 * _CHUNK:  # in pieces, cut at white space
        hashes, places, start = [], [], 0
        while start < len(data):
            gap = _SPACE.search(data, start + _CHUNK)
            stop = gap.start() + 1 if gap else len(data)
            found, starts = _word_hashes(data[start:stop])
            hashes.append(found)
            places.append(starts + start)
            start = stop
        return np.concatenate(hashes), np.concatenate(places)
    return _word_hashes(data)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(data, dtype=np.uint8)
    space = _IS_SPACE[codes]
    turns = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, stops = turns[::2], turns[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    body = codes[starts[0] :]
    sizes = np.diff(starts, append=len(codes))
    offset = np.arange(len(body)) - np.repeat(starts - starts[0], sizes)
    summed = _BYTES[body] * _POWERS[np.minimum(offset, 255)]
    hashes = _mix(np.add.reduceat(summed, starts - starts[0]))
    for i in np.flatnonzero(stops - starts > 255):
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : stops[i]].lower())
    return hashes, starts


@dataclass(frozen=True)
class Similarity:
    """Words per shingle, and the least Jaccard similarity as ``part`` / ``whole``."""

    words: int = 5
    part: int = 80
    whole: int = 100

    def reaches(self, common: int, a: int, b: int) -> bool:
        return self.whole * common >= self.part * (a + b - common)

    def difference(self, sizes: int) -> int:
        """The greatest symmetric difference of partners whose sizes add up to ``sizes``."""
        return (self.whole - self.part) * sizes // (self.whole + self.part)

    def band(self, size: int) -> int:
        """Number of the band of a set size; the lower bounds are in ``_bounds``."""
        bounds = _bounds(self.part, self.whole, max(64, 1 << size.bit_length()))
        return int(np.searchsorted(bounds, size, side="right")) - 1

    def segments(self, band: int) -> tuple[int, int]:
        """Segments of a band's sketches, and how many empty ones do no harm.  The smaller
        partner is in the band, the greater in it or the next."""
        top = _bound(self.part, self.whole, band + 1) - 1
        most = self.difference(top + top * self.whole // self.part)
        spare = 2 + -(-most // 10) if most else 0
        return most + 1 + spare, spare

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the shingles of a text."""
        return self.shingle_sets([text])[0]

    def shingle_sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The same for many texts, some of them at a time."""
        sets, held, size = [], [], 0
        for text in texts:
            held.append(text.encode() if text else b"")
            size += len(held[-1])
            if size >= _CHUNK:
                sets += self._shingle_sets(held)
                held, size = [], 0
        return sets + (self._shingle_sets(held) if held else [])

    def _shingle_sets(self, texts: list[bytes]) -> list[np.ndarray]:
        hashes, starts = word_hashes(b"\n".join(texts))
        opening = np.cumsum([0, *[len(text) + 1 for text in texts]])
        bounds = np.searchsorted(starts, opening).tolist()
        rolled = self._rolled(hashes, self.words)
        sets = []
        for first, stop in zip(bounds, bounds[1:]):
            n = stop - first
            if n >= self.words:
                own = np.sort(rolled[first : stop - self.words + 1])
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            else:
                own = self._rolled(hashes[first:stop], n)
            sets.append(own)
        return sets

    def _rolled(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all runs of so many words; the places in a run have factors of their own,
        so that order counts."""
        if not width or len(hashes) < width:
            return np.empty(0, dtype=np.uint64)
        rolled = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
        for i in range(width):
            rolled += hashes[i : len(rolled) + i] * np.uint64(pow(_FACTOR, i, 1 << 64))
        return _mix(rolled)


@functools.cache
def _bound(part: int, whole: int, band: int) -> int:
    """Lower bound of a band: 1, then the least size beyond the partners of the bound before."""
    if band == 0:
        return 1
    before = _bound(part, whole, band - 1)
    return max(before + 1, before * whole // part + 1)


@functools.cache
def _bounds(part: int, whole: int, limit: int) -> np.ndarray:
    bounds, band = [], 0
    while not bounds or bounds[-1] <= limit:
        bounds.append(_bound(part, whole, band))
        band += 1
    return np.array(bounds)


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def fold_width(size: int, how: Similarity) -> int:
    """Bytes of the dense sketch of a set of that size: a power of two, four bits for every
    difference allowed."""
    return max(8, 1 << (how.difference(2 * size) // 2).bit_length())


def dense_sketch(shingles: np.ndarray, how: Similarity) -> bytes:
    """Parity sketch of fixed width: shorter ones are what longer ones fold to."""
    bits = 8 * fold_width(len(shingles), how)
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def brief_sketch(shingles: np.ndarray) -> list[int]:
    """The sketch at one width for all sets, as 64-bit numbers."""
    places = (shingles >> np.uint64(20)).astype(np.int64) & (64 * BRIEF_WORDS - 1)
    odd = np.bincount(places, minlength=64 * BRIEF_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


def _may_reach(how: Similarity) -> Column:
    """Whether the sizes and brief sketches of sides ``p`` and ``q`` allow the similarity."""
    sizes = F.col("p.size") + F.col("q.size")
    apart = sum(
        F.bit_count(F.get("p.brief", F.lit(i)).bitwiseXOR(F.get("q.brief", F.lit(i))))
        for i in range(BRIEF_WORDS)
    )
    least, most = F.least("p.size", "q.size"), F.greatest("p.size", "q.size")
    return (how.whole * least >= how.part * most) & (
        apart * (how.whole + how.part) <= (how.whole - how.part) * sizes
    )


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two dense sketches, the wider one folded to the other's width."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    if len(x) > len(y):
        x, y = y, x
    if len(x) < len(y):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def segment_keys(shingles: np.ndarray, how: Similarity) -> tuple[np.ndarray, ...]:
    """Keys under which a set is looked up: those of its own band, where it is the smaller
    partner or an equal, and of the band before.  With them, per key, the number of the deal
    it comes from and how many keys of that deal the set may leave out."""
    found, deals, quotas = [], [], []

    def add(keys: np.ndarray, band: int, level: int, quota: int) -> None:
        found.append(keys)
        deals.append(np.full(len(keys), (band & 1) | level << 1, dtype=np.uint8))
        quotas.append(np.full(len(keys), min(max(quota, 0), 255), dtype=np.uint8))

    own = how.band(len(shingles))
    for level in range(LEVELS):
        # Sorted by their bits, shingles are sorted by segment, however many there are.
        bits = np.sort(_mix(shingles + np.uint64(level * _FACTOR % (1 << 64))))
        values, places = _mix(bits), bits >> np.uint64(32)
        short = []
        for band in bands if level else (own, own - 1)[: own + 1]:
            count, spare = how.segments(band)
            place = places * np.uint64(count) >> np.uint64(32)
            starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            value = np.bitwise_xor.reduceat(values, starts)
            salt = np.uint64((band * LEVELS + level) << 40)
            left = spare - (count - len(starts))
            add(_mix(value ^ _mix(salt + place[starts])), band, level, left)
            if left < 0:
                short.append(band)
                if level == LEVELS - 1:
                    empty = np.setdiff1d(np.arange(count, dtype=np.uint64), place[starts])
                    add(_mix(_mix(salt + empty)), band, level, 0)
        bands = short
        if not bands:
            break
    return np.concatenate(found), np.concatenate(deals), np.concatenate(quotas)


def _entries(how: Similarity, groups: int):
    """Task: texts in, blocks of (key, node) per group of keys out."""
    target = pa.schema([("group", pa.int32()), ("block", pa.binary())])

    def send(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        key, deal, quota, node = (np.concatenate(columns) for columns in zip(*held))
        group = (key % np.uint64(groups)).astype(np.int32)
        order = np.argsort(group, kind="stable")
        group = group[order]
        packed = np.empty(len(key), dtype=ENTRY)
        packed["key"], packed["node"] = (key >> np.uint64(32))[order], node[order]
        packed["deal"], packed["quota"] = deal[order], quota[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        stops = [*starts[1:], len(group)]
        blocks = [packed[a:b].tobytes() for a, b in zip(starts, stops)]
        return pa.RecordBatch.from_arrays(
            [pa.array(group[starts]), pa.array(blocks, type=pa.binary())], schema=target
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        held, size = [], 0
        for batch in batches:
            texts = batch.column(0)
            slices = (texts.slice(i, SLICE_ROWS).to_pylist() for i in range(0, len(texts), SLICE_ROWS))
            for shingles in (found for part in slices for found in how.shingle_sets(part)):
                if not len(shingles):
                    continue
                digest = set_digest(shingles)
                if digest in seen:
                    continue
                if len(seen) >= 1 << 18:
                    seen.clear()
                seen.add(digest)
                keys = segment_keys(shingles, how)
                node = int.from_bytes(digest[:8], "little")
                held.append((*keys, np.full(len(keys[0]), node, dtype=np.uint64)))
                size += len(keys[0])
                if size >= FLUSH_ENTRIES:
                    yield send(held)
                    held, size = [], 0
        if held:
            yield send(held)

    return run


ENTRY = np.dtype([("key", "<u4"), ("node", "<u8"), ("deal", "u1"), ("quota", "u1")])


def _agreements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: the blocks of its groups, sorted by group, in; the nodes of every key that has
    several out, with their number."""
    target = pa.schema(
        [
            ("key", pa.int64()),
            ("node", pa.int64()),
            ("deal", pa.int32()),
            ("quota", pa.int32()),
            ("nodes", pa.int32()),
        ]
    )

    def found(group: int, blocks: list[bytes]) -> pa.RecordBatch:
        entries = np.frombuffer(b"".join(blocks), dtype=ENTRY)
        # Only keys met more than once matter, and they are few: sort keys, then those rows.
        key = entries["key"].copy()
        order = np.argsort(key, kind="stable")
        key = key[order]
        twin = np.concatenate([[False], key[1:] == key[:-1]])
        twin[:-1] |= twin[1:]
        entries = entries[order[twin]]
        entries = entries[np.lexsort((entries["node"], entries["key"]))]
        key, node = entries["key"], entries["node"]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
        entries, key = entries[new[: len(entries)]], key[new[: len(entries)]]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
        sizes = np.diff(np.append(starts, len(key)))
        several = np.repeat(sizes > 1, sizes)
        columns = [
            (np.int64(group) << np.int64(32)) | key[several].astype(np.int64),
            entries["node"][several].copy().view(np.int64),
            entries["deal"][several].astype(np.int32),
            entries["quota"][several].astype(np.int32),
            np.repeat(sizes, sizes)[several].astype(np.int32),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=target)

    now, blocks = None, []
    for batch in batches:
        for group, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if group != now and blocks:
                yield found(now, blocks)
                blocks = []
            now = group
            blocks.append(block)
    if blocks:
        yield found(now, blocks)


def _sift(pairs: DataFrame, sets: DataFrame, how: Similarity) -> DataFrame:
    """Pairs of nodes (``x``, ``y``) as pairs of sets (``a``, ``b``) whose sizes and sketches
    allow the similarity."""
    for side, name in (("x", "a"), ("y", "b")):
        columns = [F.col(c).alias(f"{name}_{c}") for c in ("set", "size", "sketch")]
        pairs = pairs.join(sets.select(F.col("node").alias(side), *columns), side)

    def make():
        def work(columns):
            near = [
                how.reaches(min(m, n), m, n) and hamming(x, y) <= how.difference(m + n)
                for m, n, x, y in zip(
                    columns["a_size"], columns["b_size"], columns["a_sketch"], columns["b_sketch"]
                )
            ]
            return {
                "a": [x for x, on in zip(columns["a_set"], near) if on],
                "b": [x for x, on in zip(columns["b_set"], near) if on],
            }

        return work

    sifted = map_batches(
        pairs.select("a_set", "a_size", "a_sketch", "b_set", "b_size", "b_sketch"),
        make,
        "a binary, b binary",
    )
    return sifted.filter(F.col("a") != F.col("b"))


def _verified(pairs: DataFrame, texts: DataFrame, how: Similarity, by: str) -> DataFrame:
    """The pairs, of sets or of nodes, whose shingles reach the similarity, as pairs of sets
    (``u``, ``v``).  Sets that share a node are all tried."""
    first, second = (
        texts.select(F.col(by).alias(x), F.col("set").alias(f"{x}_set"), F.col("text").alias(f"{x}_text"))
        for x in ("a", "b")
    )
    # Never by broadcast: Catalyst would go by the size of the files, and near copies are many
    # times smaller there than in memory.
    both = pairs.join(second.hint("merge"), "b").join(first.hint("merge"), "a")
    both = both.select("a_set", "b_set", "a_text", "b_text")

    def make():
        last: dict[bytes, np.ndarray] = {}

        def work(columns):
            out = {"u": [], "v": []}
            for a, b, x, y in zip(*columns.values()):
                if a not in last:
                    last.clear()
                    last[a] = how.shingles(x)
                p, q = last[a], how.shingles(y)
                common = len(np.intersect1d(p, q, assume_unique=True))
                if how.reaches(common, len(p), len(q)):
                    out["u"].append(a)
                    out["v"].append(b)
            return out

        return work

    return map_batches(both, make, "u binary, v binary").filter(F.col("u") != F.col("v"))


def _open(agreed: DataFrame, sets: DataFrame, links: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of the keys whose nodes are in several components, with what is known of the
    nodes: size, brief sketch, root and number of links."""
    ends = links.select(F.explode(F.array("u", "v")).alias("of"))
    degrees = ends.groupBy("of").agg(F.count(F.lit(1)).alias("degree"))
    placed = roots.withColumnRenamed("node", "of").join(degrees, "of")
    known = (
        sets.select("set", "node", "size", "brief")
        .join(placed, F.col("set") == F.col("of"), "left")
        .select(
            "node",
            "size",
            "brief",
            F.coalesce("root", "set").alias("root"),
            F.coalesce("degree", F.lit(0)).alias("degree"),
        )
    )
    rows = agreed.select("key", "node").join(known, "node")
    mixed = (
        rows.groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter(F.col("low") != F.col("high"))
        .select("key")
    )
    return stage(rows.join(mixed, "key", "left_semi"), "open_agreements")


def _near(left: DataFrame, right: DataFrame, apart: Column, how: Similarity) -> DataFrame:
    """Pairs of nodes (``a``, ``b``) under one key that sizes and brief sketches allow.  The
    sketches are compared within the join: what is near but not near enough, most of a family
    of copies of copies, never becomes a row."""
    return (
        left.alias("p")
        .join(right.alias("q"), F.col("p.key") == F.col("q.key"))
        .filter(apart & _may_reach(how))
        .select(
            F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")
        )
        .distinct()
    )


def near_duplicates(
    df: DataFrame,
    how: Similarity = Similarity(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: the id, ``n_shingles``, ``component_id``, the smallest id that links lead to,
    ``text_hash`` (xxhash64), which tells rows of one id apart, and ``component_text``, that of
    the component's first row: with ``component_id`` it names a component even where no row of
    it has an id."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    hashed = rows.select("id", F.xxhash64("text").alias("text_hash"), "text")

    def make():
        def work(columns):
            out = {name: [] for name in ("size", "set", "node", "sketch", "brief")}
            for shingles in how.shingle_sets(columns["text"]):
                digest = set_digest(shingles) if len(shingles) else None
                out["size"].append(len(shingles))
                out["set"].append(digest)
                out["node"].append(
                    int.from_bytes(digest[:8], "little", signed=True) if digest else None
                )
                out["sketch"].append(dense_sketch(shingles, how) if digest else None)
                out["brief"].append(brief_sketch(shingles) if digest else None)
            return {name: columns[name] for name in ("id", "text_hash")} | out

        return work

    schema = "id long, text_hash long, size long, set binary, node long, sketch binary,"
    schema += " brief array<long>"
    known = stage(map_batches(hashed, make, schema), "sketches")
    sets = stage(
        known.filter(F.col("set").isNotNull())
        .groupBy("set", "node", "size", "sketch", "brief")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("least")),
        "sets",
    )
    # A set sends about 2 t' (1 / t + 1) entries per shingle, t' = (1 - t) / (1 + t).
    share = 2.2 * (how.whole - how.part) / (how.whole + how.part) * (how.whole / how.part + 1)
    total = sets.agg(F.sum(F.col("size") * share + 8)).first()[0] or 0
    groups = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / GROUP_ENTRIES)
    )
    shared = (
        rows.select("text")
        .mapInArrow(_entries(how, groups), "group int, block binary")
        .repartition(groups, "group")
        .sortWithinPartitions("group")
        .mapInArrow(_agreements, "key long, node long, deal int, quota int, nodes int")
    )
    # Partners agree on more keys than either may leave out, so each leaves out its most
    # frequent ones: of two sets with T elements in common, all but the T - 1 last of each, in
    # one order of all elements, still have one in common.
    by_frequency = Window.partitionBy("node", "deal").orderBy(F.desc("nodes"), F.desc("key"))
    agreed = stage(
        shared.withColumn("place", F.row_number().over(by_frequency))
        .filter(F.col("place") > F.col("quota"))
        .select("key", "node"),
        "agreements",
    )
    several = (
        agreed.groupBy("key")
        .agg(F.min("node").alias("least"), F.max("node").alias("most"))
        .filter(F.col("least") != F.col("most"))
        .select("key", "least")
    )
    agreed = stage(agreed.join(several, "key").select("key", "least", "node"), "agreements_left")
    stars = (
        agreed.filter(F.col("least") != F.col("node"))
        .select(F.col("least").alias("x"), F.col("node").alias("y"))
        .distinct()
    )
    pairs = stage(_sift(stars, sets, how).distinct(), "star_pairs")

    # Texts of all sets that agreed with another one, each fetched once, from the row with
    # the least id, or where no row of a set has one, from one row per text without an id.
    agreeing = agreed.select("node").distinct()
    wanted = sets.join(agreeing, "node", "left_semi").select("set", "node", "least.*")
    anonymous = hashed.filter(F.col("id").isNull()).groupBy("text_hash").agg(F.first("text").alias("text"))
    fetched = hashed.join(wanted.filter(~F.col("none")), ["id", "text_hash"]).select("set", "node", "text")
    fetched = fetched.unionByName(
        anonymous.join(wanted.filter("none"), "text_hash").select("set", "node", "text")
    )

    def make_check():
        def work(columns):
            found = map(set_digest, how.shingle_sets(columns["text"]))
            same = [digest == own for digest, own in zip(found, columns["set"])]
            return {
                name: [x for x, on in zip(columns[name], same) if on]
                for name in ("set", "node", "text")
            }

        return work

    texts = map_batches(
        fetched,
        make_check,
        "set binary, node long, text string",
    )
    texts = stage(texts.dropDuplicates(["set"]), "candidate_texts")
    links = stage(_verified(pairs, texts, how, "set"), "star_links")
    roots = components(links)

    # Once more with the best-linked node of every key, which in a family of copies of copies
    # is one from its middle, and only for what is not connected to it yet.
    left = _open(agreed, sets, links, roots)
    middle = left.groupBy("key").agg(F.max(F.struct("degree", "node")).getField("node").alias("m"))
    central = left.join(middle, "key").filter(F.col("node") == F.col("m")).drop("m")
    other = F.col("p.root") != F.col("q.root")
    new = stage(_verified(_near(left, central, other, how), texts, how, "node"), "middle_links")
    roots, links = components(new, roots), links.unionByName(new)

    # What agrees on a segment and is still not connected, pairwise.
    left = _open(agreed, sets, links, roots)
    apart = (F.col("p.node") < F.col("q.node")) & (F.col("p.root") != F.col("q.root"))
    new = stage(_verified(_near(left, left, apart, how), texts, how, "node"), "rest_links")
    roots = components(new, roots)

    named = (
        sets.join(roots, sets["set"] == roots["node"], "left")
        .select("set", F.coalesce("root", "set").alias("root"), "least")
    )
    least = named.groupBy("root").agg(F.min("least").alias("first"))
    component = named.join(least, "root").select("set", "first")
    alone = F.struct(F.lit(False).alias("none"), "id", "text_hash")
    return (
        known.select("id", "text_hash", "size", "set")
        .join(component, "set", "left")
        .withColumn("first", F.when(F.col("set").isNull(), alone).otherwise(F.col("first")))
        .select(
            F.col("id").alias(id_col),
            F.col("size").alias("n_shingles"),
            F.col("first.id").alias("component_id"),
            "text_hash",
            F.col("first.text_hash").alias("component_text"),
        )
    )
