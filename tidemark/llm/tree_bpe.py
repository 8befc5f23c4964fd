"""Byte-level BPE as a monoid: halves are encoded on their own and joined at the seam.

Two facts make this exact.  The split pattern cuts a text into matches that are encoded
separately, so the encodings of texts cut between matches simply concatenate.  Inside one
match, a sequence of tokens is the encoding of its bytes exactly when every two neighbours
are the encoding of *their* bytes: the first merge that crossed a boundary would also have
crossed it with only the two tokens present.  So a seam is settled as soon as the pairs at
both ends of a re-encoded window are stable, and every token outside it is final.

A null text counts as empty: no tokens, the digest of the empty string twice.  Repeated rows
are encoded alike, an empty table gives an empty result, columns other than the two named
ones are not read.  A text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_batches

#: Matches of at most so many bytes are merged directly: they are the leaves of the tree.
LEAF_BYTES = 12
#: Leaves and seam windows of at most so many bytes are remembered: they come again and again.
MEMO_BYTES = 12
#: Encodings kept per worker and kind; when full they start anew.  Workers outlive their tasks and
#: stand beside the executor's heap, so this is some 30 MB a kind.
CACHE_SIZE = 100_000
#: Matches of the split pattern whose ids are kept; these save most.
PIECES = 200_000


class TreeBpe:
    """Encoder and decoder over a vocabulary of byte strings with merge ranks as ids."""

    def __init__(self, ranks: dict[bytes, int], leaf_bytes: int = LEAF_BYTES):
        self.ranks = ranks
        self.leaf_bytes = max(1, leaf_bytes)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._cache: dict[str, list[int]] = {}
        self._stable: dict[tuple[int, int], bool] = {}
        self._merged: dict[bytes, list[int]] = {}

    def encode_text(self, pieces: list[str]) -> list[int]:
        """Ids of a text, given as the matches of the split pattern."""
        ids: list[int] = []
        cache = self._cache
        for piece in pieces:
            found = cache.get(piece)
            if found is None:
                found = self.encode(piece.encode())
                if len(piece) <= 64:
                    if len(cache) >= PIECES:
                        cache.clear()
                    cache[piece] = found
            ids += found
        return ids

    def encode(self, data: bytes) -> list[int]:
        """Ids of one match: leaves by direct merging, then neighbours joined upwards."""
        if len(data) <= self.leaf_bytes:
            return self.merge(data)
        size = self.leaf_bytes
        level = [self.merge(data[i : i + size]) for i in range(0, len(data), size)]
        while len(level) > 1:
            paired = [self.join(a, b) for a, b in zip(level[::2], level[1::2])]
            level = paired + level[len(paired) * 2 :]
        return level[0]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours from theirs: the window around the seam grows, on
        the side that is not stable yet, until both its ends are."""
        if not left or not right:
            return left + right
        if self.stable(left[-1], right[0]):
            return left + right
        before, after = 1, 1
        while True:
            window = left[len(left) - before :] + right[:after]
            middle = self.merge(b"".join([self.tokens[i] for i in window]))
            open_left = before < len(left) and not self.stable(
                left[len(left) - before - 1], middle[0]
            )
            open_right = after < len(right) and not self.stable(middle[-1], right[after])
            if not open_left and not open_right:
                return left[: len(left) - before] + middle + right[after:]
            if open_left:
                before = min(len(left), before * 2)
            if open_right:
                after = min(len(right), after * 2)

    def stable(self, a: int, b: int) -> bool:
        """Whether two neighbouring tokens are what their own bytes encode to."""
        known = self._stable.get((a, b))
        if known is None:
            known = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
            if len(self._stable) >= CACHE_SIZE:
                self._stable.clear()
            self._stable[a, b] = known
        return known

    def merge(self, data: bytes) -> list[int]:
        """Direct merging: the leftmost pair of lowest rank, again and again."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > 64:
            return self._merge_long(data)
        known = self._merged.get(data)
        if known is None:
            known = self._merge_short(data)
            if len(data) <= MEMO_BYTES:
                if len(self._merged) >= CACHE_SIZE:
                    self._merged.clear()
                self._merged[data] = known
        return known

    def _merge_short(self, data: bytes) -> list[int]:
        ranks = self.ranks
        none, get = len(self.tokens), ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            parts[at : at + 2] = [joined := self.tokens[best]]
            del pairs[at]
            if at:
                pairs[at - 1] = get(parts[at - 1] + joined, none)
            if at < len(pairs):
                pairs[at] = get(joined + parts[at + 1], none)
        return [ranks[part] for part in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same for a long window, with a heap over the pairs instead of rescans."""
        n = len(data)
        end = list(range(1, n + 1))  # of the part that starts here; 0 once merged away
        previous = list(range(-1, n - 1))

        def rank(i: int) -> int | None:
            j = end[i]
            return self.ranks.get(data[i : end[j]]) if j < n else None

        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not end[i] or end[i] >= n or end[end[i]] != stop:
                continue  # one of the two has been merged since
            j = end[i]
            end[i], end[j] = stop, 0
            if stop < n:
                previous[stop] = i
                if (r := rank(i)) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            before = previous[i]
            if before >= 0 and (r := rank(before)) is not None:
                heapq.heappush(heap, (r, before, stop))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[data[i : end[i]]])
            i = end[i]
        return ids

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, concatenated up the tree."""
        tokens = self.tokens
        level = [
            b"".join([tokens[i] for i in ids[start : start + 4096]])
            for start in range(0, len(ids), 4096)
        ]
        while len(level) > 1:
            paired = [a + b for a, b in zip(level[::2], level[1::2])]
            level = paired + level[len(paired) * 2 :]
        return level[0] if level else b""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file, whose lines are base64 and a number."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return {base64.b64decode(pair[0]): int(pair[1]) for pair in pairs if pair}


@functools.cache
def tokenizer(path: str, pattern: str):
    """Splitter and encoder of a worker; loaded once per process."""
    import regex

    return regex.compile(pattern).findall, TreeBpe(read_ranks(path))


def encode_documents(
    df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids of every whole text: the id column, ``ids`` (array of int) and ``n_tokens``."""

    def make():
        findall, bpe = tokenizer(vocabulary, pattern)

        def work(columns):
            ids = [bpe.encode_text(findall(text or "")) for text in columns["text"]]
            return {id_col: columns["id"], "ids": ids, "n_tokens": [len(x) for x in ids]}

        return work

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_batches(rows, make, f"`{id_col}` long, ids array<int>, n_tokens long")


def decode_documents(df: DataFrame, vocabulary: str, id_col: str = "doc_id") -> DataFrame:
    """Texts of encoded documents (columns ``id_col`` and ``ids``); null ids give null."""

    def make():
        _, bpe = tokenizer(vocabulary, "")

        def work(columns):
            texts = [None if x is None else bpe.decode(x).decode() for x in columns["ids"]]
            return {id_col: columns["id"], "text": texts}

        return work

    rows = df.select(F.col(id_col).cast("long").alias("id"), "ids")
    return map_batches(rows, make, f"`{id_col}` long, text string")


def round_trip_digests(
    df: DataFrame,
    vocabulary: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encode and decode every text where it lies: ``n_tokens``, ``ids_sha256`` (decimal ids
    joined by a space), ``decoded_sha256`` and, when asked for, the ``ids`` themselves."""

    def make():
        findall, bpe = tokenizer(vocabulary, pattern)
        names = [str(i) for i in range(len(bpe.tokens))]

        def work(columns):
            out = {name: [] for name in ("n_tokens", "ids_sha256", "decoded_sha256", "ids")}
            for text in columns["text"]:
                ids = bpe.encode_text(findall(text or ""))
                joined = " ".join([names[i] for i in ids])
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                if with_ids:
                    out["ids"].append(ids)
            return {id_col: columns["id"]} | out

        return work

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(rows, make, schema + ", ids array<int>" * with_ids)
