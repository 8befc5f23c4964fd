"""Token counts of flat token files by a block-wise scan for separators.

A token file is nothing but ids of fixed width, little-endian, one document after another,
each followed by the end-of-document id; there is no index.  Files are cut into blocks of equal
size, blocks are read by byte range wherever they lie and searched for the separator at once
for a whole block.  A block only knows the separators inside it.  What stands between the last
one of a block and the first one after it is settled by a prefix scan over the blocks of a
file: running sums give every document its number, and the nearest separator further on its
end, however many blocks lie between.

Files may open every document with its id (``head`` tokens, see ``write_token_files``).  The
head of the document after a separator is read with that separator, past the block's end if
need be.

A text of any length is tokenised whole, one of nothing but white space as well.
A null or empty text is a document of no tokens; a null id stays null.  Repeated rows are
documents of their own.  An empty file has no documents; a last document without a separator
counts if it has any token.  Files need an address that Spark and the file systems of pyarrow
both know (local and shared folders, HDFS with its library, object stores).
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.components import stage
from tidemark.llm.tree_bpe import tokenizer

#: Bytes per block; a task holds one at a time.
BLOCK_BYTES = 8 << 20
#: Blocks that a task reads, on average.
TASK_BLOCKS = 4
#: Tokens that hold an id in front of a document, in digits of this base.
HEAD, BASE = 5, 50_000
_NO_ID = 50_255  # as every digit: the id is null
_SHIFT = 1 << 63


@functools.cache
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


#: White space beyond so many characters in a row is too much for the library's regular expressions,
#: which go down a level for each.
LONG_SPACE = 10_000


@functools.cache
def _long_space():
    return re.compile(rf"\s{{{LONG_SPACE}}}")


def token_ids(text: str | None, vocabulary: str, pattern: str) -> list[int]:
    """Tokens of a text as the library gives them, for white space of any length."""
    if not text:
        return []
    if len(text) >= LONG_SPACE and _long_space().search(text):
        findall, bpe = tokenizer(vocabulary, pattern)
        return bpe.encode_text(findall(text))
    return _encoding(vocabulary, pattern).encode_ordinary(text)


def head_tokens(doc_id: int | None) -> list[int]:
    if doc_id is None:
        return [_NO_ID] * HEAD
    value = doc_id + _SHIFT
    return [value // BASE**k % BASE for k in range(HEAD)]


def head_ids(heads: np.ndarray) -> list[int | None]:
    """Ids of rows of head tokens."""
    out = []
    for row in heads.tolist():
        null = row[0] == _NO_ID
        out.append(None if null else sum(d * BASE**k for k, d in enumerate(row)) - _SHIFT)
    return out


def write_token_files(
    df: DataFrame,
    path: str,
    vocabulary: str,
    pattern: str,
    separator: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Tokenise every whole text into flat files of 16-bit ids, one file per task."""
    marker = int(separator).to_bytes(2, "little").decode("latin-1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = token_ids(text, vocabulary, pattern)
                out.append(np.array(head_tokens(doc_id) + ids, dtype="<u2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["tokens"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Spark's plain writer puts the bytes of every row and then the "line" separator.
    raw = rows.mapInArrow(run, "tokens binary").select(F.col("tokens").cast("string"))
    raw.write.option("lineSep", marker).option("encoding", "ISO-8859-1").text(path)


def _read(path: str, start: int, size: int) -> bytes:
    if path.startswith("file:"):
        system, name = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    else:
        system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as file:
        return file.read_at(size, start)


def scan_token_files(
    spark: SparkSession,
    path: str,
    separator: int,
    width: int = 2,
    head: int = HEAD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every document of the files under a path: ``file``, ``number`` (from 0), ``start``
    (first token after the head), ``n_tokens`` and ``id`` (null where files have no heads)."""
    block_bytes -= block_bytes % width
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    blocks = files.filter(F.col("length") >= width).select(
        "path",
        F.floor(F.col("length") / width).alias("tokens"),
        F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long"))
        ).alias("at"),
    )
    target = pa.schema(
        [
            ("path", pa.string()),
            ("at", pa.int64()),
            ("tokens", pa.int64()),
            ("seps", pa.list_(pa.struct([("sep", pa.int64()), ("id", pa.int64())]))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                # A head's length past the end, for the document after the last separator.
                data = _read(row["path"], row["at"], block_bytes + head * width)
                ids = np.frombuffer(data[: len(data) - len(data) % width], dtype=f"<u{width}")
                inside = ids[: block_bytes // width]
                first = row["at"] // width
                found = np.flatnonzero(inside == separator)
                if not first:  # the file's beginning opens a document like a separator
                    found = np.concatenate([[-1], found])
                names: list[int | None] = [None] * len(found)
                if head:
                    full = found + head < len(ids)
                    heads = ids[found[full][:, None] + np.arange(1, head + 1)]
                    for i, name in zip(np.flatnonzero(full), head_ids(heads)):
                        names[i] = name
                seps = [{"sep": int(p) + first, "id": n} for p, n in zip(found, names)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["path"]]),
                        pa.array([row["at"]], type=pa.int64()),
                        pa.array([row["tokens"]], type=pa.int64()),
                        pa.array([seps], type=target.field("seps").type),
                    ],
                    schema=target,
                )

    # A stated number of tasks: these rows are small, and would else be drawn together into one.
    tasks = max(1, -(-blocks.count() // TASK_BLOCKS))
    found = blocks.repartition(tasks, "path", "at").mapInArrow(
        run, "path string, at long, tokens long, seps array<struct<sep:long,id:long>>"
    )
    found = stage(found, "separators")
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("path").orderBy("at").rowsBetween(1, Window.unboundedFollowing)
    opening = F.get("seps", F.lit(0)).getField("sep")
    scanned = found.select(
        "path", "at", "tokens", F.size("seps").alias("n"), opening.alias("opening")
    ).select(
        "path",
        "at",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("number"),
        F.coalesce(F.first("opening", ignorenulls=True).over(after), F.col("tokens")).alias("next"),
    )
    following = F.coalesce(F.get("seps", F.col("place") + 1).getField("sep"), F.col("next"))
    start = F.col("item.sep") + 1 + head
    return (
        found.join(scanned, ["path", "at"])
        .select("*", F.posexplode("seps").alias("place", "item"))
        .select(
            F.col("path").alias("file"),
            (F.col("number") + F.col("place")).alias("number"),
            start.alias("start"),
            (following - start).alias("n_tokens"),
            F.col("item.id").alias("id"),
            (F.col("item.sep") + 1 < F.col("tokens")).alias("opens"),
        )
        .filter("opens")  # nothing follows the last separator of a file
        .drop("opens")
    )
