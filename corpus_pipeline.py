"""From documents to tokens: quality, line dedup, near copies, benchmark passages, encoding.

Every stage takes what its predecessor kept and returns the columns of documents; the last one
returns tokens.  Rows without an id are near copies like others; rows equal in id and text are
one document to that stage.  A text that a stage shortens gets a new
``n_chars`` where that column exists.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import line_crf, nbsvm
from tidemark.llm.components import stage
from tidemark.llm.decontaminate import contaminated, find_passages
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.sketch_join import Similarity, near_duplicates
from tidemark.llm.tree_bpe import round_trip_digests


def _packed(docs):
    """Id, text and, under one name that clashes with none of an operator's, the rest."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("row"), "doc_id", "text")


def _unpacked(found, docs, new=()):
    """The columns of ``docs`` again; ``new`` replaces some."""
    columns = {c: F.col("text" if c == "text" else f"row.`{c}`") for c in docs.columns}
    return found.select(*[c.alias(name) for name, c in (columns | dict(new)).items()])


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules keep, unchanged."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = line_crf.train(docs, labels.filter(nbsvm.fold("doc_id") != 0))
    judged = line_crf.judge(_packed(docs), model, keep=["row", "text"])
    return _unpacked(judged.filter("kept"), docs)


def line_dedup(spark, docs, sf_dir):
    """Documents without the lines that stand earlier; one left without any word goes."""
    found = dedup_lines(_packed(docs), keep=["row"], short_lines=True)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"\S")
    new = {}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        shortened = F.length("text").cast(kind)
        new["n_chars"] = F.when(F.col("n_removed") > 0, shortened).otherwise(F.col("row.n_chars"))
    return _unpacked(found.filter(~F.coalesce(emptied, F.lit(False))), docs, new)


def near_copies(spark, docs, sf_dir):
    """One document of every group of near copies, that of the smallest id, and of several texts
    of that id the first by a hash of the text."""

    def key(id_col, text_hash):
        none, known = F.col(id_col).isNull(), F.coalesce(F.col(id_col), F.lit(0))
        return [none.alias("none"), known.alias("id"), text_hash.alias("of")]

    found = near_duplicates(docs.select("doc_id", "text"), Similarity(5, 80, 100))
    first = F.col("component_id").eqNullSafe(F.col("doc_id")) & (
        F.col("component_text") == F.col("text_hash")
    )
    others = found.filter(~first).select(*key("doc_id", F.col("text_hash"))).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, *key("doc_id", F.xxhash64("text")))
    names = ["none", "id", "of"]
    return keyed.join(others, names, "left_anti").dropDuplicates(names).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )


def benchmark_passages(spark, docs, sf_dir):
    """Documents that benchmark passages do not contaminate, unchanged."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_passages(_packed(docs), benchmark, keep=["row", "text"], spans=False)
    return _unpacked(found.filter(~contaminated()), docs)


def encode(spark, docs, sf_dir):
    """Ids of every document, with the digests that prove the way back."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip_digests(docs, vocabulary, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near copies", near_copies),
    ("benchmark passages", benchmark_passages),
    ("encoding", encode),
]

#: The line field is trained, edit distances and merges are no SQL: see tests/llm.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
