"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and ranked there; the r-th of n rows
gets the fractional rank (2r - 1) / 2n.  In the order of that rank every stretch of the whole
holds the sources in their overall proportions, so the order is cut into ``shards`` equal
parts: the numbers of rows differ by at most one (the law ``rows``), and every shard holds
every source in its share, to within a few rows.

No rank is taken over a whole source or table in one task.  Hashes, and then ranks, are cut
into about sqrt(N) ranges of equal width; the rows of a range are ranked among themselves and
moved up by what lies in the ranges before, which is a running sum over the sqrt(N) counts.
A source with a third of all rows is spread over all its ranges.

A null text has size 8 and checksum 0; a null source is a source of its own; a null id hashes
like the empty text.  Rows equal in source, id, size and checksum are interchangeable: they are
counted in the tasks that read them and get the ranks that follow one another, so neither an id
on a third of all rows nor a text on as many is more than one row per task until the ranks are
there, by which such rows are then spread.  An empty table gives an empty result.  Other columns are
not read.  Equal texts are not kept together: this law counts rows, and one group of copies
may be larger than a shard.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.files import scratch_path

SHARDS = 24
SEED = 5
#: Rows of a group of equal ones that a task makes at a time.
PORTION = 10_000


def shard_rows(
    df: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row: the id, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``law``,
    ``shard``, ``slot`` (from 0, gapless within the shard) and ``grown_shard`` (null)."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    alike = ["source", "id", "size", "crc"]
    rows = df.select(
        # A null source is apart from every text, the empty one included.
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias(
            "source"
        ),
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
    )
    seeded = F.concat_ws(
        "|", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")), "size", "crc"
    )
    # The texts are read once; what follows works on these few bytes per row.
    groups = rows.groupBy(*alike).agg(F.count(F.lit(1)).alias("m")).withColumn("key", F.md5(seeded))
    staged = scratch_path(spark, "interleave")
    groups.write.parquet(staged)
    groups = spark.read.schema(groups.schema).parquet(staged)
    total = groups.agg(F.sum("m")).first()[0] or 0
    ranges = max(1, math.isqrt(total))

    hashed = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    groups = groups.withColumn("span", F.shiftright(hashed * F.lit(ranges).cast("long"), 32))
    per_source = Window.partitionBy("source")
    before = per_source.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        groups.groupBy("source", "span")
        .agg(F.sum("m").alias("n"))
        .select(
            "source",
            "span",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
            F.sum("n").over(per_source).alias("of"),
        )
    )
    order = [F.col(name).asc_nulls_first() for name in ("key", "id", "size", "crc")]
    within = Window.partitionBy("source", "span").orderBy(*order)
    earlier = F.sum("m").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = F.col("before") + earlier - F.col("m")
    # A group's rows are made in portions of some thousands, dealt out before.
    portions = F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(PORTION).cast("long"))
    ranked = (
        groups.join(spans, ["source", "span"])
        .withColumn("first", first)
        .select(*alike, "key", "of", "m", "first", F.explode(portions).alias("from"))
    )
    many = ranked.filter(F.col("m") > PORTION).repartition("from", "first")
    ranked = ranked.filter(F.col("m") <= PORTION).unionByName(many)
    last = F.least(F.col("m"), F.col("from") + PORTION) - 1
    ranked = ranked.withColumn("nth", F.explode(F.sequence("from", last)))
    rank = F.col("first") + F.col("nth") + 1
    ranked = ranked.withColumn(
        "share", (2 * rank - 1).cast("double") / (2 * F.col("of")).cast("double")
    )

    ranked = ranked.withColumn("part", F.floor(F.col("share") * ranges))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ranked.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("part").orderBy(
        "share", "source", *order
    )
    place = F.col("offset") + F.row_number().over(inside) - 1
    shard = F.expr(f"place * {shards} div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (
        ranked.join(parts, "part")
        .withColumn("place", place)
        .withColumn("shard", shard)
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit("rows").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("place") - first).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
