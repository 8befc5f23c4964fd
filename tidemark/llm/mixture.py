"""Mixing sources to target weights by pivotal dependent rounding.

A source's target, in words, over its size says how many copies of each of its documents the mix
takes on average, ``r``: the whole part of ``r`` is certain, the rest is a copy probability.
Two documents of a source with probabilities ``p``, ``q`` and sizes ``v``, ``w`` settle as in
the pivotal method: as many words as one can give and the other take are moved from one to the
other, in a direction drawn at random so that either probability is kept on average, until one
of them is 0 or 1.  ``p * v + q * w`` stays, so a source's words stay at its target until a
single document is left undecided; that one goes to the nearer side.  A source is therefore at
its target to within half of one document, which is a late, hence small one: settling starts
with the largest.

As a Spark job: rows equal in source, id and size are counted before anything else, map-side.
They are alike for the result, so a group of ``m`` settles by arithmetic, all but one row, and
a hot id or a null one is a single row from there on.  The undecided rows are spread by hash over
blocks of about 64, each settled by one ``aggregate``; the undecided rest of 64 blocks is a
block of the next level, and so on up to one block a source: the reduction tree.  Each level is
written, and 64 times smaller than the one before.  A source with a third of all documents is
as many blocks as any other data of its length.

Targets: sources in the order of their code points, null last, have the ``weights`` in turn and
share ``budget`` (1: the size of everything) in that proportion; no target exceeds ``most``
times its source's size, and what lies beyond is shared by the others by weight, until none is
above.  One window over the sources, not over their rows, works that out.

Defined results: a null or wordless text has size 0 and takes 0; sources without any words have
target 0.  Null ids are an id, null sources a source.  Draws are hashes of the seed and the
rows, so reruns agree, however rows are ordered or dealt; of rows equal in source, id and size
it is open which one has a copy more.  Columns other than id, text and source are not read.  An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import stage

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 64
SEED = 13
WORD = r"[^\x20\x09-\x0D]+"
#: A probability this near to 0 or 1 is there: sums of doubles miss it by less.
_NEAR = 1e-9

_ITEM = "struct<id:bigint,h:bigint,size:bigint,copies:bigint,p:double>"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, budget: float = 1.0
) -> DataFrame:
    """Adds ``target`` to one row per source with ``source`` (null is one) and ``words``.

    With the sources in the order of the words they may take per weight, those at their limit
    come first: a source is at it when the share that is left for it and all later ones gives
    it more.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    limit = F.col("words") * F.lit(float(most))
    weighed = sizes.select("*", weight.alias("weight"), limit.alias("limit"))
    order = [F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()]
    everything = Window.partitionBy()
    up_to = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    from_here = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    filled = weighed.select(
        "*",
        (
            F.sum("words").over(everything) * F.lit(float(budget))
            - F.coalesce(F.sum("limit").over(up_to), F.lit(0.0))
        ).alias("left"),
        F.sum("weight").over(from_here).alias("among"),
    ).withColumn("rate", F.col("left") / F.col("among"))
    # The first source below its limit sets the rate of all that follow it.
    below = F.when(F.col("limit") > F.col("rate") * F.col("weight"), F.col("rate"))
    rate = F.first(below, ignorenulls=True).over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = filled.withColumn("rate", rate)
    target = F.coalesce(F.col("rate") * F.col("weight"), F.col("limit"))
    return filled.select(*sizes.columns, target.alias("target"))


def _draw(*parts: Column) -> Column:
    """A number from 0 to 1, excluded, by hash."""
    digest = F.md5(F.concat_ws("|", F.lit(str(SEED)), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def _snapped(p: Column) -> Column:
    return F.when(p < _NEAR, 0.0).when(p > 1 - _NEAR, 1.0).otherwise(p)


def _item(of: Column, p: Column) -> Column:
    return F.struct(of["id"].alias("id"), of["h"].alias("h"), of["size"].alias("size"),
                    of["copies"].alias("copies"), p.alias("p"))


def _settle(state: Column, item: Column) -> Column:
    """The block after ``item`` has met the undecided one: at most one stays undecided."""
    held = state["open"]
    v, w = held["size"].cast("double"), item["size"].cast("double")
    up = F.least((1 - held["p"]) * v, item["p"] * w)  # words that `held` could take
    down = F.least(held["p"] * v, (1 - item["p"]) * w)  # words that it could give
    taken = F.when(_draw(held["h"], item["h"]) * (up + down) < down, up).otherwise(-down)
    met = F.array(
        _item(held, _snapped(held["p"] + taken / v)), _item(item, _snapped(item["p"] - taken / w))
    )
    both = F.when(held.isNull(), F.array(item.cast(_ITEM))).otherwise(met.cast(f"array<{_ITEM}>"))
    undecided = F.filter(both, lambda x: (x["p"] > 0) & (x["p"] < 1))
    decided = F.filter(both, lambda x: (x["p"] <= 0) | (x["p"] >= 1))
    return F.struct(
        F.get(undecided, F.lit(0)).alias("open"),
        F.concat(state["done"], decided).alias("done"),
    )


def _blocks_settled(items: DataFrame) -> DataFrame:
    """One row per source and block: the decided documents, and the undecided one if any."""
    rank = F.struct(-F.col("size"), F.col("h"), F.col("id"), F.col("copies"), F.col("p"))
    item = F.struct("id", "h", "size", "copies", "p").cast(_ITEM).alias("item")
    ranked = F.sort_array(F.collect_list(F.struct(rank.alias("rank"), item)))
    start = F.struct(
        F.lit(None).cast(_ITEM).alias("open"), F.array().cast(f"array<{_ITEM}>").alias("done")
    )
    settled = F.aggregate(
        F.col("ranked"),
        start,
        lambda state, x: _settle(state, x["item"]),
    )
    return (
        items.groupBy("source", "block")
        .agg(ranked.alias("ranked"))
        .select("source", "block", settled.alias("s"))
        .select("source", "block", "s.open", "s.done")
    )


def mix(
    df: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST,
    budget: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row: the id, ``source``, ``size`` in words, ``source_size``, ``target`` (its source's),
    ``copies`` and ``taken`` (copies times size)."""
    alike = ["source", "id", "size"]
    rows = df.select(
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        words_in(F.col(f"`{text_col}`")).alias("size"),
    )
    groups = stage(rows.groupBy(*alike).agg(F.count(F.lit(1)).alias("m")), "mixture")

    with_words = F.count_if(F.col("size") > 0)
    totals = groups.groupBy("source").agg(
        F.sum(F.col("size") * F.col("m")).alias("words"), with_words.alias("documents")
    )
    targets = stage(source_targets(totals, weights, most, budget), "targets")
    # One number: how many blocks the largest source has.
    largest = targets.agg(F.max("documents")).first()[0] or 0

    same_source = F.col("g.source").eqNullSafe(F.col("t.source"))
    rate = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0)
    hashed = F.md5(F.concat_ws("|", F.lit(str(SEED)), F.coalesce(F.col("g.id").cast("string"), F.lit("null")), "size"))
    spread = groups.alias("g").join(targets.alias("t"), same_source).select(
        "g.source",
        "id",
        "size",
        "m",
        _snapped(rate - F.floor(rate)).alias("p"),
        F.floor(rate).alias("copies"),
        F.conv(F.substring(hashed, 1, 13), 16, 10).cast("long").alias("h"),
        F.greatest(F.lit(1), F.ceil(F.col("documents") / BLOCK)).alias("blocks"),
    )
    # Equal rows among themselves: `high` have a copy more, one may stay undecided.
    high = F.floor(F.col("m") * F.col("p") + _NEAR)
    group = spread.select(
        "*",
        high.alias("high"),
        _snapped(F.greatest(F.col("m") * F.col("p") - high, F.lit(0.0))).alias("rest"),
        F.shiftright(F.shiftright("h", 20) * F.col("blocks"), 32).alias("block"),
    )
    undecided = (F.col("size") > 0) & (F.col("rest") > 0)
    sure = group.select(
        "source",
        "id",
        "size",
        F.array(
            F.struct((F.col("copies") + 1).alias("copies"), F.col("high").alias("m")),
            F.struct(
                "copies", (F.col("m") - F.col("high") - undecided.cast("long")).alias("m")
            ),
        ).alias("part"),
    ).select("source", "id", "size", F.inline("part"))
    items = group.filter(undecided).select(
        "source", "block", "id", "h", "size", "copies", F.col("rest").alias("p")
    )

    parts, blocks = [sure.select("source", "id", "size", "copies", "m")], -(-largest // BLOCK)
    while True:
        settled = stage(_blocks_settled(items), "blocks")
        done = F.col("done")
        if blocks <= 1:  # the tree's root: the nearer side
            last = F.array(_item(F.col("open"), F.round("open.p")).cast(_ITEM))
            done = F.when(F.col("open").isNull(), done).otherwise(F.concat(done, last))
        one = settled.select("source", F.explode(done).alias("x"))
        copies = F.col("x.copies") + F.col("x.p").cast("long")
        parts.append(
            one.select("source", "x.id", "x.size", copies.alias("copies"), F.lit(1).cast("long").alias("m"))
        )
        if blocks <= 1:
            break
        items = settled.filter(F.col("open").isNotNull()).select(
            "source", F.expr(f"block div {BLOCK}").alias("block"), "open.*"
        )
        blocks = -(-blocks // BLOCK)

    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    return (
        chosen.filter(F.col("m") > 0)
        .alias("g")
        .join(targets.alias("t"), same_source)
        .select(
            F.col("id").alias(id_col),
            "g.source",
            "size",
            F.col("words").alias("source_size"),
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("nth"),
        )
        .drop("nth")
    )
