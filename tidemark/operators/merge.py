"""Replace matching keys, carry the rest over, never delete."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key


def same_keys(keys: Sequence[str], null_safe: bool) -> Column:
    """The join condition of sides aliased ``l`` and ``r`` on their keys."""
    pairs = [(F.col(f"l.`{k}`"), F.col(f"r.`{k}`")) for k in keys]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])


def carry_over(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Existing rows whose key did not arrive, columns and order unchanged.

    Only the key columns of ``incoming`` are used, each key once: a key that arrived
    many times would otherwise be shuffled as often, into one task.  No broadcast is
    forced: whether the keys are small enough is for Catalyst and adaptive execution to
    find out.
    """
    arrived = incoming.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    return existing.alias("l").join(arrived.alias("r"), same_keys(keys, null_safe), "left_anti")


def union_merge(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, matched by column name, duplicates kept."""
    return first.unionByName(second)


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    version: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    null_keys: str = "reject",
) -> DataFrame:
    """``existing`` with ``incoming`` merged in; both hold one row per key.

    Without ``version`` an arriving row replaces whatever its key held.  With ``version``
    the greater of two rows stays, by ``version``, ``tiebreak`` and then the remaining
    columns, so the result does not depend on the order in which batches are applied.

    ``null_keys='reject'`` leaves out rows with a NULL in the key; ``'match'`` treats
    NULL as a key like any other.
    """
    if null_keys not in ("reject", "match"):
        raise ValueError(f"null_keys must be 'reject' or 'match', not {null_keys!r}")
    null_safe = null_keys == "match"
    if not null_safe:
        existing = existing.filter(_has_key(keys))
        incoming = incoming.filter(_has_key(keys))
    if version:
        return latest_per_key(union_merge(existing, incoming), keys, version, tiebreak)
    arrived = incoming.select(*[F.col(f"`{k}`") for k in keys])
    kept = existing.alias("l").join(arrived.alias("r"), same_keys(keys, null_safe), "left_anti")
    return union_merge(kept, incoming)


def upsert_audit(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The five counts of one batch, as one row, before anything is written.

    ``incoming`` is the batch as it arrived, ``existing`` has one row per key.  Rows
    with a NULL in the key count as incoming but not further, as in ``upsert``.
    Both sides go through one grouping on the key; only key columns are read.
    """
    cols = [F.col(f"`{k}`") for k in keys]
    sides = existing.select(*cols, F.lit(1).alias("__old"), F.lit(0).alias("__new")).unionByName(
        incoming.select(*cols, F.lit(0).alias("__old"), F.lit(1).alias("__new"))
    )
    per_key = sides.groupBy(*cols).agg(
        F.sum("__old").alias("__old"), F.sum("__new").alias("__new")
    )
    usable = _has_key(keys)
    arrived = usable & (F.col("__new") > 0)
    held = usable & (F.col("__old") > 0)
    return per_key.agg(
        F.coalesce(F.sum("__new"), F.lit(0)).alias("incoming_rows"),
        F.count_if(arrived).alias("latest_rows"),
        F.count_if(held).alias("existing_rows"),
        F.count_if(held & (F.col("__new") == 0)).alias("remaining_rows"),
        F.count_if(usable).alias("final_rows"),
    )
