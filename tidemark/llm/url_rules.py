"""URL filtering: stated rules first, then association rules mined from labels.

A URL is described by a few tokens, at most one of each kind: scheme, top-level domain, site,
subdomain, host without www., m. and the like where that is longer than the site, first path
segment, extension, path depth, query keys, fragment.  Spark's FP-growth
mines the token combinations of labelled URLs; those that imply a block with enough confidence
and support are kept, unless a part of the combination already implies it as surely.  The rules
are laid out as an inverted index from token to rule.  Every distinct set of tokens is joined
with the index, and a rule fits when all its tokens were met.

A page is labelled by the label of its id: block when it is of low quality or toxic.  Ids
are used for that alone.  Ten kinds of tokens bound the combinations of a URL, however long
it is, so one URL repeated over a third of the table cannot make mining explode.

A null URL, or one without ``://``, has an empty host and path, no tokens, and is allowed.
Repeated rows are judged alike, an empty table gives an empty result; without labels nothing
is mined and only stated rules block.  Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import lower_ascii
from tidemark.sources.files import scratch_path

#: A combination must stand in so many blocked URLs, however many there are.  A share of the
#: labelled URLs can be asked for as well.
MIN_COUNT = 20
MIN_CONFIDENCE = 0.6

# The stated rules, host and path prefix, with their verdicts.
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]

_BLOCK = "label=block"

#: Names in front of a host that say how it is served; two names stay.
_FRONT = r"^(?:(?:www[0-9]*|m|mobile|amp|wap|blog)\.)+(?=[^.]+\.)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    known = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(known > 0, F.substring(url, known + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def stated_rule(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest stated rule that fits columns ``host`` and ``path``, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col(
            "path"
        ).startswith(f"/{path}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The tokens of a URL as a sorted array; empty where there is no host."""
    labels = F.split(host, r"\.")
    bare = F.regexp_replace(host, _FRONT, "")
    segments = F.filter(F.split(lower_ascii(path), "/"), lambda x: x != "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    keys = F.array_sort(
        F.array_distinct(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)))
    )
    kinds = {
        "scheme": lower_ascii(F.substring_index(url, "://", 1)),
        "tld": F.element_at(labels, -1),
        "site": F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")),
        "sub": F.when(
            F.size(labels) > 2, F.array_join(F.slice(labels, F.lit(1), F.size(labels) - 2), ".")
        ),
        "host": F.when(F.size(F.split(bare, r"\.")) > 2, bare),
        "first": F.get(segments, F.lit(0)),
        "extension": F.regexp_extract(lower_ascii(path), r"\.([a-z0-9]{1,8})$", 1),
        "depth": F.size(segments).cast("string"),
        "keys": F.array_join(keys, ","),
        "fragment": F.when(F.contains(url, F.lit("#")), "yes"),
    }
    tokens = [F.when(value != "", F.concat(F.lit(f"{kind}="), value)) for kind, value in kinds.items()]
    return F.when(host != "", F.array_compact(F.array(*tokens))).otherwise(
        F.array().cast("array<string>")
    )


def mine(
    labelled: DataFrame,
    min_support: float = 0.0,
    min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Block rules from rows of ``tokens`` and ``blocked``: ``antecedent`` (sorted),
    ``confidence``, ``support``.  A rule is dropped when a part of it is as sure."""
    spark = labelled.sparkSession
    empty = "antecedent array<string>, confidence double, support double"
    staged = scratch_path(spark, "url_transactions")
    rows = labelled.select(F.monotonically_increasing_id().alias("row"), "tokens", "blocked")
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    total = rows.count()
    if not total:
        return spark.createDataFrame([], empty)
    least = max(min_count, math.ceil(min_support * total))
    # A rule needs each of its tokens in as many blocked URLs as itself.  The others go first, so
    # what mining holds follows the blocked URLs and not the whole table.
    each = rows.select("row", "blocked", F.explode("tokens").alias("token"))
    frequent = each.groupBy("token").agg(F.count_if("blocked").alias("n")).filter(F.col("n") >= least)
    kept = each.join(frequent.select("token"), "token", "left_semi")
    items = kept.groupBy("row", "blocked").agg(F.collect_list("token").alias("tokens"))
    items = items.select(
        F.when(F.col("blocked"), F.array_append("tokens", F.lit(_BLOCK)))
        .otherwise(F.col("tokens"))
        .alias("items")
    )
    staged = scratch_path(spark, "url_items")
    items.write.parquet(staged)
    items = spark.read.schema(items.schema).parquet(staged)
    mined = items.count()
    if not mined:
        return spark.createDataFrame([], empty)
    growth = FPGrowth(
        itemsCol="items",
        minSupport=min(1.0, (least - 0.5) / mined),  # so that rounding cannot move the count
        minConfidence=min_confidence,
    )
    rules = (
        growth.fit(items)
        .associationRules.filter(F.array_contains("consequent", _BLOCK))
        .select(
            F.array_sort("antecedent").alias("antecedent"),
            "confidence",
            (F.col("support") * (mined / total)).alias("support"),
        )
    )
    # Pruning: shorter rules reach longer ones through their first token, every rule being
    # looked up under each of its tokens.
    kept = scratch_path(spark, "url_rules")
    rules.write.parquet(kept)
    rules = spark.read.schema(rules.schema).parquet(kept)
    short = rules.select(
        F.get("antecedent", F.lit(0)).alias("token"),
        F.col("antecedent").alias("part"),
        F.col("confidence").alias("sure"),
    )
    long = rules.select("*", F.explode("antecedent").alias("token"))
    covered = (
        long.join(short, "token")
        .filter(
            (F.size("part") < F.size("antecedent"))
            & (F.col("sure") >= F.col("confidence"))
            & (F.size(F.array_except("part", "antecedent")) == 0)
        )
        .select("antecedent")
        .distinct()
    )
    return rules.join(covered, "antecedent", "left_anti")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Token sets (column ``tokens``) for which all tokens of some rule are met: the distinct
    sets, each with the confidence of its surest rule."""
    index = rules.select(
        F.array_join("antecedent", " ").alias("rule_key"),
        F.size("antecedent").alias("n_tokens"),
        "confidence",
        F.explode("antecedent").alias("token"),
    )
    probes = sets.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token"))
    return (
        probes.join(index, "token")
        .groupBy("tokens", "rule_key", "n_tokens", "confidence")
        .agg(F.count(F.lit(1)).alias("met"))
        .filter(F.col("met") == F.col("n_tokens"))
        .groupBy("tokens")
        .agg(F.max("confidence").alias("confidence"))
    )


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[tuple[str, str]] | None = None,
    min_support: float = 0.0,
    min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
    id_col: str = "page_id",
    url_col: str = "url",
    label_id_col: str = "doc_id",
) -> DataFrame:
    """Per page: the id, ``host``, ``path``, ``rule`` (the stated rule that fits best, else
    null), ``verdict`` (its verdict, else the mined one) and ``confidence`` (of the mined
    block, else null)."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).alias("url"),
        host.alias("host"),
        path.alias("path"),
    )
    rule, verdict = stated_rule(RULES if rules is None else rules)
    rows = rows.select(
        "id",
        "host",
        "path",
        url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"),
        rule.alias("rule"),
        verdict.alias("stated"),
    )
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    judged = labels.groupBy(F.col(label_id_col).cast("long").alias("id")).agg(
        F.max(bad).alias("blocked")
    )
    mined = mine(rows.join(judged, "id"), min_support, min_count, min_confidence)
    matched = match(rows.filter(F.col("rule").isNull()), mined)
    # Only undecided pages are dealt by their tokens.
    undecided = F.col("rule").isNull() & (F.size("tokens") > 0)
    decided = rows.filter(~undecided).withColumn("confidence", F.lit(None).cast("double"))
    judged_rows = rows.filter(undecided).join(matched, "tokens", "left").unionByName(decided)
    blocked = F.col("stated").isNull() & F.col("confidence").isNotNull()
    return judged_rows.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("stated", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.when(blocked, F.col("confidence")).alias("confidence"),
    )
