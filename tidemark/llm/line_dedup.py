"""Line dedup by a segment-partition edit join.

Lines of at least ``min_chars`` characters are compared; with ``short_lines`` shorter ones are,
too, unless they are blank.  A line goes when an equal line, or one within ``threshold`` edits,
stands earlier.  The order is that of the ids and then of the lines within a text; which
earlier line it was, and whether that one stays, does not matter.

What an edit means depends on the length, so the shorter of two lines says how many they may be
apart: as many that its segments keep the length they have at ``min_chars``.  With 48 characters
and two edits that is one edit from 32 characters on, and none, equal lines only, below.

Equal lines meet through a 128-bit hash, reduced before the shuffle, so a line on every page
is one row per task.  Every distinct line is cut into threshold-plus-one segments; two lines
within the threshold share one of them, near its place.  Segments are indexed by number, content
and the length of their line; the last one is longer where the length asks for it.  A line probes, for every length up to ``threshold`` below its own, the substrings
that can still be that segment when all edits before it and after it are counted
(length-aware, multi-match-aware selection).  Lines that meet another one are fetched, once
each; pairs of them are made where the counts of their letters allow the threshold, which is
part of the join, so the many lines that differ by a word or two from a common one make no
rows.  What is left is verified by a bit-parallel edit distance over the band of
2 * threshold + 1 diagonals.

A null text stays null, an empty one empty; a null id comes after all others.  Rows equal in
id and text are decided alike, both keep the line that counts as first.  A line of any length is
compared whole.  Several texts of one
id are ordered by a hash of the text.  An empty table gives an empty result.  Columns may have
any names; those not named here are carried along only when asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import stage

#: Edits up to which two lines count as the same.
THRESHOLD = 2
#: Shorter lines are compared on demand, up to fewer edits: segments of ``threshold`` edits would
#: be too short to tell them apart.
MIN_CHARS = 48

#: Classes of letters that are counted to tell lines apart before their texts are compared.
LETTERS = [*"etaoinsrhldu", "cmEAO", "pgbfTSI", "vkwyjxqz", " ", ".,;:!?"]

def index_places(threshold: int) -> list[tuple[int, int, int]]:
    """The segments of a line: their number, from 1, and nothing else."""
    return [(i, 0, 0) for i in range(1, threshold + 2)]


def probe_places(threshold: int) -> list[tuple[int, int, int]]:
    """The substrings that can be a segment of a line no longer than this one: the number of the
    segment, how much shorter that line is, and how far the substring is moved from the place
    the segment has in it."""
    parts, places = threshold + 1, []
    for shorter in range(threshold + 1):
        for i in range(1, parts + 1):
            low = max(-(i - 1), shorter - (parts - i))
            high = min(i - 1, shorter + (parts - i))
            places += [(i, shorter, shift) for shift in range(low, high + 1)]
    return places


def segment_sizes(length: Column, bands: list[tuple[int, int, int]]) -> dict[str, Column]:
    """Columns that keys are made from: the size of the segments of a line so much shorter.  They
    are worked out first, for the code of all keys has to be short enough to be compiled."""
    return {
        f"base_{edits}_{shorter}": F.floor((length - shorter) / (edits + 1)).cast("int")
        for edits, *_ in bands
        for shorter in range(edits + 1)
    }


def boundary_cuts(
    line: Column, length: Column, bands: list[tuple[int, int, int]]
) -> Iterator[dict[str, Column]]:
    """Columns to be added in turn, up to ``cut_<edits>_<k>_<n>``: where in its bytes a line can
    be cut about the end of segment k, from ``2 * k`` characters before it (n = 0) to ``k`` after.

    Substrings by character are counted from the start of a line, so the keys are cut from its
    bytes: only the way to each boundary is counted, and not that where characters are bytes.
    """
    boundaries = [(*band, k, f"{band[0]}_{k}") for band in bands for k in range(1, band[0] + 1)]
    yield {"bytes": line.cast("binary")}
    # Segments of one character leave no room before: then fewer are counted from the start.
    yield {
        f"from_{name}": k * F.col(f"base_{edits}_0") - 2 * k
        for edits, _, _, k, name in boundaries
    }
    plain, leads, near, cuts = F.octet_length(line) == length, {}, {}, {}
    for edits, least, stop, k, name in boundaries:
        start = F.greatest(F.col(f"from_{name}"), F.lit(0))
        used = (length >= least) & (length < stop + edits)
        counted = F.octet_length(F.substring(line, F.lit(1), start))
        leads[f"lead_{name}"] = F.when(plain, start).when(used, counted).otherwise(0)
        # A character has four bytes at most.
        lead = F.col(f"lead_{name}")
        near[f"near_{name}"] = F.substring(F.col("bytes"), lead + 1, F.lit(12 * k)).cast("string")
        for n in range(3 * k + 1):
            size = F.least(F.col(f"from_{name}"), F.lit(0)) + n
            step = F.octet_length(F.substring(F.col(f"near_{name}"), F.lit(1), size))
            cuts[f"cut_{name}_{n}"] = lead + step
    yield from (leads, near, cuts)


def place_keys(
    length: Column, places: list[tuple[int, int, int]], threshold: int, band: int
) -> Column:
    """A hash of the substring at every place, of the length of the line it is looked for in and
    of the segment's number; the last segment has what the others leave."""

    def cut(k, shorter, shift):
        if k == 0:
            return F.lit(0)
        if k > threshold:
            return F.octet_length("bytes")
        at = F.col(f"cut_{threshold}_{k}_{2 * k + shift}")
        if shorter == 0:
            return at
        # Segments of the shorter line are as long as this one's, or shorter by one.
        same = F.col(f"base_{threshold}_{shorter}") == F.col(f"base_{threshold}_0")
        return F.when(same, at).otherwise(F.col(f"cut_{threshold}_{k}_{k + shift}"))

    keys = []
    for i, shorter, shift in places:
        start = cut(i - 1, shorter, shift)
        part = F.substring(F.col("bytes"), start + 1, cut(i, shorter, shift) - start)
        keys.append(F.xxhash64(F.lit(1000 * band + i), length - shorter, part))
    return F.array(*keys)


def edit_bands(threshold: int, min_chars: int, short_lines: bool) -> list[tuple[int, int, int]]:
    """Edits, least length and length to stop before, for the lines that allow any edit."""
    whole = [(threshold, min_chars, 1 << 31)]
    if not short_lines:
        return whole
    size = max(1, min_chars // (threshold + 1))
    tops = {threshold - 1: min_chars}  # the band below ends where whole lines begin
    return whole + [
        (edits, size * (edits + 1), tops.get(edits, size * (edits + 2)))
        for edits in range(threshold - 1, 0, -1)
    ]


def line_keys(length: Column, bands: list[tuple[int, int, int]]) -> tuple[Column, Column]:
    """The number of index keys, and an array of those and of further probes.  A line is indexed
    in the band of its own length and probes every band that has lines it may be close to.  A
    line that repeats itself may have a key twice."""
    none = F.array().cast("array<bigint>")
    count, keys = F.lit(0), []
    for band, (edits, least, stop) in enumerate(bands):
        index, probes = index_places(edits), probe_places(edits)
        further = [place for place in probes if place not in index]
        inside = (length >= least) & (length < stop)
        count = F.when(inside, edits + 1).otherwise(count)
        found = F.when(inside, place_keys(length, index + further, edits, band))
        if band:  # lines of the band above that are longer by a few characters
            beyond = (length >= stop) & (length < stop + edits)
            found = found.when(beyond, place_keys(length, probes, edits, band))
        # Lines beyond a band are indexed in the one above, whose keys stand first.
        keys.append(found.otherwise(none))
    return count, F.concat(*keys)


def letter_counts(line: Column) -> Column:
    """How often each class of letters stands in a line; the last number counts the rest."""
    counts = [F.length(line) - F.length(F.translate(line, c, "")) for c in LETTERS]
    return F.array(*counts, F.length(line) - sum(counts[1:], counts[0]))


def may_be_close(a: Column, b: Column, threshold: int) -> Column:
    """What letter counts allow: an edit moves them by two at most."""
    gaps = [F.abs(F.get(a, F.lit(i)) - F.get(b, F.lit(i))) for i in range(len(LETTERS) + 1)]
    return sum(gaps[1:], gaps[0]) <= 2 * threshold


def _common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix, by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    most = F.least(F.length(a), F.length(b))

    def grow(have, step):
        longer = have + step
        fits = (longer <= most) & (
            F.substring(a, have + 1, step) == F.substring(b, have + 1, step)
        )
        return F.when(fits, longer).otherwise(have)

    return F.aggregate(steps, F.lit(0), grow)


def within_edits(a: Column, b: Column, threshold: int) -> Column:
    """Whether two arrays of characters are at most ``threshold`` edits apart.

    Row e of the state has a bit for every diagonal of the band on which the prefixes read so
    far are within e edits; one step takes the next character of ``b`` against the band of
    ``a`` and moves all diagonals of a row at once.  Rows are kept in one integer.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1
    start = 0
    for e in range(threshold + 1):
        start |= (((1 << (e + 1)) - 1) << threshold) << (e * width)

    def step(state, j):
        char = F.get(b, j)
        met = F.lit(0).cast("long")
        for d in range(width):
            same = F.get(a, j + (d - threshold)).eqNullSafe(char)
            met = met.bitwiseOR(F.when(same, F.lit(1 << d).cast("long")).otherwise(F.lit(0)))
        rows = F.struct(state.alias("old"), met.alias("met"))
        return F.when(state == 0, state).otherwise(
            F.element_at(F.transform(F.array(rows), lambda x: advance(x.old, x.met)), 1)
        )

    def advance(old, met):
        def row(e):
            return F.shiftright(old, e * width).bitwiseAND(F.lit(full))

        new = row(0).bitwiseAND(met)
        packed = new
        for e in range(1, threshold + 1):
            before = row(e - 1)
            new = (
                row(e)
                .bitwiseAND(met)
                .bitwiseOR(before)
                .bitwiseOR(F.shiftright(before, 1))
                .bitwiseOR(F.shiftleft(new, 1).bitwiseAND(F.lit(full)))
            )
            packed = packed.bitwiseOR(F.shiftleft(new, e * width))
        return packed

    last = F.size(b) - 1
    moved = F.when(
        last >= 0, F.aggregate(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), F.lit(start).cast("long"), step)
    ).otherwise(F.lit(start).cast("long"))
    diagonal = F.size(a) - F.size(b) + threshold
    inside = (diagonal >= 0) & (diagonal < width)
    top = F.shiftright(moved, threshold * width)
    return inside & (F.call_function("getbit", top, F.when(inside, diagonal).otherwise(0)) == 1)


def edit_close(a: Column, b: Column, threshold: int) -> Column:
    """Whether two texts are at most ``threshold`` edits apart; what they have in common at
    both ends is cut off first."""
    return F.element_at(
        F.transform(
            F.transform(
                F.transform(
                    F.array(F.struct(a.alias("a"), b.alias("b"))),
                    lambda x: F.struct(
                        x.a.alias("a"), x.b.alias("b"), _common_prefix(x.a, x.b).alias("n")
                    ),
                ),
                lambda x: F.struct(
                    F.reverse(F.substring(x.a, x.n + 1, F.length(x.a))).alias("a"),
                    F.reverse(F.substring(x.b, x.n + 1, F.length(x.b))).alias("b"),
                ),
            ),
            lambda x: _core_close(x.a, x.b, threshold),
        ),
        1,
    )


def _core_close(a: Column, b: Column, threshold: int) -> Column:
    cut = F.transform(
        F.array(F.struct(a.alias("a"), b.alias("b"), _common_prefix(a, b).alias("n"))),
        lambda x: F.struct(
            F.split(F.substring(x.a, x.n + 1, F.length(x.a)), "").alias("a"),
            F.split(F.substring(x.b, x.n + 1, F.length(x.b)), "").alias("b"),
        ),
    )
    return F.element_at(F.transform(cut, lambda x: within_edits(x.a, x.b, threshold)), 1)


def _stage_alone(df: DataFrame, purpose: str) -> DataFrame:
    """The frame staged; the shuffle files of its making go with it, instead of lying beside
    those of what follows until the driver collects its garbage."""
    conf, cleanup = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(cleanup, None)
    conf.set(cleanup, "true")
    try:
        return stage(df, purpose)
    finally:
        if before is None:
            conf.unset(cleanup)
        else:
            conf.set(cleanup, before)


def dedup_lines(
    df: DataFrame,
    threshold: int = THRESHOLD,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    short_lines: bool = False,
) -> DataFrame:
    """Every row with the columns ``keep`` (default: the id), ``n_lines`` (lines that were
    compared), ``n_removed`` and ``text`` without the removed lines."""
    bands = edit_bands(threshold, min_chars, short_lines)

    def compared(line):
        long_enough = F.length(line) >= min_chars
        return long_enough | line.rlike(r"[^ \t-\r]") if short_lines else long_enough

    kept_columns = [id_col] if keep is None else keep
    # A missing id comes after all others, whatever they are.
    keyed = [
        F.col(id_col).isNull().alias("none"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(text_col).alias("of"),
    ]
    text_key = ["none", "id", "of"]
    rows = df.select(*keyed, F.col(text_col).alias("text"))
    lines = (
        rows.select(*text_key, F.posexplode(F.split("text", "\n")).alias("at", "line"))
        .filter(compared(F.col("line")))
        .withColumn("size", F.length("line"))
        .withColumns(segment_sizes(F.col("size"), bands))
    )
    for columns in boundary_cuts(F.col("line"), F.col("size"), bands):
        lines = lines.withColumns(columns)
    first = F.struct(*text_key, "at")
    hashes = [F.xxhash64("line").alias("h"), F.xxhash64(F.lit("second"), "line").alias("g")]
    # One array holds the keys of the index and then those of further probes: the rows of this
    # shuffle are what the join costs most of.
    cut, keys = line_keys(F.col("size"), bands)
    hashed = lines.select(
        *hashes, first.alias("first"), cut.alias("cut"), keys.alias("keys")
    )
    distinct = hashed.groupBy("h", "g").agg(
        F.min("first").alias("first"),
        F.first("cut").alias("cut"),
        F.first("keys").alias("keys"),
    )

    index = F.slice(F.col("keys"), F.lit(1), F.col("cut"))
    own = distinct.select("h", F.explode(index).alias("key"))
    rest = F.slice(F.col("keys"), F.col("cut") + 1, F.size("keys"))
    other = distinct.select("h", F.explode(rest).alias("key"))

    def meeting(left: DataFrame, right: DataFrame) -> DataFrame:
        # Rows that meet another line under their key, each once however many it meets.
        met = (F.col("p.key") == F.col("s.key")) & (F.col("p.h") != F.col("s.h"))
        return left.alias("p").join(right.alias("s"), met, "left_semi")

    # Probes that meet no indexed line are met by none, so the index is held against the others
    # alone; they are shuffled here that both uses read the same rows.
    probes = meeting(other, own).distinct().repartition("h")
    indexed = meeting(own, probes).unionByName(meeting(own, own)).distinct()
    met = _stage_alone(
        indexed.withColumn("indexed", F.lit(True)).unionByName(
            probes.withColumn("indexed", F.lit(False))
        ),
        "line_keys",
    )

    # The texts of those lines are taken from their documents; a node is a line by one hash,
    # and should two lines share it, both are fetched and verified.
    # Nothing is staged from here on, so that the shuffle of texts by document serves both this
    # and the last step.
    placed = distinct.select("h", "g", "first").join(met.select("h").distinct(), "h")
    texts = (
        placed.select("h", "g", "first", "first.*")
        .join(rows, text_key)
        .select("h", "g", "first", F.get(F.split("text", "\n"), F.col("at")).alias("line"))
        .dropDuplicates(["h", "g"])
        .withColumns({"size": F.length("line"), "letters": letter_counts(F.col("line"))})
    )
    probing = met.join(texts, "h")
    fits = (
        (F.col("p.key") == F.col("s.key"))
        & (F.col("p.h") != F.col("s.h"))
        & F.col("s.indexed")
        & (F.col("p.size") - F.col("s.size")).between(0, threshold)
        & may_be_close(F.col("p.letters"), F.col("s.letters"), threshold)
    )
    # A pair that meets under several keys, or either way round, is verified once.
    p_later = F.col("p.first") > F.col("s.first")
    sides = {"later": ("p", "s"), "earlier": ("s", "p")}
    pairs = probing.alias("p").join(probing.alias("s"), fits).select(
        F.least("p.size", "s.size").alias("size"),
        *[
            F.when(p_later, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(f"{side}_{c}")
            for side, (x, y) in sides.items()
            for c in ("h", "g", "line")
        ],
    )
    pairs = pairs.dropDuplicates(["later_h", "later_g", "earlier_h", "earlier_g"])
    close = F.lit(False)
    for edits, least, stop in reversed(bands):  # by the length of the shorter line
        inside = (F.col("size") >= least) & (F.col("size") < stop)
        close = F.when(inside, edit_close(F.col("later_line"), F.col("earlier_line"), edits)).otherwise(close)
    later = pairs.filter(close).select(F.col("later_h").alias("h"), F.col("later_g").alias("g"))
    staying = (
        distinct.select("h", "g", "first")
        .join(later, ["h", "g"], "left_anti")
        .groupBy("first.none", "first.id", "first.of")
        .agg(F.collect_list("first.at").alias("places"))  # of one text
    )
    if kept_columns == [id_col]:
        # The same columns as above, so that the texts are shuffled once for both uses.
        whole, row = rows, F.struct(F.when(~F.col("none"), F.col("id")).alias(id_col))
    else:
        columns, row = [F.col(f"`{c}`") for c in kept_columns], F.col("row")
        whole = df.select(*keyed, F.struct(*columns).alias("row"), F.col(text_col).alias("text"))
    places = F.coalesce("places", F.array().cast("array<int>"))
    left = F.filter(
        "lines", lambda line, at: F.array_contains(places, at) | ~compared(line)
    )
    n_gone = F.size("lines") - F.size("left")
    n_removed = F.when(F.col("lines").isNull(), 0).otherwise(n_gone).cast("long")
    return (
        whole.join(staying, text_key, "left")
        .select(row.alias("row"), places.alias("places"), F.split("text", "\n").alias("lines"))
        .select("row", "places", "lines", left.alias("left"))
        .select(
            "row",
            (F.size("places") + n_removed).alias("n_lines"),
            n_removed.alias("n_removed"),
            F.array_join("left", "\n").alias("text"),
        )
        .select(*[F.col(f"row.`{c}`") for c in kept_columns], "n_lines", "n_removed", "text")
    )
