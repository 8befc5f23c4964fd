"""The result table: a keyed table published as immutable versions.

Layout under ``root``::

    data/attempt=<version>-<id>/part-*.parquet
    commits/<version>.json          publishes this version and those up to the next commit

A batch is reduced to its newest row per key and written as it is, as a *delta*: what an
``apply`` writes is in proportion to the batch, however large the table.  Its commit names the
folders in force, the base and the deltas since.  Reading finds the newest row per key over
them; ``fold`` writes that as a new base.  Nothing a reader can see is ever changed, so a job
that dies leaves the previous version in force, and an attempt without a commit is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import latest_per_key, orderable
from tidemark.operators.merge import same_keys, union_merge
from tidemark.sources import files
from tidemark.sources.drops import CORRUPT

ATTEMPT = "attempt"

#: Rows of a batch that one task writes, where many batches are written together.
ROWS_PER_FILE = 4_000_000
#: A fold is due beyond so many deltas, or when they make up so much of the base.  A delta below
#: a block of the file system is not worth one.
MAX_DELTAS, MAX_SHARE, LEAST_BYTES = 64, 1 / 4, 128 * 2**20

BATCH_COUNTS = (
    "incoming_rows",
    "rejected_rows",
    "unversioned_rows",
    "malformed_rows",
    "latest_rows",
)
AUDIT_COUNTS = (*BATCH_COUNTS, "existing_rows", "remaining_rows", "final_rows")
_AUDIT_SCHEMA = T.StructType(
    [T.StructField("version", T.LongType()), T.StructField("label", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in AUDIT_COUNTS]
)
_COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("batches", T.ArrayType(T.StructType(_AUDIT_SCHEMA.fields[:7]))),
        T.StructField("folded", T.BooleanType()),
        T.StructField("history", T.ArrayType(_AUDIT_SCHEMA)),
    ]
)


#: Of the newest rows per key, those that a state takes.
_USABLE = "__rejected = 0"


class CommitConflict(RuntimeError):
    """Another writer published the version this one was about to publish."""


class StateTable:
    """A table with one row per key under ``root``.

    ``schema`` lists all stored columns, among them ``keys`` and the ``version`` columns that
    say which of two rows is newer.  ``mode='version'`` keeps the greatest row by ``version``,
    ``tiebreak`` and then the remaining columns, within a batch and across batches alike, so
    the order in which batches arrive does not matter.  ``mode='arrival'`` lets every batch
    replace what is there.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: Sequence[str],
        version: Sequence[str],
        mode: str = "version",
        tiebreak: Sequence[str] = (),
        null_keys: str = "reject",
    ):
        if mode not in ("version", "arrival"):
            raise ValueError(f"mode must be 'version' or 'arrival', not {mode!r}")
        if null_keys not in ("reject", "match"):
            raise ValueError(f"null_keys must be 'reject' or 'match', not {null_keys!r}")
        if not keys:
            raise ValueError("a state needs key columns")
        if mode == "version" and not version:
            raise ValueError("mode='version' needs version columns")
        if unknown := {*keys, *version, *tiebreak}.difference(schema.names):
            raise ValueError(f"not in the schema: {sorted(unknown)}")
        if ATTEMPT in schema.names:
            raise ValueError(f"column name used by the state itself: {ATTEMPT!r}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.version = list(version)
        self.mode = mode
        self.tiebreak = list(tiebreak)
        self.null_keys = null_keys

    # -- reading -------------------------------------------------------------------

    def versions(self) -> list[int]:
        """Versions that can be read, ascending: published and not expired."""
        commits = self._numbers("commits")
        if not commits:
            return []
        first = max(self._numbers("expired"), default=commits[0])
        return list(range(first, self._load(commits[-1])["version"] + 1))

    def _numbers(self, folder: str) -> list[int]:
        found = files.names(self.spark, f"{self.root}/{folder}")
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json"))

    def exists(self) -> bool:
        return bool(self._numbers("commits"))

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of ``version`` (default: the newest).

        Where the deltas are small beside the base, rows of the base whose key is in no delta
        pass as they are and the others meet the deltas.  Their keys are broadcast by Catalyst,
        so the base is not shuffled, at the price of a second scan.  Otherwise base and deltas
        go through one grouping, with one scan and one shuffle of either.
        """
        head = self._commit(version)
        if head is None:
            return self.spark.createDataFrame([], self.schema)
        base, *deltas = head["parts"]
        if not deltas:
            return self._scan([base]).select(*self._columns())
        if self._much_is_new(head):
            return self._newest(self._scan(head["parts"]))
        old, new = self._scan([base]), self._scan(deltas)
        touched = new.select(*self._key_columns()).distinct()
        same = same_keys(self.keys, self.null_keys == "match")
        untouched = old.alias("l").join(touched.alias("r"), same, "left_anti")
        met = old.alias("l").join(touched.alias("r"), same, "left_semi")
        return union_merge(untouched.select(*self._columns()), self._newest(union_merge(met, new)))

    def _newest(self, rows: DataFrame) -> DataFrame:
        newest = latest_per_key(rows, self.keys, self._order(), self.tiebreak)
        return newest.select(*self._columns())

    @staticmethod
    def _much_is_new(head: dict) -> bool:
        base, *deltas = head["sizes"]
        return len(deltas) > MAX_DELTAS or sum(deltas) > MAX_SHARE * base

    def fold_due(self) -> bool:
        """Whether reading merges so much that ``fold`` is worth its shuffle."""
        head = self._commit()
        if head is None or not self._much_is_new(head):
            return False
        deltas = head["sizes"][1:]
        return len(deltas) > MAX_DELTAS or sum(deltas) >= LEAST_BYTES

    def _order(self) -> list[str]:
        return self.version if self.mode == "version" else [ATTEMPT]

    def _columns(self) -> list[Column]:
        return [F.col(f"`{name}`") for name in self.schema.names]

    def _key_columns(self) -> list[Column]:
        return [F.col(f"`{name}`") for name in self.keys]

    def _commit(self, version: int | None = None) -> dict | None:
        commits = self._numbers("commits")
        if version is not None and version not in self.versions():
            raise ValueError(f"no version {version} in {self.root}")
        if not commits:
            return None
        head = self._load(max(n for n in commits if version is None or n <= version))
        if version is not None and (later := head["version"] - version):
            head["version"] = version
            head["parts"], head["sizes"] = head["parts"][:-later], head["sizes"][:-later]
        return head

    def _load(self, number: int) -> dict:
        head = json.loads(files.read_text(self.spark, self._commit_path(number)))
        if head["keys"] != self.keys:
            raise ValueError(f"{self.root} was created with keys {head['keys']}")
        return head

    def _commits_of(self, parts: list[str]) -> list[str]:
        """The commits that published them, in their order."""
        commits = self._numbers("commits")
        versions = [int(part.partition("-")[0]) for part in parts]
        numbers = {max(n for n in commits if n <= version) for version in versions}
        return [self._commit_path(n) for n in sorted(numbers)]

    def _commit_path(self, version: int) -> str:
        return f"{self.root}/commits/{version:010d}.json"

    def _scan(self, parts: list[str]) -> DataFrame:
        """Stored columns and ``attempt``, whose text sorts like the version numbers."""
        stored = T.StructType([*self.schema.fields, T.StructField(ATTEMPT, T.StringType())])
        data = f"{self.root}/data"
        folders = [f"{data}/{ATTEMPT}={part}" for part in parts]
        return self.spark.read.schema(stored).option("basePath", data).parquet(*folders)

    # -- writing -------------------------------------------------------------------

    def apply(
        self, batch: DataFrame, label: str | None = None, stream: tuple[str, int] | None = None
    ) -> dict[str, int]:
        """Publish ``batch`` as the next version; returns the counts of the batch itself.

        ``batch`` has the columns of the schema (a ``_corrupt_record`` beside them is
        counted and dropped) and may hold many rows per key.  ``stream`` names a stream
        and the number of its micro-batch: one that was already applied is skipped, so
        a stream may repeat its last batch after a failure.
        """
        head = self._commit()
        streams = dict(head["streams"]) if head else {}
        if stream is not None:
            name, number = stream
            if streams.get(name, -1) >= number:
                return {count: head["batches"][-1][count] for count in BATCH_COUNTS}
            streams[name] = number
        version = head["version"] + 1 if head else 0
        attempt = self._attempt(version)
        counts = self._write_latest(batch, f"{self.root}/data/{ATTEMPT}={attempt}")
        parts = [*(head["parts"] if head else []), attempt]
        sizes = [*(head["sizes"] if head else []), self._size(attempt)]
        self._publish(version, label, counts, parts, streams, sizes)
        return counts

    def apply_each(self, batches: DataFrame, by: str, order: Sequence[str]) -> None:
        """Publish one version per value of column ``by``, in the order given, which holds all
        of them: like an ``apply`` for each, but by one pass over ``batches`` and one commit.
        Column ``by`` may be one of the schema's."""
        if not order:
            return
        head = self._commit() or {"version": -1, "parts": [], "sizes": [], "streams": {}}
        first = head["version"] + 1
        attempts = {label: self._attempt(first + i) for i, label in enumerate(order)}
        staged = files.scratch_path(self.spark, "batches")
        rows = batches.withColumn("__batch", F.col(f"`{by}`"))
        self._tallied(rows, ["__batch"]).write.parquet(staged)
        newest = self.spark.read.parquet(staged)
        found = newest.groupBy("__batch").agg(*self._tallies()).collect()  # a row per batch
        counts = {row["__batch"]: {name: row[name] for name in BATCH_COUNTS} for row in found}
        counts = {label: counts.get(label, dict.fromkeys(BATCH_COUNTS, 0)) for label in order}
        names = self.spark.createDataFrame(list(attempts.items()), f"__batch string, {ATTEMPT} string")
        # A batch is a file per so many rows.
        files_each = 1 + max(count["latest_rows"] for count in counts.values()) // ROWS_PER_FILE
        key_hash = F.xxhash64(*self._key_columns())
        data = f"{self.root}/data"
        before = files.total_size(self.spark, data) if head["parts"] else 0
        (
            newest.filter(_USABLE)
            .join(names, "__batch")
            .select(*self._columns(), ATTEMPT)
            .repartition(files.writers(self.spark), ATTEMPT, F.pmod(key_hash, F.lit(files_each)))
            .write.mode("append")
            .partitionBy(ATTEMPT)
            .parquet(data)
        )
        empty = [label for label in order if not counts[label]["latest_rows"]]
        files.make_dirs(self.spark, [f"{data}/{ATTEMPT}={attempts[label]}" for label in empty])
        # Each batch's bytes are its share by rows.
        rows_in = sum(count["latest_rows"] for count in counts.values())
        a_row = (files.total_size(self.spark, data) - before) / max(rows_in, 1)
        sizes = [int(count["latest_rows"] * a_row) for count in counts.values()]
        parts, sizes = [*head["parts"], *attempts.values()], [*head["sizes"], *sizes]
        (label, count), *later = counts.items()
        self._publish(first, label, count, parts, head["streams"], sizes, later=later)

    def fold(self, label: str | None = "fold") -> None:
        """Publish the rows of the newest version as a new base, so that reading need not
        merge the deltas so far.  One shuffle of the table; run it now and then."""
        head = self._commit()
        if head is None or len(head["parts"]) == 1:
            return
        version = head["version"] + 1
        attempt = self._attempt(version)
        history = [row.asDict() for row in self.audit().orderBy("version").collect()]
        self._newest(self._scan(head["parts"])).write.parquet(
            f"{self.root}/data/{ATTEMPT}={attempt}"
        )
        counts = dict.fromkeys(BATCH_COUNTS, 0)
        sizes = [self._size(attempt)]
        self._publish(version, label, counts, [attempt], head["streams"], sizes, history)

    def _attempt(self, version: int) -> str:
        return f"{version:010d}-{uuid.uuid4().hex[:12]}"

    def _size(self, attempt: str) -> int:
        return files.total_size(self.spark, f"{self.root}/data/{ATTEMPT}={attempt}")

    def _write_latest(self, batch: DataFrame, path: str) -> dict[str, int]:
        """Newest row per key of the batch; returns the counts of the batch.

        The batch is read once.  Its counts travel with the rows and are observed in
        the stage that writes them, the only kind of stage whose metrics Spark counts
        once however often a lost executor makes it run tasks again.
        """
        seen = Observation()
        newest = self._tallied(batch).observe(seen, *self._tallies())
        newest.filter(_USABLE).select(*self._columns()).write.parquet(path)
        return dict(seen.get)

    def _tallied(self, batch: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """The newest row per key (and ``by``) with the counts of the rows it stands for."""
        missing, unversioned = F.lit(False), F.lit(False)
        for key in self.keys:
            missing = missing | F.col(f"`{key}`").isNull()
        for name in self.version:
            unversioned = unversioned | F.col(f"`{name}`").isNull()
        corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in batch.columns else F.lit(False)
        typed = batch.select(
            *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields],
            corrupt.alias("__corrupt"),
            *by,
        )
        tally = {
            "__incoming": F.lit(True),
            "__rejected": missing if self.null_keys == "reject" else F.lit(False),
            "__unversioned": unversioned,
            "__malformed": F.col("__corrupt"),
        }
        return latest_per_key(typed, [*by, *self.keys], self.version, self.tiebreak, tally=tally)

    def _tallies(self) -> list[Column]:
        sums = [F.sum(f"__{name.removesuffix('_rows')}") for name in BATCH_COUNTS[:-1]]
        return [
            F.coalesce(s, F.lit(0)).cast("bigint").alias(name)
            for name, s in zip(BATCH_COUNTS, [*sums, F.count_if(F.expr(_USABLE))])
        ]

    def _publish(self, first, label, counts, parts, streams, sizes=(), history=None, later=()):
        """One commit for version ``first`` and, with the labels and counts of ``later``, for
        those that follow it."""
        named = [
            {"version": first + i, "label": label, **counts}
            for i, (label, counts) in enumerate([(label, counts), *later])
        ]
        commit = {
            "version": named[-1]["version"],
            "batches": named,
            "folded": history is not None,
            "history": history or [],
            "keys": self.keys,
            "streams": streams,
            "parts": parts,
            "sizes": list(sizes),
        }
        if not files.create_text(self.spark, self._commit_path(first), json.dumps(commit)):
            raise CommitConflict(f"version {first} of {self.root} is taken")

    # -- looking back --------------------------------------------------------------

    def audit(self) -> DataFrame:
        """One row of counts per published batch.

        What a batch found, replaced and left is worked out here, from the keys and versions
        of the base and the deltas, and not while batches are applied.  A fold keeps the
        counts of the batches before it in its commit.
        """
        head = self._commit()
        if head is None:
            return self.spark.createDataFrame([], _AUDIT_SCHEMA)
        commits = self.spark.read.schema(_COMMIT_SCHEMA).json(self._commits_of(head["parts"]))
        counted = (
            commits.filter(~F.col("folded"))
            .select(F.inline("batches"))
            .join(self._moves(head["parts"]), "version", "left")
        )
        before = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, -1)
        # A window over one row per batch since the last fold.
        existing = F.coalesce(F.sum("fresh").over(before), F.lit(0)) + F.lit(
            self._base_rows(head["parts"])
        )
        fresh, replaced = F.coalesce("fresh", F.lit(0)), F.coalesce("replaced", F.lit(0))
        since = counted.select(
            "version",
            "label",
            *BATCH_COUNTS,
            existing.alias("existing_rows"),
            (existing - replaced).alias("remaining_rows"),
            (existing + fresh).alias("final_rows"),
        )
        earlier = commits.select(F.explode("history").alias("h")).select("h.*")
        return earlier.unionByName(since)

    def _base_rows(self, parts: list[str]) -> int:
        """Rows of a base that a fold made; one that is a batch itself counts as a batch."""
        first = json.loads(files.read_text(self.spark, self._commits_of(parts[:1])[0]))
        return self._scan(parts[:1]).count() if first["folded"] else 0

    def _moves(self, parts: list[str]) -> DataFrame:
        """Per version: keys it was the first to bring, rows it replaced."""
        order = list(dict.fromkeys([*self.version, *self.tiebreak]))
        rest = [f.name for f in self.schema.fields if orderable(f.dataType)]
        compared = dict.fromkeys(n for n in [*order, *rest] if n not in self.keys)
        rank = F.struct(F.lit(0), *[F.col(f"`{n}`") for n in compared])
        if self.mode == "arrival":
            rank = F.col(ATTEMPT)
        rows = self._scan(parts).select(*self._key_columns(), ATTEMPT, rank.alias("__rank"))
        earlier = (
            Window.partitionBy(*self._key_columns())
            .orderBy(ATTEMPT)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        best = F.max("__rank").over(earlier)
        version = F.substring_index(ATTEMPT, "-", 1).cast("bigint")
        return (
            rows.select(version.alias("version"), "__rank", best.alias("__best"))
            .groupBy("version")
            .agg(
                F.count_if(F.col("__best").isNull()).alias("fresh"),
                F.count_if(F.col("__best") <= F.col("__rank")).alias("replaced"),
            )
        )

    def expire(self, keep: int = 2) -> None:
        """Drop the data that none of the ``keep`` newest versions needs; older versions can
        then no longer be read, and are no longer listed.

        Attempts numbered after the oldest version kept may belong to a writer still at
        work and are left alone.
        """
        if keep < 1:
            raise ValueError("keep must be at least 1")
        kept = self.versions()[-keep:]
        if not kept:
            return
        files.create_text(self.spark, f"{self.root}/expired/{kept[0]:010d}.json", "{}")
        needed = {part for version in kept for part in self._commit(version)["parts"]}
        for name in files.names(self.spark, f"{self.root}/data"):
            attempt = name.removeprefix(f"{ATTEMPT}=")
            if not name.startswith(ATTEMPT) or attempt in needed:
                continue
            if int(attempt.partition("-")[0]) <= kept[0]:
                files.delete_tree(self.spark, f"{self.root}/data/{name}")
