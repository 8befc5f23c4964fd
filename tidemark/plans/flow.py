"""Per-table steps from a list of specs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.tables import partitioned_write, table_load, validate_row_counts

_STEPS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("passed", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """One table of a flow.

    ``mode='transform'`` applies ``rule`` and writes Parquet under ``target``, one
    folder per value of ``partition_by``.  ``mode='load'`` copies the table: to the
    catalog table ``target``, with its files at ``path`` when given.
    """

    source: str
    target: str
    mode: str
    validate: bool = False
    min_rows: int = 1
    partition_by: str | None = None
    rule: Callable[[DataFrame], DataFrame] | None = None
    path: str | None = None

    def __post_init__(self):
        if self.mode not in ("load", "transform"):
            raise ValueError(f"mode must be 'load' or 'transform', not {self.mode!r}")
        if self.mode == "transform" and not self.partition_by:
            raise ValueError("a transform needs partition_by")


def run_flow(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    read: Callable[[str], DataFrame] | None = None,
) -> DataFrame:
    """Run the specs in order; one row ``source, step, n_rows, passed`` per step run.

    A table that fails validation is not written.  ``read`` turns a source name into a
    DataFrame and defaults to the catalog.  All tables to be validated are counted in
    one job.
    """
    read = read or spark.table
    sources = {spec.source: read(spec.source) for spec in specs}
    checked = [spec for spec in specs if spec.validate]
    counts: dict[str, int] = {}
    if checked:
        found = validate_row_counts({s.source: sources[s.source] for s in checked}, 0)
        counts = {row["table_name"]: row["n_rows"] for row in found.collect()}
    steps = []
    for spec in specs:
        df = sources[spec.source]
        if spec.validate:
            passed = counts[spec.source] >= spec.min_rows
            steps.append((spec.source, "validate", counts[spec.source], passed))
            if not passed:
                continue
        if spec.mode == "transform":
            result = spec.rule(df) if spec.rule else df
            written = partitioned_write(result, spec.target, spec.partition_by)
        else:
            written = table_load(df, spec.target, spec.path)
        steps.append((spec.source, spec.mode, written, True))
    return spark.createDataFrame(steps, _STEPS)
