"""CSV export of a finished result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tidemark.sources import files

# How the library writes CSV: quotes doubled inside quotes, blanks kept, whole microseconds
# (Spark's default keeps milliseconds), NULL as nothing and the empty string as "".
CSV_WRITE = {
    "header": "true",
    "lineSep": "\n",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# How it reads it back.  The parser tells a missing value from a quoted empty one, but Spark
# then compares either with ``nullValue``: so that is set to what no field will hold.  Quoted
# line breaks need ``multiLine``, with which a file is read by one task.
CSV_READ = {
    "header": "true",
    "enforceSchema": "false",
    "multiLine": "true",
    "escape": '"',
    "nullValue": "\x00null\x00",
    "emptyValue": "",
}


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Replace ``path`` with CSV files that carry a header.

    The files are written beside ``path`` and swapped in when complete, so ``df`` may
    read ``path`` itself and a failed job leaves the previous export as it was.  The swap is
    two renames, as no file system replaces a folder in one step: a reader in between finds
    nothing there, and after a crash in between the previous export lies beside ``path`` in
    a folder that ends in ``-old``.  Where readers must never miss it, publish a state.

    ``single_file`` is for small reports.  It shuffles into one partition instead of
    coalescing, so that the work above the sink stays parallel and only the writing
    itself is serial.
    """
    spark = df.sparkSession
    target = path.rstrip("/")
    parent, slash, name = target.rpartition("/")
    beside = f"{parent}{slash}_{name}-{uuid.uuid4().hex}"
    rows = df.repartition(1) if single_file else df
    rows.write.mode("errorifexists").options(**CSV_WRITE).csv(f"{beside}-new")
    replaces = files.is_dir(spark, target)
    if replaces:
        files.rename(spark, target, f"{beside}-old")
    try:
        files.rename(spark, f"{beside}-new", target)
    except Exception:
        if replaces:
            files.rename(spark, f"{beside}-old", target)
        raise
    files.delete_tree(spark, f"{beside}-old")
    # The swap happened behind the session's back: forget any cached file listing.
    spark.catalog.refreshByPath(target)
