"""A ledger of landed files: which of them are in a table.

A load takes the files that the ledger doesn't name, writes their rows to a folder of its own number
and only then its page of the ledger, which makes the load count. A load that was interrupted has no
page: its rows are not read, and the next load has the same number and replaces them. So no file is
lost or doubled, whenever a load is repeated or stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.sources.files import exists

PAGE = "path string, length long, modified timestamp, load long"
#: Files that one load takes at most; what is left goes into the next.
MOST_FILES = 100_000


def landed(spark: SparkSession, root: str, names: str = "*") -> DataFrame:
    """The files below ``root``: path, length and time of change. Their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names)
    return files.load(root).select("path", "length", F.col("modificationTime").alias("modified"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The loaded files, each with the number of its load."""
    if not exists(spark, f"{path}/ledger"):
        return spark.createDataFrame([], PAGE)
    return spark.read.schema(PAGE).parquet(f"{path}/ledger")


def pending(spark: SparkSession, root: str, path: str, names: str = "*") -> DataFrame:
    """Landed files that are not in the table."""
    known = read_ledger(spark, path).select("path")
    return landed(spark, root, names).join(known, "path", "left_anti")


def load_pending(
    spark: SparkSession,
    root: str,
    path: str,
    read: Callable[[list[str]], DataFrame],
    names: str = "*",
    most_files: int = MOST_FILES,
) -> list[int]:
    """Load all pending files, oldest first, with ``read`` (paths to rows); returns the numbers of the
    loads. Without pending files nothing is written."""
    done = []
    while True:
        files = pending(spark, root, path, names).orderBy("modified", "path").limit(most_files).collect()
        if not files:
            return done
        number = (read_ledger(spark, path).agg(F.max("load")).first()[0] or 0) + 1
        rows = read([f["path"] for f in files])
        rows.write.mode("overwrite").parquet(f"{path}/rows/load={number}")
        page = spark.createDataFrame([(*f, number) for f in files], PAGE).drop("load").coalesce(1)
        page.write.mode("overwrite").parquet(f"{path}/ledger/load={number}")
        done.append(number)


def read_loaded(spark: SparkSession, path: str) -> DataFrame:
    """The rows of finished loads. Their number is in the column ``load``."""
    loads = [r["load"] for r in read_ledger(spark, path).select("load").distinct().collect()]
    return spark.read.option("basePath", f"{path}/rows").parquet(*(f"{path}/rows/load={n}" for n in sorted(loads)))


def changed(spark: SparkSession, root: str, path: str, names: str = "*") -> DataFrame:
    """Loaded files that were rewritten or are gone since (``now`` is then NULL)."""
    now = landed(spark, root, names).select("path", F.struct("length", "modified").alias("now"))
    known = read_ledger(spark, path).join(now, "path", "left")
    same = F.struct("length", "modified") == F.col("now")
    return known.filter(~F.coalesce(same, F.lit(False)))
