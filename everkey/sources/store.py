"""Versioned state and published tables as Parquet.

A run writes into folders of its own, ``<root>/v=N/run=<uuid>``, so two runs never touch each other's files.  A version
counts once ``<root>/commits/N`` exists.  That file is created last and only if it is absent, by the Hadoop file system,
so of two runs from one base the first wins and the other changes nothing.  (Creating a file if absent is one step on HDFS
and on stores with conditional writes.)  It names the folders of which the version is made.

Tables are kept in buckets by hash of id; their number is fixed by the first commit.  A run writes only buckets with a
change, the others stay where they are.  Closed history is only ever added to.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.apply import State, empty_state
from ..schemas import STATE_TABLES

#: Buckets of a table unless the first run says otherwise; a bucket is the least that is written anew.
BUCKETS = 32
BUCKET = "_bucket"
#: The id that a table is bucketed by.  Of history only open rows are; the closed ones are a list of folders.
BUCKETED = {"entities": "entity_id", "variants": "variant_id", "key_history": "variant_id", "name_history": "entity_id"}
HISTORY = ("key_history", "name_history")


@dataclass(frozen=True)
class Commit:
    """``parts``: folder of each bucket by table; ``closed``: folders of closed history by table; ``whole``: of the counters."""

    version: int
    as_of: str
    folder: str
    buckets: int
    parts: dict[str, dict[str, str]]
    closed: dict[str, list[str]]
    whole: dict[str, str]


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    files, folder = _files(spark, path)
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def commits(spark: SparkSession, root: str) -> dict[int, Commit]:
    """All commits that can be read.  One whose writer died in between is no version, but its number is taken."""
    try:
        rows = spark.read.option("wholetext", True).text(f"{root}/commits").collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    found = {}
    for row in rows:
        try:
            made = Commit(**json.loads(row[0]))
        except ValueError:
            continue
        found[made.version] = made
    return found


def current_version(spark: SparkSession, root: str) -> int:
    """The newest committed version, 0 when there is none."""
    return max(commits(spark, root), default=0)


def next_version(spark: SparkSession, root: str) -> int:
    return max((int(name) for name in names(spark, f"{root}/commits") if name.isdigit()), default=0) + 1


def folder_of(spark: SparkSession, root: str, version: int) -> str:
    """The folder of the run that made a version; its payload and published tables are there."""
    return f"{root}/{commits(spark, root)[version].folder}"


def run_folder(version: int) -> str:
    return f"v={version}/run={uuid.uuid4().hex}"


def in_bucket(id_column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_column).cast("bigint")), F.lit(buckets)).cast("int")


def buckets_of(ids: DataFrame, id_column: str, buckets: int) -> list[int]:
    """The buckets that ids fall in: at most as many rows as there are buckets."""
    return sorted(row[0] for row in ids.select(in_bucket(id_column, buckets).alias(BUCKET)).distinct().collect())


def _read(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_part(spark: SparkSession, root: str, commit: Commit | None, name: str, only: list[int] | None = None) -> DataFrame:
    """A table of a version without closed history; with ``only``, some of its buckets."""
    parts = commit.parts[name] if commit else {}
    kept = [f"{root}/{folder}/{name}/{BUCKET}={b}" for b, folder in parts.items() if only is None or int(b) in only]
    return _read(spark, kept, STATE_TABLES[name])


def state_of(spark: SparkSession, root: str, commit: Commit) -> State:
    tables = {name: read_part(spark, root, commit, name) for name in BUCKETED}
    for name in HISTORY:
        closed = [f"{root}/{folder}/{name}_closed" for folder in commit.closed[name]]
        if closed:
            tables[name] = tables[name].unionByName(_read(spark, closed, STATE_TABLES[name]))
    return State(**tables, counters=_read(spark, [f"{root}/{commit.whole['counters']}/counters"], STATE_TABLES["counters"]))


def read_state(spark: SparkSession, root: str, version: int) -> State:
    return empty_state(spark) if version == 0 else state_of(spark, root, commits(spark, root)[version])


def write_part(spark: SparkSession, root: str, folder: str, name: str, table: DataFrame, commit: Commit) -> dict[str, str]:
    """Write the buckets that ``table`` holds whole, and return where every bucket of the next version is."""
    path = f"{root}/{folder}/{name}"
    placed = table.withColumn(BUCKET, in_bucket(BUCKETED[name], commit.buckets))
    # Buckets share tasks where they are small, and have several where they are large.
    placed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
    fresh = [n.split("=")[1] for n in names(spark, path) if n.startswith(f"{BUCKET}=")]
    return commit.parts[name] | {b: folder for b in fresh}


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one; False if there is."""
    files, place = _files(spark, path)
    try:
        out = files.create(place, False)
    except Exception as error:
        if "FileAlreadyExists" in str(error) or files.exists(place):
            return False
        raise
    out.write(text.encode())
    out.close()
    return True


def commit(spark: SparkSession, root: str, made: Commit) -> None:
    if not create(spark, f"{root}/commits/{made.version}", json.dumps(asdict(made), sort_keys=True)):
        raise ValueError(f"version {made.version} has been committed by another run")


def readable(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written there."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def write_section(table: DataFrame, path: str, order: list[Column], rows_per_file: int = 5_000_000) -> None:
    """One published section, in order over files and within them."""
    if order:
        table = table.repartitionByRange(*order).sortWithinPartitions(*order)
    table.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def read_sections(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}
