"""State of the incremental run, all of it tables keyed by batch id.

    flat/     approach_month=...          the flat table (written by the stream or a backfill)
    start/                                one row: the cursor of the first step, written before it
    rows/     batch_id=N/part=train|test|reject|late   the rows of each batch, split once
    scored/   batch_id=N                  the scored test part
    sources/  batch_id=N                  the flat files that the batch met first
    ledger/   batch_id=N                  one row per finished batch, written last
    merged/   level=L/run=A-B/(rows|scored|sources|ledger)   batches A to B in few files, the ledger written last

A batch exists when its ledger folder is complete, and so does a run. What a failed attempt left behind is
never read, and its retry overwrites it. A batch that exists is never written again.

The names of complete folders are the manifest. MERGE_EVERY batches become a run of level 1, MERGE_EVERY runs of a
level one of the next, and only then are the folders behind it deleted; a folder whose batches a larger complete run
holds is dead whether deleted or not. So a row is written again at most once a level, the levels being the
logarithm of the batches, and a reader opens fewer than MERGE_EVERY folders of each level.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from perigee.functions import day
from perigee.operators.model import LinearModel
from perigee.schema import LEDGER_SCHEMA, MAX_FILE_ROWS, ROWS_SCHEMA, SCORED_SCHEMA, SOURCES_SCHEMA

TRAIN, TEST, REJECT, LATE = "train", "test", "reject", "late"

# Batches, or runs of one level, after which a commit merges them.
MERGE_EVERY = 16

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class StatePaths:
    root: str

    @property
    def flat(self) -> str:
        return f"{self.root}/flat"

    @property
    def rows(self) -> str:
        return f"{self.root}/rows"

    @property
    def scored(self) -> str:
        return f"{self.root}/scored"

    @property
    def sources(self) -> str:
        return f"{self.root}/sources"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def start(self) -> str:
        return f"{self.root}/start"

    @property
    def merged(self) -> str:
        return f"{self.root}/merged"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def of_batch(table: str, batch_id: int) -> str:
    return f"{table}/batch_id={batch_id}"


def shared_root(spark: SparkSession) -> str:
    """A new directory under the shared folder named by spark.checkpoint.dir.

    Only a session on one machine may go without one and gets a folder of its own; on a cluster,
    even one of local processes, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="perigee-")
    return f"{base.rstrip('/')}/perigee-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: they go when the write ends, in a stream started inside when
    the micro-batch does. Otherwise they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, made without the Python workers that createDataFrame starts for its list."""
    fields = StructType.fromDDL(schema).fields
    return spark.range(0).where(F.lit(False)).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in fields))


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _empty(spark, schema)


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    context = spark.sparkContext
    named = context._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(context._jsc.hadoopConfiguration()), named


def _values(spark: SparkSession, path: str, key: str) -> list[str]:
    """The values V of the folders key=V in a folder: a listing of names that opens no file."""
    system, named = _folder(spark, path)
    if not system.exists(named):
        return []
    names = (status.getPath().getName() for status in system.listStatus(named))
    return [name.partition("=")[2] for name in names if name.startswith(f"{key}=")]


def _complete(spark: SparkSession, path: str) -> bool:
    system, named = _folder(spark, f"{path}/_SUCCESS")
    return system.exists(named)


@dataclass(frozen=True, order=True)
class Run:
    """Merged batches, from the first to the last."""

    first: int
    last: int
    level: int

    def folder(self, paths: StatePaths) -> str:
        return f"{paths.merged}/level={self.level}/run={self.first}-{self.last}"


def _runs(spark: SparkSession, paths: StatePaths) -> list[Run]:
    """All complete runs, dead ones included."""
    found = []
    for level in map(int, _values(spark, paths.merged, "level")):
        for name in _values(spark, f"{paths.merged}/level={level}", "run"):
            first, last = map(int, name.split("-"))
            run = Run(first, last, level)
            if _complete(spark, f"{run.folder(paths)}/ledger"):
                found.append(run)
    return found


def live(spark: SparkSession, paths: StatePaths) -> tuple[list[Run], list[int]]:
    """What readers open: the runs that no larger one holds, and the finished batches in none of them, in order."""
    runs = _runs(spark, paths)
    kept = sorted(r for r in runs if not any(o != r and o.first <= r.first and r.last <= o.last and (o.level, o) > (r.level, r) for o in runs))
    batches = sorted(int(n) for n in _values(spark, paths.ledger, "batch_id"))
    alone = [n for n in batches if not any(r.first <= n <= r.last for r in kept) and _complete(spark, of_batch(paths.ledger, n))]
    return kept, alone


def _read_batches(spark: SparkSession, paths: StatePaths, table: str, schema: str, of: tuple[list[Run], list[int]] | None = None) -> DataFrame:
    """A table's rows of finished batches: of the given runs and batches, or all live ones."""
    runs, alone = live(spark, paths) if of is None else of
    rows = []
    if alone:
        rows.append(_read_or_empty(spark, f"{paths.root}/{table}", schema).where(F.col("batch_id").isin(alone)))
    # A run has a folder for each table, though of no files if it has no rows.
    rows += (spark.read.schema(schema).parquet(f"{run.folder(paths)}/{table}") for run in runs)
    return reduce(DataFrame.unionByName, rows) if rows else _empty(spark, schema)


def _write_run(spark: SparkSession, paths: StatePaths, level: int, runs: list[Run], batches: list[int]) -> Run:
    """Puts runs and batches into one run, then deletes their folders."""
    run = Run(min([r.first for r in runs] + batches), max([r.last for r in runs] + batches), level)
    target = run.folder(paths)
    for table, schema, parts in (("rows", ROWS_SCHEMA, ["part"]), ("scored", SCORED_SCHEMA, []), ("sources", SOURCES_SCHEMA, [])):
        rows = _read_batches(spark, paths, table, schema, (runs, batches))
        writer = rows.hint("rebalance", *parts).write.mode("overwrite").option("maxRecordsPerFile", MAX_FILE_ROWS)
        writer.partitionBy(*parts).parquet(f"{target}/{table}")
    _read_batches(spark, paths, "ledger", LEDGER_SCHEMA, (runs, batches)).coalesce(1).write.mode("overwrite").parquet(f"{target}/ledger")
    _clear(spark, paths)
    return run


def _clear(spark: SparkSession, paths: StatePaths) -> None:
    """Deletes what a larger run holds: the ledger of a run or batch first, so that no part of it is read."""
    runs, _ = live(spark, paths)
    for dead in set(_runs(spark, paths)) - set(runs):
        _delete(spark, f"{dead.folder(paths)}/ledger")
        _delete(spark, dead.folder(paths))
    for table in ("ledger", "rows", "scored", "sources"):
        for n in map(int, _values(spark, f"{paths.root}/{table}", "batch_id")):
            if any(r.first <= n <= r.last for r in runs):
                _delete(spark, of_batch(f"{paths.root}/{table}", n))


def merge_levels(spark: SparkSession, paths: StatePaths) -> None:
    """Merges batches, then runs of each level, of which there are MERGE_EVERY or more.

    For the one writer of the state, between two steps. A merge cut short is not read and is done again; readers
    that hold older folders open have to read again.
    """
    runs, alone = live(spark, paths)
    if len(alone) < MERGE_EVERY:
        return
    _write_run(spark, paths, 1, [], alone)
    level = 1
    while len(same := [r for r in live(spark, paths)[0] if r.level == level]) >= MERGE_EVERY:
        _write_run(spark, paths, level + 1, same, [])
        level += 1


def merge(spark: SparkSession, paths: StatePaths) -> int:
    """Puts all finished batches into one run, which writes all of them again; returns the last batch, -1 without one."""
    runs, alone = live(spark, paths)
    if len(runs) + len(alone) > 1 or alone:
        level = 1 + max((r.level for r in runs), default=0)
        return _write_run(spark, paths, level, runs, alone).last
    return runs[0].last if runs else -1


def _delete(spark: SparkSession, path: str) -> None:
    system, named = _folder(spark, path)
    system.delete(named, True)


def read_ledger(spark: SparkSession, paths: StatePaths) -> DataFrame:
    return _read_batches(spark, paths, "ledger", LEDGER_SCHEMA)


def read_sources(spark: SparkSession, paths: StatePaths) -> DataFrame:
    """The flat files that finished batches met."""
    return _read_batches(spark, paths, "sources", SOURCES_SCHEMA)


def read_start(spark: SparkSession, paths: StatePaths, initial: date | None = None) -> date:
    """The cursor of the first step: set once, by the first caller, to `initial` or to yesterday by the session's clock."""
    if not _complete(spark, paths.start):
        value = F.date_sub(F.current_date(), 1) if initial is None else day(initial)
        spark.range(0, 1, 1, 1).select(value.alias("start")).write.mode("overwrite").parquet(paths.start)
    return spark.read.schema("start DATE").parquet(paths.start).first()["start"]


def latest_batch(ledger: DataFrame) -> Row | None:
    """The ledger row with the highest batch id."""
    row = ledger.agg(F.max_by(F.struct(*ledger.columns), "batch_id").alias("latest")).first()
    return row["latest"]


def read_cursor(ledger: DataFrame, initial: date) -> date:
    """The cursor of the latest batch that has one, or the initial one."""
    latest = latest_batch(ledger.where(F.col("cursor_date").isNotNull()))
    return initial if latest is None else latest["cursor_date"]


def commit(spark: SparkSession, paths: StatePaths, batch_id: int, values: dict[str, object]) -> Row:
    """Writes the ledger row, which makes the batch visible; merges once there are enough unmerged ones."""
    fields = [f for f in StructType.fromDDL(LEDGER_SCHEMA).fields if f.name != "batch_id"]
    row = spark.range(0, 1, 1, 1).select(*(_literal(values[f.name], f.dataType).alias(f.name) for f in fields))
    row.write.mode("overwrite").parquet(of_batch(paths.ledger, batch_id))
    if len(_values(spark, paths.ledger, "batch_id")) >= MERGE_EVERY:
        merge_levels(spark, paths)
    return Row(**{f.name: values[f.name] for f in fields}, batch_id=batch_id)


def _literal(value: object, kind: DataType) -> Column:
    return day(value).cast(kind) if isinstance(value, date) else F.lit(value).cast(kind)


def read_model(ledger: DataFrame) -> LinearModel | None:
    """The model of the latest batch that has one."""
    latest = latest_batch(ledger.where(F.col("intercept").isNotNull()))
    return None if latest is None else LinearModel(tuple(latest["coefficients"]), latest["intercept"])


def read_rows(spark: SparkSession, paths: StatePaths, part: str) -> DataFrame:
    return _read_batches(spark, paths, "rows", ROWS_SCHEMA).where(F.col("part") == part)


def read_train(
    spark: SparkSession, paths: StatePaths, before: int | None = None, look_back: int | None = None
) -> DataFrame:
    """Training rows of finished batches: all, those before a batch id, or the `look_back` ids before it."""
    rows = read_rows(spark, paths, TRAIN)
    if before is not None:
        rows = rows.where(F.col("batch_id") < before)
        if look_back is not None:
            rows = rows.where(F.col("batch_id") >= before - look_back)
    return rows


def read_scored(spark: SparkSession, paths: StatePaths, latest_only: bool = False) -> DataFrame:
    """Scored rows of finished batches, or of the latest one."""
    scored = _read_batches(spark, paths, "scored", SCORED_SCHEMA)
    if latest_only:
        latest = latest_batch(read_ledger(spark, paths))
        return scored.where(F.lit(False) if latest is None else F.col("batch_id") == latest["batch_id"])
    return scored
