"""Landing logs: append-only batches of a stream over a compacted base, resolved by the readers.

A log lies in ``<table>_log`` beside its table's folder, out of the way of batch writers, which
insert there or replace what they inserted. Each checkpoint that has ever written to it has a *run* of its own; the run's name is kept
in the checkpoint, so a restart goes on in its run, and a new or emptied checkpoint opens a new
one instead of taking its batches for batches that have been written::

    <table>_log/run=<id>/batch=<n>/verdict=ok|bad/*.parquet    one folder for each micro-batch
    <table>_log/base-<version>-<id>/*.parquet                  one row for each key, bucketed by the key
    <table>_log/bad-<version>-<id>/*.parquet                   refused messages of folded batches
    <table>_log/manifest/<version>.json                        which of these are to be read

A batch counts once its folder is complete, and a batch that is delivered again finds it complete
and writes nothing. It reads and writes its own rows only. Every row keeps its place in the
source, and all rows, of whatever run and batch, are resolved by one total order: broker time,
partition, offset. So the result does not depend on where batches were cut.

:func:`compact` folds finished batches into the base: a key's rows become its state, what a reader
would make of them, with the positions that decide over rows still to come. A new manifest swaps
base and remaining batches in one step. What the manifest before it names stays on disk, so a
reader that began earlier finds all its files. Copies that lost are not kept in a base.

Readers join the state of the batches since then to the base. The base is bucketed by key into as
many files as the join has partitions, so only the new rows are shuffled.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwake.operators.writes import key_states, merge_states, resolve_upserts, tag_new
from ledgerwake.schemas import INTEGER, LONG, STRING, ZONED, RawTable, record
from ledgerwake.session import settings
from ledgerwake.sources import files

# Folder names a stream sorts rows into.
OK, BAD = "ok", "bad"
POSITION = ["partition", "offset"]
ORDER = ["kafka_timestamp", *POSITION]
LOG, _RUN = "_log", "_run"  # the first is put behind the name of a table's folder
PLACES = record(kafka_timestamp=ZONED, partition=INTEGER, offset=LONG)
REFUSED = record(partition=INTEGER, offset=LONG, kafka_timestamp=ZONED, payload=STRING,
                 violation=STRING)
DATABASE = "ledgerwake_bases"
# Instants in 64 bits instead of 96, and one open file for each verdict instead of a sort by it.
STORED = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
          "spark.sql.maxConcurrentOutputFileWriters": "2"}
# Rows a bucket of the base should hold, and segments of refused messages before they are merged.
BUCKET_ROWS = 2_000_000
BAD_SEGMENTS = 16


@dataclass(frozen=True)
class Manifest:
    """What of a log has been folded, and into what."""

    version: int = 0
    base: str | None = None
    buckets: int = 1
    rows: int = 0
    bad: Sequence[str] = ()
    # For each run the last batch that has been folded, and the messages it had by then.
    folded: dict[str, list[int]] = field(default_factory=dict)


@dataclass(frozen=True)
class Batch:
    run: str
    number: int
    path: str
    verdicts: tuple[str, ...]


def stored(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None before the first write."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        found = reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    # With a schema, Spark takes a folder without files for an empty table.
    return found if schema is None or found.inputFiles() else None


def run_folder(spark: SparkSession, path: str, checkpoint: str) -> str:
    """The folder below ``path`` that belongs to ``checkpoint``, named before it is used."""
    mark = stored(spark, f"{checkpoint}/{_RUN}")
    if mark is None:
        spark.range(1).select(F.lit(uuid.uuid4().hex).alias("run")).write.mode(
            "overwrite").parquet(f"{checkpoint}/{_RUN}")
        mark = stored(spark, f"{checkpoint}/{_RUN}")
    return f"{path}{LOG}/run={mark.first().run}"


def write_batch(batch: DataFrame, folder: str, number: int) -> None:
    """Land one micro-batch; nothing happens if it has landed before."""
    spark, path = batch.sparkSession, f"{folder}/batch={number:012d}"
    if not files.exists(spark, f"{path}/_SUCCESS"):
        with settings(spark, STORED):
            batch.write.mode("overwrite").option("compression", "zstd").partitionBy(
                "verdict").parquet(path)


def manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest; of a log that was never compacted, an empty one."""
    return _manifests(spark, path)[0]


def batches(spark: SparkSession, path: str) -> list[Batch]:
    """All complete batches on disk, folded or not."""
    verdicts: dict[str, list[str]] = {}
    for folder in files.matching(spark, f"{path}{LOG}/run=*/batch=*/verdict=*"):
        where, name = folder.rsplit("/verdict=", 1)
        verdicts.setdefault(where, []).append(name)
    found = []
    for mark in files.matching(spark, f"{path}{LOG}/run=*/batch=*/_SUCCESS"):
        where = mark.removesuffix("/_SUCCESS")
        run, number = re.search(r"/run=([^/]+)/batch=(\d+)$", where).groups()
        found.append(Batch(run, int(number), where, tuple(verdicts.get(where, ()))))
    return found


def runs(spark: SparkSession, path: str) -> list[str]:
    """Names of all runs that have landed something: one for each checkpoint, not each batch."""
    return sorted({b.run for b in batches(spark, path)} | manifest(spark, path).folded.keys())


def _tail(spark: SparkSession, path: str, known: Manifest) -> list[Batch]:
    """Complete batches that the manifest does not count as folded."""
    return [b for b in batches(spark, path) if b.number > known.folded.get(b.run, [-1])[0]]


def unfolded(spark: SparkSession, path: str) -> int:
    """Number of batches a compaction would fold."""
    return len(_tail(spark, path, manifest(spark, path)))


def _read(spark: SparkSession, tail: list[Batch], verdict: str,
          schema: T.StructType) -> DataFrame | None:
    paths = [f"{b.path}/verdict={verdict}" for b in tail if verdict in b.verdicts]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def _placed(table: RawTable) -> T.StructType:
    return T.StructType([*table.schema.fields, *PLACES.fields])


def _state_schema(table: RawTable) -> T.StructType:
    last = [T.StructField(f"last_{f.name}", f.dataType) for f in PLACES] * bool(table.overwritten)
    return T.StructType([*_placed(table).fields, *last])


def base_table(spark: SparkSession, known: Manifest, table: RawTable) -> DataFrame | None:
    """The base as a table that Spark knows to be bucketed; the files hold all there is of it."""
    if known.base is None:
        return None
    name = _base_name(known.base)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _state_schema(table))
    key = ", ".join(f"`{c}`" for c in table.key)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {known.buckets} BUCKETS "
              f"LOCATION '{known.base}'")
    return spark.table(name)


def _base_name(base: str) -> str:
    return f"{DATABASE}.{base.rsplit('/', 1)[1].replace('-', '_')}"


def inserted(spark: SparkSession, path: str, table: RawTable) -> DataFrame | None:
    """Rows that batch writers put into the table's folder, or None if there are none."""
    found = stored(spark, path, table.schema)
    return None if found is None else found.select(*table.columns)


def _rows(spark: SparkSession, path: str, table: RawTable, tail: list[Batch]) -> DataFrame:
    """Accepted rows of some batches with their position, behind what batch writers inserted.

    The latter have no position, which orders them before all others.
    """
    empty = spark.createDataFrame([], _placed(table))
    rows = _read(spark, tail, OK, _placed(table))
    by_batch = inserted(spark, path, table)
    if by_batch is None:
        return empty if rows is None else rows
    before = by_batch.withColumns({f.name: F.lit(None).cast(f.dataType) for f in PLACES})
    return before if rows is None else before.unionByName(rows)


def _states(spark: SparkSession, path: str, table: RawTable, known: Manifest,
            rows: DataFrame) -> DataFrame:
    fresh = key_states(rows, table.key, ORDER, table.overwritten)
    base = base_table(spark, known, table)
    if base is None:
        return fresh
    # One row for each new key. Dealt like the base, as Spark would else deal both anew where the
    # base has fewer buckets than a shuffle has partitions.
    dealt = fresh.repartition(known.buckets, *table.key)
    return merge_states(base, dealt, table.key, ORDER, table.overwritten)


def resolved(spark: SparkSession, path: str, table: RawTable) -> DataFrame:
    """One row for each key: of its first row, but the newest ``overwritten`` columns."""
    known = manifest(spark, path)
    tail = _tail(spark, path, known)
    rows = _rows(spark, path, table, tail)
    if known.base is None:
        return resolve_upserts(rows, table.key, ORDER, table.overwritten).select(*table.columns)
    if _is_base(spark, path, table, known, tail):
        return base_table(spark, known, table).select(*table.columns)
    if not table.overwritten and _outweighs(spark, path, known, tail):
        # Both are dealt out by key once, instead of the tail twice. At one place the base counts.
        whole = base_table(spark, known, table).withColumn("_new", F.lit(False)).unionByName(
            rows.withColumn("_new", F.lit(True)))
        return resolve_upserts(whole, table.key, [*ORDER, "_new"], ()).select(*table.columns)
    return _states(spark, path, table, known, rows).select(*table.columns)


def is_base(spark: SparkSession, path: str, table: RawTable) -> bool:
    """Whether the base holds all there is, so that a reader has nothing to resolve."""
    known = manifest(spark, path)
    return _is_base(spark, path, table, known, _tail(spark, path, known))


def _is_base(spark: SparkSession, path: str, table: RawTable, known: Manifest,
             tail: list[Batch]) -> bool:
    return known.base is not None and inserted(spark, path, table) is None and not any(
        OK in b.verdicts for b in tail)


def _outweighs(spark: SparkSession, path: str, known: Manifest, tail: list[Batch]) -> bool:
    """Whether there is much more to resolve than the base holds."""
    fresh = [f"{b.path}/verdict={OK}" for b in tail if OK in b.verdicts]
    fresh += [path] if files.exists(spark, path) else []
    return sum(files.size(spark, place) for place in fresh) > 2 * files.size(spark, known.base)


def log(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the batches not yet folded, good and bad, or None if there are none."""
    tail = [b.path for b in _tail(spark, path, manifest(spark, path)) if b.verdicts]
    if not tail:
        return None
    return spark.read.option("basePath", f"{path}{LOG}").parquet(*tail)


def _accepted(spark: SparkSession, path: str, table: RawTable) -> DataFrame:
    known = manifest(spark, path)
    rows = _rows(spark, path, table, _tail(spark, path, known))
    base = base_table(spark, known, table)
    return rows if base is None else base.select(*rows.columns).unionByName(rows)


def landed(spark: SparkSession, path: str, table: RawTable) -> DataFrame:
    """Every accepted row, copies of a key included as long as their batches are not folded."""
    return _accepted(spark, path, table).select(*table.columns)


def tagged(spark: SparkSession, path: str, table: RawTable) -> DataFrame:
    """The rows of :func:`landed` with ``is_new``; false for a row whose key had arrived before."""
    rows = _accepted(spark, path, table)
    return tag_new(rows.limit(0), rows, table.key, ORDER)


def mark(spark: SparkSession, path: str) -> dict[str, int]:
    """The last complete batch of each run; whoever reads the log later has seen these."""
    known = manifest(spark, path)
    found = {run: last for run, (last, _) in known.folded.items()}
    for b in batches(spark, path):
        found[b.run] = max(found.get(b.run, -1), b.number)
    return found


def changed(spark: SparkSession, path: str, table: RawTable, since: dict[str, int]) -> DataFrame:
    """All versions, old and new, of each key with an accepted row behind a mark.

    They come from the newest base that holds nothing from behind the mark and all batches since.
    Those are kept for one compaction after the mark; after two the log has to be read as a whole.
    What batch writers inserted has no mark and is not seen here.
    """
    known = next((m for m in _manifests(spark, path) if all(
        last <= since.get(run, -1) for run, (last, _) in m.folded.items())), None)
    if known is None:
        raise ValueError(f"{path}: rows behind the mark have been folded and deleted")
    tail = _tail(spark, path, known)
    fresh = _read(spark, [b for b in tail if b.number > since.get(b.run, -1)], OK, _placed(table))
    if fresh is None:
        return spark.createDataFrame([], table.schema)
    keys = fresh.select(*table.key).distinct()
    versions = _read(spark, tail, OK, _placed(table)).select(*table.columns)
    base = base_table(spark, known, table)
    if base is not None:
        versions = versions.unionByName(base.select(*table.columns))
    return versions.join(keys, list(table.key), "left_semi").select(*table.columns)


def _manifests(spark: SparkSession, path: str) -> list[Manifest]:
    """Manifests whose files are all there, newest first: the last two."""
    found = files.matching(spark, f"{path}{LOG}/manifest/*.json")[::-1]
    every = [Manifest(**json.loads(files.read_text(spark, name))) for name in found]
    return every + ([Manifest()] if len(every) < 2 and (
        not every or every[0].version == 1) else [])


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """Refused messages with payload, position and the constraint they broke."""
    known = manifest(spark, path)
    tail = _tail(spark, path, known)
    if not tail and not known.folded:
        raise ValueError(f"nothing has landed at {path}")
    rows = _read(spark, tail, BAD, REFUSED)
    folded = spark.read.schema(REFUSED).parquet(*known.bad) if known.bad else None
    found = [df for df in (folded, rows) if df is not None]
    found = found or [spark.createDataFrame([], REFUSED)]
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def rows_landed(spark: SparkSession, path: str, checkpoint: str) -> int:
    """Messages a checkpoint has taken in so far; each has landed once, as good or bad."""
    mark = stored(spark, f"{checkpoint}/{_RUN}")
    if mark is None:
        return 0
    run, known = mark.first().run, manifest(spark, path)
    fresh = _counts(spark, path, [b for b in _tail(spark, path, known) if b.run == run])
    return known.folded.get(run, [0, 0])[1] + fresh.get(run, 0)


def _counts(spark: SparkSession, path: str, tail: list[Batch]) -> dict[str, int]:
    paths = [b.path for b in tail if b.verdicts]
    if not paths:
        return {}
    rows = spark.read.option("basePath", f"{path}{LOG}").schema(
        record(run=STRING, verdict=STRING)).parquet(*paths)
    each = rows.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    return each.agg(F.map_from_entries(F.collect_list(F.struct("run", "n")))).first()[0]


def compact(spark: SparkSession, path: str, table: RawTable,
            bucket_rows: int = BUCKET_ROWS) -> Manifest:
    """Fold all complete batches into a new base, swap it in, and delete what no reader needs.

    Streams and readers may go on meanwhile. If another compaction was first, its manifest is
    returned and this one leaves nothing behind.
    """
    known = manifest(spark, path)
    tail = _tail(spark, path, known)
    if not tail:
        return known
    counts = _counts(spark, path, tail)
    version, rows = known.version + 1, _read(spark, tail, OK, _placed(table))
    made = f"{version:012d}-{uuid.uuid4().hex}"
    base, buckets, total = known.base, known.buckets, known.rows
    if rows is not None:
        total += sum(counts.values())  # at most: of copies one stays
        # Doubled, so that a growing base is seldom dealt out anew.
        while buckets * bucket_rows < total:
            buckets *= 2
        base = f"{path}{LOG}/base-{made}"
        total = _write_base(spark, path, table, known, rows, base, buckets)
    folded = dict(known.folded)
    for b in tail:
        last, had = folded.get(b.run, [-1, 0])
        folded[b.run] = [max(last, b.number), had]
    for run, n in counts.items():
        folded[run][1] += n
    bad = _fold_bad(spark, known, tail, f"{path}{LOG}/bad-{made}")
    new = Manifest(version, base, buckets, total, bad, folded)
    if not files.create_text(spark, f"{path}{LOG}/manifest/{version:012d}.json",
                             json.dumps(asdict(new))):
        for folder in {base, *bad} - {known.base, *known.bad}:
            _drop(spark, folder)
        return manifest(spark, path)
    _retire(spark, path, known, new)
    return new


def _write_base(spark: SparkSession, path: str, table: RawTable, known: Manifest,
                rows: DataFrame, base: str, buckets: int) -> int:
    """Write the states of the base before and ``rows`` as buckets and return their number.

    The shuffle that brings the rows of a key together has as many partitions as there are buckets,
    so rows are dealt out once, and a base that does not grow is not dealt out at all.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    fresh = key_states(rows, table.key, ORDER, table.overwritten)
    before = base_table(spark, known, table)
    states = fresh if before is None else merge_states(
        before, fresh, table.key, ORDER, table.overwritten)
    with settings(spark, {**STORED, "spark.sql.shuffle.partitions": str(buckets),
                          "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        states.write.format("parquet").option("compression", "zstd").bucketBy(
            buckets, *table.key).sortBy(*table.key).option("path", base).saveAsTable(
            _base_name(base))
    return spark.table(_base_name(base)).count()


def _fold_bad(spark: SparkSession, known: Manifest, tail: list[Batch],
              folder: str) -> Sequence[str]:
    rows = _read(spark, tail, BAD, REFUSED)
    if rows is None:
        return known.bad
    merge = len(known.bad) + 1 >= BAD_SEGMENTS
    if merge:
        rows = spark.read.schema(REFUSED).parquet(*known.bad).unionByName(rows)
    # Split and merged by size, as few refused messages come in many small files.
    rows.hint("rebalance").write.parquet(folder)
    return (folder,) if merge else (*known.bad, folder)


def _drop(spark: SparkSession, folder: str) -> None:
    if "/base-" in folder:
        spark.sql(f"DROP TABLE IF EXISTS {_base_name(folder)}")
    files.delete(spark, folder)


def _retire(spark: SparkSession, path: str, before: Manifest, now: Manifest) -> None:
    """Delete what neither of the last two manifests names, attempts that failed included."""
    kept = {folder.rsplit("/", 1)[1] for m in (before, now) for folder in (m.base, *m.bad) if folder}
    for folder in files.matching(spark, f"{path}{LOG}/ba[sd]*-*"):
        name = folder.rsplit("/", 1)[1]
        if name not in kept and int(name.split("-")[1]) <= before.version:
            _drop(spark, folder)
    for b in batches(spark, path):
        if b.number <= before.folded.get(b.run, [-1])[0]:
            files.delete(spark, b.path)
    for old in files.matching(spark, f"{path}{LOG}/manifest/*.json"):
        if int(old.rsplit("/", 1)[1].removesuffix(".json")) < before.version:
            files.delete(spark, old)
