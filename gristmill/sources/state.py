"""Stored tables as Parquet snapshots with a commit log, and sync state and history beside them.

`<root>/<table>/log/<n>.json` says of version n which folders hold it; an entry is written last and never twice, so a
failed load leaves the old version current, and of two loads that began from one version the later one sees that it
must begin again. A table may be split into hash buckets of its key: a merge then reads, writes and checks for conflicts
only the buckets that its rows fall into. Every path goes through Spark or Hadoop's file systems.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import per_key, stamp, upsert, upsert_counts
from .commits import CommitLog, Conflict, Folder

STATE = (
    "table string, strategy string, status string, started_at timestamp, finished_at timestamp, next_sync_at timestamp, checkpoint string, "
    "fetched long, inserted long, updated long, row_count long, min_id string, max_id string, schema_hash string, version long, error string"
)

#: Runs between two compactions of the history.
COMPACT_RUNS = 64
#: Times a write begins again after a conflict.
RETRIES = 20
_BUCKET = "_bucket"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the folder in spark.checkpoint.dir; on one machine without that setting, a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="gristmill-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    parent, _, name = path.rstrip("/").rpartition("/")
    Folder(spark, parent).delete(name)


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


class Store:
    """Root folder of stored tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self, table: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{table}/log")

    def version(self, table: str) -> int:
        """Number of the current version; 0 if there is none."""
        return self._log(table).head()

    def last_batch(self, table: str) -> int | None:
        """Greatest number of a stream's batch that the current version holds."""
        return (self._log(table).last()[1] or {}).get("batch")

    def commits(self, table: str) -> DataFrame:
        """(version, kind, changed, buckets, batch, at) of the versions that are kept."""
        log = self._log(table)
        rows = [(n, e["kind"], len(e["changed"]), len(e["dirs"]), e["batch"], datetime.fromisoformat(e["at"])) for n in log.numbers() if (e := log.entry(n))]
        return self.spark.createDataFrame(rows, "version long, kind string, changed long, buckets long, batch long, at timestamp")

    def _rows(self, table: str, entry: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        dirs = sorted({d for b, d in entry["dirs"].items() if buckets is None or int(b) in buckets})
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{table}/{d}" for d in dirs)) if dirs else self.spark.createDataFrame([], schema)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        log = self._log(table)
        entry = log.entry(version) if version else log.last()[1]
        if entry is None:
            raise KeyError(table)
        return self._rows(table, entry)

    def rows_of(self, table: str, folders: list[str]) -> DataFrame:
        """Rows of some of the current version's folders."""
        entry = self._log(table).last()[1]
        return self._rows(table, entry | {"dirs": dict(enumerate(folders))})

    def sketches(self, table: str, schema: str) -> DataFrame:
        """What is kept about folders beside the table; nothing at first."""
        names = Folder(self.spark, f"{self.root}/{table}").names("sketches")
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{table}/sketches/{x}" for x in names)) if names else self.spark.createDataFrame([], schema)

    def files(self, table: str) -> dict[int, str]:
        """Folder of each bucket of the current version; a table without buckets has one, 0."""
        entry = self._log(table).last()[1] or {"dirs": {}}
        return {int(b): d for b, d in entry["dirs"].items()}

    def _put(self, table: str, df: DataFrame, layout: dict) -> dict[str, str]:
        """Write rows to a folder of its own; folder of each bucket that has any."""
        name, sort = f"data/{uuid.uuid4().hex}", layout["cluster_by"]
        if layout["n"]:
            key = F.col(f"`{layout['key']}`")
            # Rebalanced: a bucket far larger than the others gets several files.
            df = df.withColumn(_BUCKET, bucket_of(key, layout["n"])).hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET, *sort)
        elif sort:
            df = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
        writer = df.write.partitionBy(_BUCKET) if layout["n"] else df.write
        for c in layout["bloom"]:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.parquet(f"{self.root}/{table}/{name}")
        if not layout["n"]:
            return {"0": name}
        parts = Folder(self.spark, f"{self.root}/{table}").names(name)
        return {x.partition("=")[2]: f"{name}/{x}" for x in parts if x.startswith(f"{_BUCKET}=")}

    def write(self, table: str, df: DataFrame, batch: int | None = None, keep: int | None = None, base: int | None = None, key: str | None = None, buckets: int = 0, cluster_by: list[str] | None = None, bloom: list[str] | None = None) -> int:
        """Write the whole table as a new version and return its number; with `keep`, forget all but the latest ones.

        With `base`, the version that the rows were made from, a version written meanwhile is a Conflict; without it the later
        write wins. `buckets` splits the table by hashes of `key`; `cluster_by` orders its rows over the files, so that row
        groups can be skipped by their ranges, and `bloom` adds Bloom filters on columns. A later merge keeps the layout.
        """
        layout = {"key": key, "n": buckets, "cluster_by": list(cluster_by or []), "bloom": list(bloom or [])}
        log, dirs = self._log(table), self._put(table, df, layout)
        entry = {**layout, "kind": "write", "dirs": dirs, "changed": sorted(dirs), "schema": df.schema.json(), "at": utc_now().isoformat()}
        return self._commit(table, log, entry, batch, keep, base)

    def _commit(self, table: str, log: CommitLog, entry: dict, batch: int | None, keep: int | None, base: int | None) -> int:
        while True:
            n, last = log.last()
            if base is not None and n != base:
                self._drop(table, entry)
                raise Conflict(f"{table}: version {n} was written after version {base}")
            if self._add(table, log, n, last, entry, batch, keep):
                return n + 1

    def _add(self, table: str, log: CommitLog, n: int, last: dict | None, entry: dict, batch: int | None, keep: int | None) -> bool:
        """Take number n + 1, if it is still free."""
        done = [x for x in (batch, (last or {}).get("batch")) if x is not None]
        if not log.commit(n + 1, entry | {"batch": max(done, default=None)}):
            return False
        if keep is not None:
            self.vacuum(table, keep)
        return True

    def _drop(self, table: str, entry: dict) -> None:
        for d in {entry["dirs"][b].split("/_bucket=")[0] for b in entry["changed"] if b in entry["dirs"]}:
            delete_folder(self.spark, f"{self.root}/{table}/{d}")

    def vacuum(self, table: str, keep: int) -> None:
        """Forget all versions but the latest ones, and delete the folders that only those had."""
        log = self._log(table)
        numbers = sorted(log.numbers())
        old, kept = numbers[:-keep], numbers[-keep:]
        entries = {n: e for n in numbers if (e := log.entry(n))}
        used = {d for n in kept if n in entries for d in entries[n]["dirs"].values()}
        gone = {d for n in old if n in entries for d in entries[n]["dirs"].values()} - used
        for d in gone:
            delete_folder(self.spark, f"{self.root}/{table}/{d}")
        log.forget(old)

    def update(self, table: str, build: Callable[[DataFrame | None], DataFrame], batch: int | None = None, keep: int | None = None, **layout) -> int:
        """Write what `build` makes of the current rows (none at first); after a conflict it is built again from the newer ones."""
        for _ in range(RETRIES):
            n, entry = self._log(table).last()
            try:
                return self.write(table, build(self._rows(table, entry) if entry else None), batch, keep, base=n, **layout)
            except Conflict:
                continue
        raise Conflict(f"{table}: {RETRIES} conflicts one after the other")

    def merge(self, table: str, rows: DataFrame, key: str, order: str | None = None, partial: bool = False, batch: int | None = None, keep: int | None = None, counted: bool = False, **layout) -> dict:
        """Upsert a batch (see `operators.merge.upsert`) and return (version, changed, inserted, updated).

        Only the buckets that the batch falls into are read, merged and written; the others keep their files. A commit
        of another writer in between is a conflict only if it changed one of these buckets, else the finished files are
        committed on top of it. The first batch creates the table, in the layout given. `counted` works the counts out.
        """
        for _ in range(RETRIES):
            log = self._log(table)
            n, entry = log.last()
            if entry is None:
                first = stamp(per_key(rows, key, order), version=F.col("_rows"), partial=partial).drop("_rows")
                try:
                    version = self.write(table, first, batch, keep, base=0, key=key, **layout)
                except Conflict:
                    continue
                return {"version": version, "changed": sorted(map(int, self.files(table))), "inserted": self.read(table).count() if counted else None, "updated": 0 if counted else None}
            at = bucket_of(F.col(f"`{key}`"), entry["n"]) if entry["n"] else F.lit(0)
            touched = sorted(r.b for r in rows.select(at.alias("b")).distinct().collect())
            old = self._rows(table, entry, touched)
            old = old.drop("_rows") if "_rows" in old.columns else old
            counts = upsert_counts(old, rows, key).first() if counted else None
            merged = upsert(old, rows, key, order, partial)
            dirs = self._put(table, merged, entry) if touched else {}
            new = entry | {"kind": "merge", "dirs": entry["dirs"] | dirs, "changed": sorted(dirs), "schema": merged.schema.json(), "at": utc_now().isoformat()}
            if (version := self._rebased(table, log, n, new, dirs, batch, keep)) is not None:
                return {"version": version, "changed": touched, "inserted": counts and counts.inserted, "updated": counts and counts.updated}
        raise Conflict(f"{table}: {RETRIES} conflicts one after the other")

    def _rebased(self, table: str, log: CommitLog, base: int, entry: dict, dirs: dict[str, str], batch: int | None, keep: int | None) -> int | None:
        """Commit changed buckets on top of what others have committed since `base`; nothing if they changed the same ones."""
        while True:
            head = log.head()
            since = [log.entry(n) for n in range(base + 1, head + 1)]
            if any(e is None or e["kind"] != "merge" or e["schema"] != entry["schema"] or set(e["changed"]) & set(dirs) for e in since):
                self._drop(table, entry)
                return None
            last = since[-1] if since else entry
            if self._add(table, log, head, last, entry | {"dirs": last["dirs"] | dirs}, batch, keep):
                return head + 1

    def record(self, **row) -> None:
        """Add a run to the history. Every COMPACT_RUNS runs the history is written as one folder."""
        names = [part.split()[0] for part in STATE.split(", ")]
        entry = {n: v.isoformat() if isinstance(v := row.get(n), datetime) else v for n in names}
        n = self._history().append(entry)
        if n % COMPACT_RUNS == 0:
            self.compact_history(n)

    def _history(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/_history")

    def compact_history(self, upto: int) -> None:
        """Write the runs up to a number to one folder; entries and folders that the folder before replaced are deleted.

        A reader that has listed the old files can still read them.
        """
        log = self._history()
        draft = f".{uuid.uuid4().hex}"
        self.runs(upto).coalesce(1).write.parquet(f"{self.root}/_history/{draft}")
        if log.folder.rename(draft, f"runs-{upto:020d}"):
            before = sorted(x for x in log.folder.names() if x.startswith("runs-") and x < f"runs-{upto:020d}")
            for x in before[:-1]:
                log.folder.delete(x)
            if before:
                log.forget([n for n in log.numbers() if n <= int(before[-1][5:])])

    def runs(self, upto: int | None = None) -> DataFrame:
        """All runs: the last folder of compacted ones, and the entries after it."""
        log = self._history()
        names = log.folder.names()
        folders = [x for x in names if x.startswith("runs-") and (upto is None or int(x[5:]) <= upto)]
        done = int(folders[-1][5:]) if folders else 0
        tail = [x for x in names if x.endswith(".json") and not x.startswith(".") and done < int(x[:20]) <= (upto or 10**19)]
        out = self.spark.read.schema(STATE).parquet(f"{self.root}/_history/{folders[-1]}") if folders else self.spark.createDataFrame([], STATE)
        return out.unionByName(self.spark.read.schema(STATE).json([f"{self.root}/_history/{x}" for x in tail])) if tail else out

    def history(self, last: int = 100) -> DataFrame:
        return self.runs().orderBy(F.col("started_at").desc(), "table").limit(last)

    def state(self) -> DataFrame:
        """Latest run of each table, its totals, and the checkpoint of the last run that had one."""
        return sync_state(self.runs())


def bucket_of(key, n: int):
    """Bucket of a key; rows without one share a bucket."""
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def sync_state(history: DataFrame) -> DataFrame:
    last = F.max_by(F.struct(*(F.col(c) for c in history.columns if c != "table")), F.struct("started_at", "finished_at"))
    done = F.col("status") == "completed"
    by = history.groupBy("table").agg(
        last.alias("r"),
        F.max_by(F.when(done, F.col("checkpoint")), F.when(done & F.col("checkpoint").isNotNull(), F.col("started_at"))).alias("last_checkpoint"),
        F.count_if(done).alias("total_syncs"),
        F.count_if(F.col("status") == "failed").alias("failed_syncs"),
        F.max_by("error", F.when(F.col("status") == "failed", F.col("started_at"))).alias("last_error"),
    )
    return by.select("table", "r.*", "last_checkpoint", "total_syncs", "failed_syncs", "last_error")


def sync_status(state: DataFrame, now) -> DataFrame:
    """(table, freshness): stale if the next load was due, fresh if it is still to come, unknown without one."""
    due = F.col("next_sync_at")
    kind = F.when(due.isNull(), "unknown").when(due < F.lit(now), "stale").otherwise("fresh")
    return state.select("table", kind.alias("freshness"))


def sync_totals(state: DataFrame) -> DataFrame:
    return state.agg(F.count("*").alias("tables"), F.sum("row_count").alias("rows"), F.sum("total_syncs").alias("syncs"), F.sum("failed_syncs").alias("failures"))
