"""Loads of source tables into the store: full, incremental, on demand."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..failures import FAILURES
from ..functions.predicates import lookup_filter, where_sql
from ..operators.checks import field_mappings, fingerprint
from ..operators.merge import per_key, stamp
from ..operators.mapping import map_positions, named_view, output_names, storage_columns, transform_fields
from ..operators.relational import pick_fields
from .state import Store, utc_now


@dataclass
class SyncConfig:
    """How a table is loaded."""

    table: str
    key: str = "id"
    strategy: str = "full"
    where: str | None = None
    limit: int | None = None
    order_by: str | None = None
    incremental_field: str | None = None
    inclusive: bool = False
    include: list[str] | None = None
    exclude: list[str] = field(default_factory=list)
    ttl: int = 3600
    disabled: bool = False
    #: Hash buckets of the key that the stored table is split into (0: none): merges rewrite only those that they change.
    buckets: int = 0
    #: Columns that order the stored rows, and columns with Bloom filters: scans and single-record reads skip row groups.
    cluster_by: list[str] | None = None
    bloom: list[str] | None = None

    @property
    def layout(self) -> dict:
        return {"key": self.key, "buckets": self.buckets, "cluster_by": self.cluster_by, "bloom": self.bloom}

    def __post_init__(self):
        self.strategy = self.strategy.replace("-", "_")
        if self.strategy not in ("full", "incremental", "on_demand"):
            raise ValueError(f"unknown strategy {self.strategy!r}")
        if self.ttl < 0 or (self.limit is not None and self.limit < 0):
            raise ValueError("ttl and limit can't be negative")
        if self.strategy == "incremental" and not self.incremental_field:
            raise ValueError("an incremental load needs an incremental field")


def source_rows(source: DataFrame, cfg: SyncConfig, where: str | None = None) -> DataFrame:
    """Rows and columns to load: both predicates and the column list reach the scan.

    `limit` is exact, but for incremental loads: these take the first rows by the incremental field, with
    all that tie with the last of them, so that the next load, strictly past the checkpoint, misses none.
    """
    rows = pick_fields(where_sql(where_sql(source, cfg.where), where), cfg.include, cfg.exclude)
    if cfg.limit is None:
        return rows
    if cfg.strategy == "incremental":
        field_ = F.col(f"`{cfg.incremental_field}`")
        return rows.where(field_ <= rows.where(field_.isNotNull()).orderBy(field_).limit(cfg.limit).agg(F.max(field_)).scalar())
    return (rows.orderBy(cfg.order_by or cfg.key) if cfg.order_by or cfg.key in rows.columns else rows).limit(cfg.limit)


def is_due(store: Store, cfg: SyncConfig, force: bool = False) -> bool:
    if cfg.disabled:
        return False
    last = store.state().where(F.col("table") == cfg.table).first()
    return force or last is None or last.status != "completed" or last.next_sync_at is None or last.next_sync_at.timestamp() < utc_now().timestamp()


def _finish(store: Store, cfg: SyncConfig, started, checkpoint, fetched, inserted, updated) -> dict:
    now = store.read(cfg.table)
    figures = now.agg(F.count("*").alias("n"), F.min(cfg.key).cast("string").alias("lo"), F.max(cfg.key).cast("string").alias("hi")).first()
    row = dict(
        table=cfg.table, strategy=cfg.strategy, status="completed", started_at=started, finished_at=utc_now(), next_sync_at=utc_now() + timedelta(seconds=cfg.ttl),
        checkpoint=checkpoint, fetched=fetched, inserted=inserted, updated=updated, row_count=figures.n, min_id=figures.lo, max_id=figures.hi,
        schema_hash=fingerprint(field_mappings(now)).first()[0], version=store.version(cfg.table),
    )
    store.record(**row)
    return row


def sync_full(store: Store, source: DataFrame, cfg: SyncConfig, where: str | None = None, dry_run: bool = False) -> dict:
    """Replace the table: the last row of each key wins. The new snapshot becomes current when it is whole."""
    started, rows = utc_now(), source_rows(source, cfg, where)
    if dry_run:
        return {"table": cfg.table, "strategy": "full", "fetched": rows.count(), "dry_run": True}
    new = stamp(per_key(rows, cfg.key, cfg.incremental_field or cfg.order_by))
    store.write(cfg.table, new, **cfg.layout)
    kept = store.read(cfg.table)
    at = F.max(cfg.incremental_field).cast("string") if cfg.incremental_field else F.lit(None).cast("string")
    found = kept.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("fetched"), F.count("*").alias("n"), at.alias("at")).first()
    return _finish(store, cfg, started, found["at"], found.fetched, found.n, 0)


def sync_incremental(store: Store, source: DataFrame, cfg: SyncConfig, dry_run: bool = False) -> dict:
    """Upsert the rows past the checkpoint; without one a full load. No new rows leave the snapshot as it is.

    The filter is strict, so late rows that tie with the checkpoint are missed unless `inclusive`.
    """
    started, name = utc_now(), cfg.incremental_field
    if name not in source.columns:
        raise ValueError(f"no field {name!r} in {cfg.table}")
    last = store.state().where(F.col("table") == cfg.table).first()
    if last is None or last.last_checkpoint is None or not store.version(cfg.table):
        return sync_full(store, source, cfg, dry_run=dry_run)
    since = F.lit(last.last_checkpoint).cast(source.schema[name].dataType)
    field_ = F.col(name)
    new = source_rows(source.where(field_ >= since if cfg.inclusive else field_ > since), cfg)
    if dry_run:
        return {"table": cfg.table, "strategy": "incremental", "fetched": new.count(), "dry_run": True}
    found = new.agg(F.count("*").alias("n"), F.max(name).cast("string").alias("at")).first()
    if not found.n:
        return _finish(store, cfg, started, last.last_checkpoint, 0, 0, 0)
    done = store.merge(cfg.table, new, cfg.key, name, counted=True)
    return _finish(store, cfg, started, found["at"], found.n, done["inserted"], done["updated"])


def fetch_on_demand(store: Store, source: DataFrame, cfg: SyncConfig, **lookups) -> DataFrame:
    """Rows that match the lookups, from the source; they are merged into the store as partial rows."""
    rows = source_rows(source, cfg).where(lookup_filter(**lookups))
    store.merge(cfg.table, rows, cfg.key, partial=True, **{k: v for k, v in cfg.layout.items() if k != "key"})
    return store.read(cfg.table).drop("_rows").where(lookup_filter(**lookups))


def sync(store: Store, source: DataFrame, cfg: SyncConfig, force: bool = False) -> dict:
    """One load by the table's strategy; a failure is recorded and returned, the old snapshot stays."""
    started = utc_now()
    if not is_due(store, cfg, force):
        return {"table": cfg.table, "status": "disabled" if cfg.disabled else "skipped"}
    if cfg.strategy == "on_demand":
        return {"table": cfg.table, "status": "on_demand"}
    try:
        return {"full": sync_full, "incremental": sync_incremental}[cfg.strategy](store, source, cfg)
    except FAILURES as e:
        row = {"table": cfg.table, "strategy": cfg.strategy, "status": "failed", "started_at": started, "finished_at": utc_now(), "error": f"{type(e).__name__}: {e}"[:1000]}
        store.record(**row)
        return row


def sync_all(store: Store, jobs: list[tuple[Callable[[], DataFrame], SyncConfig]], at_once: int = 3, force: bool = False) -> list[dict]:
    """Many loads, a few at a time; each one's failure is its own, whatever its source raises. A mistake in a load is raised."""

    def one(job):
        try:
            source = job[0]()
        except Exception as e:  # a user's source may fail in any way
            return {"table": job[1].table, "status": "failed", "error": f"{type(e).__name__}: {e}"}
        try:
            return sync(store, source, job[1], force)
        except FAILURES as e:
            return {"table": job[1].table, "status": "failed", "error": f"{type(e).__name__}: {e}"}

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(one, jobs))


def register(store: Store, schema: dict, rows: DataFrame, key: str, strategy: str = "full", ttl: int = 3600, view: str | None = None) -> DataFrame:
    """Store a table of positional rows under its schema in one go, and return the view on it by remote names.

    All positions are stored, described ones converted; the run is recorded and the table's fields go to
    `<table>/fields`. `view` names a temporary view. A key that repeats keeps its greatest row.
    """
    started, table = utc_now(), schema["name"]
    typed = transform_fields(map_positions(rows, schema), schema)
    named = typed.toDF(*_unique(storage_columns(schema), len(typed.columns)))
    at = output_names(schema).index(key) if key in output_names(schema) else named.columns.index(key)
    cfg = SyncConfig(table, key=named.columns[at], ttl=ttl)
    store.write(table, stamp(per_key(named, cfg.key).drop("_rows")))
    field_mappings(store.read(table)).write.mode("overwrite").parquet(f"{store.root}/{table}/fields")
    n = store.read(table).count()
    _finish(store, cfg, started, None, n, n, 0)
    return named_view(store.read(table), schema, view)


def _unique(names: list[str], width: int) -> list[str]:
    return [*names, *(f"Field_{p}" for p in range(len(names), width))]
