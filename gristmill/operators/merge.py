"""Keyed merge of a batch into a table, with row versions.

A stored table has its data columns and `_synced_at`, `_sync_version`, `_is_partial`. "Last row wins"
needs an order: the given column, else the whole row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mapping import BOOKKEEPING


def stamp(df: DataFrame, version: Column | int = 1, partial: bool = False, now: Column | None = None) -> DataFrame:
    """Data columns with fresh bookkeeping columns."""
    return df.withColumns({"_synced_at": now if now is not None else F.current_timestamp(), "_sync_version": F.lit(version).cast("long"), "_is_partial": F.lit(partial)})


def per_key(rows: DataFrame, key: str, order: str | None = None, last: bool = True) -> DataFrame:
    """One row per key and the number of rows it had (`_rows`).

    The greatest (or least) in order wins, ties by the whole row; partial aggregation keeps one row
    per key and task, so a hot key isn't gathered. Null keys are rows of their own.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    rank = F.struct(F.col(order).alias("o"), row.alias("r")) if order else F.struct(row.alias("r"))
    pick = (F.max if last else F.min)(rank)
    keyed = rows.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("_key")).agg(pick.alias("_p"), F.count("*").alias("_rows"))
    out = keyed.select("_p.r.*", "_rows")
    return out.unionByName(rows.where(F.col(f"`{key}`").isNull()).withColumn("_rows", F.lit(1).cast("long")))


def _data(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in BOOKKEEPING]


def bulk_insert(target: DataFrame, rows: DataFrame, key: str, on_conflict: str = "REPLACE", order: str | None = None, now: Column | None = None) -> DataFrame:
    """The table after inserting a batch.

    REPLACE: the last row of a key replaces the stored one, version 1 again. IGNORE: stored keys
    stay, the first row of a new key is added. FAIL: any conflict raises before anything is built.
    """
    mode = on_conflict.upper()
    if mode == "FAIL":
        clash = rows.join(target.select(key), key, "left_semi").select(key).union(rows.groupBy(key).count().where("count > 1").select(key))
        found = clash.limit(1).collect()
        if found:
            raise ValueError(f"key exists: {found[0][0]!r}")
        return target.unionByName(stamp(rows, now=now))
    new = per_key(rows, key, order, last=mode == "REPLACE").drop("_rows")
    if mode == "REPLACE":
        return target.join(new.select(key), key, "left_anti").select(*target.columns).unionByName(stamp(new, now=now).select(*target.columns))
    if mode == "IGNORE":
        fresh = new.join(target.select(key), key, "left_anti").select(*rows.columns)
        return target.unionByName(stamp(fresh, now=now).select(*target.columns))
    raise ValueError(on_conflict)


def upsert(target: DataFrame, rows: DataFrame, key: str, order: str | None = None, partial: bool = False, now: Column | None = None) -> DataFrame:
    """The table after a batch: known keys are updated, their version raised once per row; new keys start at 1 per row.

    With `order` the greater of the stored and the incoming row by (order, row) stays, so batches may come in any
    order; without it the incoming row wins. Columns that the batch lacks stay as stored (null for new
    keys). One full outer join on the key.
    """
    new = per_key(rows, key, order)
    stored, fresh = target.alias("o"), new.alias("n")
    joined = stored.join(fresh, F.col(f"o.`{key}`") == F.col(f"n.`{key}`"), "full_outer")
    hit = F.col("n._rows").isNotNull()
    both = [c for c in ([order] if order in target.columns else []) + _data(target) if c in rows.columns]
    rank = {side: F.struct(*(F.col(f"{side}.`{c}`").alias(f"c{i}") for i, c in enumerate(both))) for side in "on"}
    late = hit & F.col("o._sync_version").isNotNull() & (rank["n"] < rank["o"]) if order else F.lit(False)
    taken = hit & ~late
    out = [F.when(taken, F.col(f"n.`{c}`")).otherwise(F.col(f"o.`{c}`")).alias(c) if c in rows.columns else F.col(f"o.`{c}`").alias(c) for c in _data(target)]
    return joined.select(
        *out,
        F.when(hit, now if now is not None else F.current_timestamp()).otherwise(F.col("o._synced_at")).alias("_synced_at"),
        (F.coalesce("o._sync_version", F.lit(0)) + F.coalesce("n._rows", F.lit(0))).cast("long").alias("_sync_version"),
        F.when(taken, F.lit(partial)).otherwise(F.col("o._is_partial")).alias("_is_partial"),
    )


def upsert_counts(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """One row (inserted, updated): new keys, and the rest of the batch's rows."""
    keys = per_key(rows, key).select(F.col(f"`{key}`").alias("_k"), "_rows")
    seen = keys.join(target.select(F.col(f"`{key}`").alias("_old")), F.col("_k") == F.col("_old"), "left")
    inserted = F.count_if(F.col("_old").isNull())
    return seen.agg(inserted.alias("inserted"), (F.coalesce(F.sum("_rows"), F.lit(0)) - inserted).alias("updated"))
