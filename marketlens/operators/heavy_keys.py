"""Problem 4: per-key results where a few keys own most rows.

Dense accumulator arrays. Every input split (equal in bytes, not in keys) dictionary-encodes its keys and adds its
rows into dense arrays by ``numpy.bincount`` and scatter-reduce; a key that owns a third of the table costs a split no
more than any other. The arrays leave the split cut into blocks by key hash, and the blocks are summed by a two-level
distributed reduction: first within groups of splits, then over the groups. No row is shuffled by its key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.session import written

FAN_IN = 64
"""Splits whose blocks one first-level reduction sums."""
_NONE = np.iinfo(np.int64).min
_BLOCK = "b int, g int, keys array<bigint>, n array<bigint>, s array<bigint>, m array<bigint>"


def _merge(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Dictionary-encodes the keys of all parts and sums or scatter-reduces their values into dense arrays."""
    keys, codes = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n, s = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    np.add.at(n, codes, np.concatenate([p[1] for p in parts]))
    np.add.at(s, codes, np.concatenate([p[2] for p in parts]))
    m = np.full(len(keys), _NONE, np.int64)
    np.maximum.at(m, codes, np.concatenate([p[3] for p in parts]))
    return keys, n, s, m


def _encode(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    keys, codes = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
    flags = batch.column(1).to_numpy(zero_copy_only=False)
    stamps = batch.column(2).to_numpy(zero_copy_only=False)
    n = np.bincount(codes, minlength=len(keys))
    s = np.bincount(codes[flags != 0], minlength=len(keys))
    m = np.full(len(keys), _NONE, np.int64)
    np.maximum.at(m, codes, stamps)
    return keys, n.astype(np.int64), s.astype(np.int64), m


def _blocks(keys: np.ndarray, n: np.ndarray, s: np.ndarray, m: np.ndarray, blocks: int, group: int):  # noqa: ANN202
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # Fibonacci hashing
    block = ((mixed >> np.uint64(33)) % np.uint64(blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    cuts = np.flatnonzero(np.diff(block[order])) + 1
    found = [x for x in np.split(order, cuts) if len(x)]
    if found:
        yield pa.RecordBatch.from_pydict(
            {
                "b": pa.array([int(block[x[0]]) for x in found], pa.int32()),
                "g": pa.array([group] * len(found), pa.int32()),
                **{k: pa.array([v[x] for x in found], pa.list_(pa.int64())) for k, v in (("keys", keys), ("n", n), ("s", s), ("m", m))},
            }
        )


def key_totals(
    df: DataFrame,
    key: Column,
    flag: Column | None = None,
    ts: Column | None = None,
    blocks: int | None = None,
    flush_keys: int = 1 << 20,
    keep_none: bool = False,
) -> DataFrame:
    """``key, n_rows, n_flagged, last_ts``: one row per key, summed without shuffling rows by key.

    ``key``: a whole number; rows where it is null belong to no key and are left out. ``flag``: counted where true; null
    is false. ``ts``: its latest value, null where the key has none. ``blocks``: pieces in which the accumulators are
    summed, by default four times the session's shuffle partitions. A split whose dictionary passes ``flush_keys``
    keys emits its arrays and starts anew, which bounds its memory without changing the sums. With ``keep_none`` the
    rows without a key come out under a null key. An empty input gives no rows.
    """
    spark = df.sparkSession
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = df.select(
        (F.coalesce(key.cast("bigint"), F.lit(_NONE)) if keep_none else key.cast("bigint")).alias("k"),
        F.coalesce(flag if flag is not None else F.lit(False), F.lit(False)).cast("int").alias("f"),
        F.coalesce(F.unix_micros(ts.cast("timestamp")) if ts is not None else F.lit(_NONE), F.lit(_NONE)).alias("t"),
    ).where("k IS NOT NULL")

    def accumulate(batches):  # noqa: ANN001, ANN202
        from pyspark import TaskContext

        group = TaskContext.get().partitionId() // FAN_IN
        parts: list = []
        for batch in batches:
            if batch.num_rows:
                parts.append(_encode(batch))
            if len(parts) >= 16 or (parts and sum(len(p[0]) for p in parts) >= flush_keys):
                parts = [_merge(parts)]
                if len(parts[0][0]) >= flush_keys:
                    yield from _blocks(*parts[0], blocks, group)
                    parts = []
        if parts:
            yield from _blocks(*_merge(parts), blocks, group)

    def summed(pieces: list[pa.Table]):  # noqa: ANN202
        flat = [[np.asarray(p.column(c).combine_chunks().flatten()) for c in ("keys", "n", "s", "m")] for p in pieces]
        return _merge([tuple(x) for x in flat])

    def reduce_group(table: pa.Table) -> pa.Table:
        keys, n, s, m = summed([table])
        b, g = table.column("b")[0].as_py(), table.column("g")[0].as_py()
        return pa.table({"b": pa.array([b], pa.int32()), "g": pa.array([g], pa.int32()), **{k: pa.array([v], pa.list_(pa.int64())) for k, v in (("keys", keys), ("n", n), ("s", s), ("m", m))}})

    def reduce_all(table: pa.Table) -> pa.Table:
        keys, n, s, m = summed([table])
        return pa.table({"key": keys, "n_rows": n, "n_flagged": s, "m": pa.array(m, pa.int64(), mask=m == _NONE)})

    split_blocks = slim.mapInArrow(accumulate, _BLOCK)
    grouped = split_blocks.groupBy("b", "g").applyInArrow(reduce_group, _BLOCK)
    totals = grouped.groupBy("b").applyInArrow(reduce_all, "key bigint, n_rows bigint, n_flagged bigint, m bigint")
    return totals.select(F.nullif("key", F.lit(_NONE)).alias("key"), "n_rows", "n_flagged", F.timestamp_micros("m").cast("timestamp_ntz").alias("last_ts"))


def hot_keys(df: DataFrame, key: Column, share_percent: int = 2, **kw: object) -> DataFrame:
    """``key, n_rows``: the keys that hold at least ``share_percent`` % of all rows of ``df``, rows without a key included in the base."""
    totals = written(key_totals(df, key, keep_none=True, **kw).select("key", "n_rows"), "totals")  # one scan of ``df`` gives keys and base
    return totals.where(F.col("key").isNotNull() & (F.col("n_rows") * 100 >= F.lit(share_percent) * totals.agg(F.sum("n_rows")).scalar()))
