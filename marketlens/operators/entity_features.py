"""Problem 1: one feature row per entity from an event log with hundreds of event types.

Two-stage salted aggregation. Stage one aggregates by (entity, type, salt), so that a heavy
(entity, type) group is shared by several reducers; stage two merges the partial statistics by
(entity, type), and a last step, on the same partitioning, expands the complete type list into
columns. The salt is that of the map task: a map task emits one partial row per group, as without
salts, so salting costs light groups nothing, and no reducer gets more than the partial rows of
its own salts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.keys import entity_id

MATCH, APPLICATION = "match", "application"
ACTIVITY_TYPES = tuple(range(2, 100))


def once(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per ``key``: of repeated deliveries the one that is greatest by ``order`` (nulls are least).

    Rows with a null key are all kept: they can't be told to be repeats.
    """
    rest = [c for c in df.columns if c != key]
    ranked = [c for c in order if c != key] + [c for c in rest if c not in order]
    known = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(*ranked)).alias("_row"))
        .select(key, *[F.col("_row").getField(c).alias(c) for c in rest])
    )
    return known.unionByName(df.where(F.col(key).isNull()).select(key, *rest))


def plausible(ts: Column, feed_day: Column, early_days: int, late_days: int) -> Column:
    """``ts`` unless it lies more than ``early_days`` before or ``late_days`` after the day of its feed; without a feed day, ``ts``."""
    day = F.to_date(ts)
    bad = (F.datediff(feed_day, day) > early_days) | (F.datediff(day, feed_day) > late_days)
    return F.when(F.coalesce(bad, F.lit(False)), F.lit(None)).otherwise(ts)


def entity_features(
    events: DataFrame,
    types: Sequence[str],
    entity: str = "user_id",
    kind: str = "kind",
    ts: str = "ts",
    salts: int = 16,
) -> DataFrame:
    """One row per entity with ``n_<type>`` and ``last_<type>`` for every type of ``types``, and ``n_total``, ``last_total``.

    ``events``: columns ``entity``, ``kind``, ``ts``; other columns are ignored. Rows with a null entity, or of a
    kind outside ``types``, are no events of the list and don't count. An entity gets 0 and null for a type it
    never had. A null ``ts`` counts but has no date. An empty input gives no rows.
    """
    slim = events.select(F.col(entity).alias("_e"), F.col(kind).alias("_k"), F.col(ts).alias("_t"))
    slim = slim.where(F.col("_e").isNotNull() & F.col("_k").isin(*types))
    partial = (
        slim.withColumn("_s", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("_e", "_k", "_s")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_t").alias("_l"))
    )
    merged = (
        partial.repartition("_e")  # at most types x salts rows an entity; both groupings below reuse this exchange
        .groupBy("_e", "_k")
        .agg(F.sum("_n").alias("_n"), F.max("_l").alias("_l"))
    )
    per_entity = merged.groupBy("_e").agg(
        F.sum("_n").alias("n_total"),
        F.max("_l").alias("last_total"),
        F.map_from_entries(F.collect_list(F.struct("_k", F.struct("_n", "_l")))).alias("_m"),
    )
    cells = [x for k in types for x in (f"coalesce(try_element_at(_m, '{k}')._n, 0L) AS `n_{k}`", f"try_element_at(_m, '{k}')._l AS `last_{k}`")]
    return per_entity.selectExpr(f"_e AS `{entity}`", "n_total", "last_total", *cells)


def candidate_features(
    matches: DataFrame,
    activities: DataFrame,
    activity_types: Sequence[int] = ACTIVITY_TYPES,
    early_days: int = 730,
    late_days: int = 31,
) -> DataFrame:
    """One row per candidate over matches, applications and every activity type.

    A record delivered several times counts once, in its latest delivery. Candidate ids are compared without case
    and outer blanks; ids that mean no candidate are left out. A date that is null, or absurd against the day of its
    feed (see ``plausible``), doesn't make a record's count disappear, only its date. An application is a match
    with ``isapply`` = 1; other flags are none. Activity types outside ``activity_types`` are not events.
    """
    m = matches.select(
        "candidatematchid", "feed_day", "isapply", "matchdate", "applicationdate", entity_id(F.col("userid")).alias("user_id")
    )
    m = once(m, "candidatematchid", ["feed_day"])
    matched = m.select(
        "user_id",
        F.explode(
            F.array(
                F.struct(F.lit(MATCH).alias("kind"), plausible(F.col("matchdate"), F.col("feed_day"), early_days, late_days).alias("ts")),
                F.when(
                    F.col("isapply") == 1,
                    F.struct(F.lit(APPLICATION).alias("kind"), plausible(F.col("applicationdate"), F.col("feed_day"), early_days, late_days).alias("ts")),
                ),
            )
        ).alias("_x"),
    ).select("user_id", "_x.kind", "_x.ts")
    a = activities.select("activityid", "feed_day", "type", "activitydate", entity_id(F.col("userid")).alias("user_id"))
    a = once(a, "activityid", ["feed_day"])
    acted = a.where(F.col("type").isin(*activity_types)).select(
        "user_id",
        F.concat(F.lit("type_"), F.col("type").cast("string")).alias("kind"),
        plausible(F.col("activitydate"), F.col("feed_day"), early_days, late_days).alias("ts"),
    )
    kinds = [MATCH, APPLICATION, *(f"type_{t}" for t in activity_types)]
    return entity_features(matched.unionByName(acted), kinds)
