"""Point-in-time join: every left row with the newest right row of its key at or before its own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import TimestampType

from orderlens.functions import epoch_seconds
from orderlens.operators.quality import present

# A cell then holds at most 60 million distinct microseconds, and a key half a million cells a year.
CELL_SECONDS = 60
APART = 1 << 20
# A key with more than one in so many rows of either side is cut up; twice as many keys are that heavy at most.
SHARE = 1000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    tie_break: Sequence[str] = (),
    how: str = "inner",
    cell_seconds: int = CELL_SECONDS,
    weighed: DataFrame | None = None,
    take: Sequence[str] | None = None,
) -> DataFrame:
    """Left columns plus the matched right row's columns (all but the keys).

    Right rows of one key and one time are settled by `tie_break`, ascending with nulls last, then by the
    remaining columns. `how="left"` keeps unmatched rows. Null keys and null times match nothing.

    No pair of left and right rows is ever formed, and no task grows with a key. Rows of both sides are counted per key in the
    map tasks. A key with less than a thousandth of the rows is one group: its rows of both sides are sorted by time in
    one shuffle, and the last right row is carried forward. The few other keys are cut up:

    1. Both sides together are reduced to one row per key and time, combined in the map tasks: the best right row
       of that moment, and whether a left row asks for it. A burst at one time costs no more than a single row.
    2. The last right row is carried forward inside cells of fixed length. A group holds at most the distinct
       times of one cell, a bound that the clock sets and not the data.
    3. Each cell is seeded with the newest right row of earlier cells: one row per key and cell is sorted.
    4. Left rows fetch their answer by (key, time), an equi join on a unique key. AQE splits an oversized left
       partition there, which is safe since every left row stands alone.

    `weighed` may name a frame that is cheaper to count than the left rows: one with some of the keys and at least
    as many rows of each. It settles which keys are cut up and has no say in the result.

    `take` names the right columns that are wanted, those of `tie_break` among them. No others are shuffled, and those left
    out settle no tie, which could show in them alone.

    Left rows that can match nothing carry a number by their content, so that null keys are not one big group.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join type: {how}")
    keys = list(keys)
    payload = [c for c in right.columns if c not in keys and (take is None or c in take)]
    clash = set(payload) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if missing := set(tie_break) - set(payload):
        raise ValueError(f"ties are settled by columns that are not taken: {sorted(missing)}")
    ties = [*tie_break, *[c for c in payload if c not in (right_ts, *tie_break)]]

    lines = left if how == "left" else left.where(present(*keys, left_ts))
    snaps = right.where(present(*keys, right_ts))
    weighed = lines if weighed is None else weighed
    by = [k for k in keys if k in weighed.columns]
    heavy = _heavy(weighed, by).unionByName(_heavy(snaps, by)).distinct()

    def among(rows: DataFrame, how: str) -> DataFrame:
        return rows.join(F.broadcast(heavy), by, how).select(*rows.columns)

    light = _in_order(among(lines, "left_anti"), among(snaps, "left_anti"), keys, left_ts, right_ts, payload, ties, how)
    cut = _in_cells(
        among(lines, "left_semi"), among(snaps, "left_semi"), keys, left_ts, right_ts, payload, ties, how, cell_seconds
    )
    return light.unionByName(cut)


def _heavy(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that have more than a fixed share of the rows."""
    counts = rows.where(present(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    whole = counts.agg(F.sum("_rows").alias("_whole"))
    return counts.join(F.broadcast(whole), F.col("_rows") * SHARE > F.col("_whole")).select(*keys)


def _apart(left: DataFrame, keys, left_ts) -> Column:
    """Nought for rows that can match, else a number by their content."""
    content = 1 + F.pmod(F.xxhash64(*left.columns), F.lit(APART))
    return F.when(present(*keys, left_ts), 0).otherwise(content).cast("bigint")


def _in_order(left, right, keys, left_ts, right_ts, payload, ties, how) -> DataFrame:
    """Both sides sorted per key; at one time right rows come first, the one that wins last of them."""
    right_row = F.struct(*payload)
    apart = _apart(left, keys, left_ts) if how == "left" else F.lit(0).cast("bigint")
    events = left.withColumns({"_ts": F.col(left_ts), "_apart": apart, "_asked": F.lit(True)}).unionByName(
        right.select(
            *keys,
            F.col(right_ts).alias("_ts"),
            F.lit(0).cast("bigint").alias("_apart"),
            F.lit(False).alias("_asked"),
            right_row.alias("_snap"),
        ),
        allowMissingColumns=True,
    )
    worst_first = [F.col(f"_snap.{c}").desc_nulls_first() for c in ties]
    so_far = Window.partitionBy(*keys, "_apart").orderBy("_ts", "_asked", *worst_first).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = events.withColumn("_found", F.last("_snap", ignorenulls=True).over(so_far)).where("_asked")
    if how == "inner":
        found = found.where("_found IS NOT NULL")
    return found.select(*left.columns, "_found.*")


def _in_cells(left, right, keys, left_ts, right_ts, payload, ties, how, cell_seconds) -> DataFrame:
    """Both sides cut into cells of time; the left rows fetch their answers by key and time."""
    events = _moments(left, right, keys, left_ts, right_ts, payload, ties)
    answers = _answers(events.withColumn("_cell", _cell(events, cell_seconds)), keys)
    answers = answers.withColumnRenamed("_ts", left_ts).withColumn("_apart", F.lit(0).cast("bigint"))
    apart = _apart(left, keys, left_ts) if how == "left" else F.lit(0).cast("bigint")
    return (
        left.withColumn("_apart", apart)
        .join(answers, [*keys, left_ts, "_apart"], how)
        .select(*left.columns, "_found.*")
    )


def _moments(left, right, keys, left_ts, right_ts, payload, ties) -> DataFrame:
    """(keys, _ts, _snap, _asked): one row per key and time; `_snap` is the right row that wins there, or null."""
    by_rank = [x for c in ties for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    snaps = right.select(
        *keys,
        F.col(right_ts).alias("_ts"),
        F.struct(F.lit(0).alias("_one"), *by_rank).alias("_best"),
        F.lit(False).alias("_asked"),
    )
    asking = left.where(present(*keys, left_ts)).select(
        *keys, F.col(left_ts).alias("_ts"), F.lit(True).alias("_asked")
    )
    best = {c: F.col(f"_best.{c}") for c in ties} | {right_ts: F.col("_ts")}
    snap = F.struct(*[best[c].alias(c) for c in payload])
    return (
        snaps.unionByName(asking, allowMissingColumns=True)
        .groupBy(*keys, "_ts")
        .agg(F.min("_best").alias("_best"), F.max("_asked").alias("_asked"))
        .select(*keys, "_ts", F.when(F.col("_best").isNotNull(), snap).alias("_snap"), "_asked")
    )


def _answers(events: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _ts, _found) for the moments that are asked for and have a right row at or before them."""
    so_far = Window.partitionBy(*keys, "_cell").orderBy("_ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = events.withColumn("_inside", F.last("_snap", ignorenulls=True).over(so_far))
    # The last right row of each cell is found in the map tasks: one row per key and cell moves.
    last = F.max_by("_snap", F.when(F.col("_snap").isNotNull(), F.col("_ts")))
    cells = events.groupBy(*keys, "_cell").agg(last.alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    seeds = cells.select(*keys, "_cell", F.last("_last", ignorenulls=True).over(earlier).alias("_seed")).where(
        "_seed IS NOT NULL"
    )
    return (
        inside.where("_asked")
        .join(seeds, [*keys, "_cell"], "left")
        .select(*keys, "_ts", F.coalesce("_inside", "_seed").alias("_found"))
        .where("_found IS NOT NULL")
    )


def _cell(events: DataFrame, seconds: int) -> Column:
    ts = F.col("_ts")
    if isinstance(events.schema["_ts"].dataType, TimestampType):
        return F.floor(F.unix_seconds(ts) / seconds)
    return F.floor(epoch_seconds(ts.cast("timestamp_ntz")) / seconds)
