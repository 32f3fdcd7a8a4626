"""New and status-changed procedures: batch form and stateful stream form."""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from contraluz.functions import fixed_values as V
from contraluz.session import stored

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state."
        "RocksDBStateStoreProvider",
}
#: times in microseconds
_STATE_SCHEMA = "estatus string, first_seen long, last_seen long"


def status_changes(feed: DataFrame, time_slice: str = "hour",
                   max_age_days: float = V.SEEN_MAX_AGE_DAYS) -> DataFrame:
    """First sightings and status changes over a history of snapshots.

    A row is found if its status differs from that of the row before it, or if it
    is more than `max_age_days` after the last row found of its id: the entry was
    forgotten by then, so an unchanged row is new again, and again from that one
    on.  `previous` is the status before, NULL for a new one; `first_seen` is the
    time of the last new one.

    Every row is compared with the one before it.  Rows are compared inside
    (id, time slice); only the last row of each slice crosses to the next one.  An
    id with a third of all rows is thereby spread over its slices, and the ordered
    pass over slices sees one row each.
    """
    turned = before(feed, F.struct("estatus"), "_before", time_slice).withColumn(
        "_turn", F.col("_before").isNull()
        | ~F.col("_before.estatus").eqNullSafe(F.col("estatus")))
    begun = stored(carried(turned, F.when(F.col("_turn"), F.col("ts")), "_begun", time_slice))
    # rows of a status that is older than the limit: only they can be new again
    lasting = begun.where(~F.col("_turn") & (F.col("ts") > F.col("_begun") + _days(max_age_days)))
    again = _found_again(lasting.drop("_before", "_turn"), time_slice, max_age_days)
    turns = begun.where("_turn").select(*feed.columns, F.col("_before.estatus").alias("_status"))
    both = turns.unionByName(again.select(*feed.columns, F.col("estatus").alias("_status")))
    aged = before(both, F.struct("ts"), "_last", time_slice)
    new = F.col("_last").isNull() | (F.col("ts") > F.col("_last.ts") + _days(max_age_days))
    marked = aged.withColumns({
        "previous": F.when(~new, F.col("_status")),
        "change": F.when(new, "new").otherwise("status_change")})
    first = carried(marked, F.when(F.col("change") == "new", F.col("ts")), "_first", time_slice)
    return first.select(*feed.columns, "previous", "change", F.when(
        F.col("change") == "new", F.col("ts")).otherwise(F.col("_first")).alias("first_seen"))


def _days(n: float) -> Column:
    return F.lit(dt.timedelta(days=n))


def before(rows: DataFrame, value: Column, name: str, time_slice: str) -> DataFrame:
    """The value at the row before, by id in the order of (ts, event_id)."""
    sliced = rows.withColumns({"_slice": F.date_trunc(time_slice, "ts"), "_value": value})
    inside = Window.partitionBy("uuid", "_slice").orderBy("ts", "event_id")
    ends = sliced.groupBy("uuid", "_slice").agg(
        F.max(F.struct("ts", "event_id", "_value")).alias("_end"))
    across = Window.partitionBy("uuid").orderBy("_slice")
    opening = ends.select(F.col("uuid").alias("_id"), F.col("_slice").alias("_at"),
                          F.lag("_end._value").over(across).alias("_earlier"))
    lagged = sliced.withColumns({"_own": F.lag("_value").over(inside),
                                 "_rank": F.row_number().over(inside)})
    return _joined(lagged, opening).withColumn(name, F.when(
        F.col("_rank") == 1, F.col("_earlier")).otherwise(F.col("_own"))).select(
            *rows.columns, name)


def carried(rows: DataFrame, value: Column, name: str, time_slice: str) -> DataFrame:
    """The last value that is not NULL at an earlier row, by id in the order of time."""
    sliced = rows.withColumns({"_slice": F.date_trunc(time_slice, "ts"), "_value": value})
    inside = Window.partitionBy("uuid", "_slice").orderBy("ts", "event_id").rowsBetween(
        Window.unboundedPreceding, -1)
    ends = sliced.groupBy("uuid", "_slice").agg(
        F.max(F.when(F.col("_value").isNotNull(), F.struct("ts", "event_id", "_value")))
        .alias("_end"))
    across = Window.partitionBy("uuid").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    opening = ends.select(F.col("uuid").alias("_id"), F.col("_slice").alias("_at"),
                          F.last("_end._value", ignorenulls=True).over(across).alias("_earlier"))
    own = sliced.withColumn("_own", F.last("_value", ignorenulls=True).over(inside))
    return _joined(own, opening).select(
        *rows.columns, F.coalesce("_own", "_earlier").alias(name))


def _joined(rows: DataFrame, opening: DataFrame) -> DataFrame:
    """Rows with what their slice starts from; a slice without a time is one of its own."""
    return rows.join(opening, F.col("uuid").eqNullSafe(F.col("_id"))
                     & F.col("_slice").eqNullSafe(F.col("_at")), "left").drop("_id", "_at")


def _found_again(lasting: DataFrame, time_slice: str, max_age_days: float) -> DataFrame:
    """The rows that are new again inside long runs of one status.

    From a row found, the next is the first of its run past the limit.  Every row
    points there: in the slice where its limit falls, or else to the first row of a
    later slice.  The rows reached from a run's start are marked while the pointers
    double (each row takes its successor's successor), so there are as many rounds
    as the logarithm of a run's length over the limit.
    """
    limit, rows = _days(max_age_days), stored(lasting)
    if rows.isEmpty():
        return rows
    none = F.lit(None).cast(rows.schema["ts"].dataType)
    # rows of one time are found together with the first of them
    places = stored(rows.groupBy("uuid", "_begun", "ts").agg(F.min("event_id").alias("event_id")))
    nodes = places.select("uuid", "_begun", "ts").withColumn("_slice", F.date_trunc(time_slice, "ts"))
    firsts = nodes.groupBy("uuid", "_begun", "_slice").agg(F.min("ts").alias("_first"))
    asked = nodes.withColumn("_past", F.col("ts") + limit)
    starts = nodes.select("uuid", "_begun").distinct().select(
        "*", F.col("_begun").alias("ts"), (F.col("_begun") + limit).alias("_past"))
    asked = asked.select("uuid", "_begun", "ts", "_past").unionByName(starts)
    # rows and questions of a slice in order of time, backwards: a question follows the answer
    at = F.date_trunc(time_slice, "_past")
    line = nodes.select("uuid", "_begun", "_slice", F.col("ts").alias("_time"),
                        F.col("ts").alias("_row"), none.alias("ts")
                        ).unionByName(asked.select(
                            "uuid", "_begun", at.alias("_slice"), F.col("_past").alias("_time"),
                            none.alias("_row"), "ts"))
    backwards = Window.partitionBy("uuid", "_begun", "_slice").orderBy(
        F.desc("_time"), F.col("_row").isNotNull())
    near = line.withColumn("_next", F.last("_row", ignorenulls=True).over(
        backwards.rowsBetween(Window.unboundedPreceding, -1))).where("ts IS NOT NULL")
    # slices and questions that their own slice does not answer, likewise
    far = firsts.select("uuid", "_begun", "_slice", "_first",
                        none.alias("ts")).unionByName(
        near.where("_next IS NULL").select(
            "uuid", "_begun", "_slice", none.alias("_first"), "ts"))
    # a slice's own first row is before its questions' times, so it comes after them
    slices = Window.partitionBy("uuid", "_begun").orderBy(
        F.desc("_slice"), F.col("_first").isNotNull())
    later = far.withColumn("_next", F.last("_first", ignorenulls=True).over(
        slices.rowsBetween(Window.unboundedPreceding, -1))).where("ts IS NOT NULL")
    key = ["uuid", "_begun", "ts"]
    pointers = stored(near.where("_next IS NOT NULL").select(*key, "_next").unionByName(
        later.where("_next IS NOT NULL").select(*key, "_next")))
    reached = stored(pointers.where(F.col("ts") == F.col("_begun")).select(
        "uuid", "_begun", F.col("_next").alias("ts")))
    moves = pointers.where(F.col("ts") != F.col("_begun"))
    while not moves.isEmpty():
        stepped = _follow(reached, moves).select("uuid", "_begun", F.col("_next").alias("ts"))
        reached = stored(reached.unionByName(stepped).distinct())
        onward = moves.select("uuid", "_begun", F.col("ts").alias("_from"),
                              F.col("_next").alias("ts"))
        moves = stored(_follow(onward, moves).select(
            "uuid", "_begun", F.col("_from").alias("ts"), "_next"))
    first = places.select("uuid", "_begun", "ts", F.col("event_id").alias("_next"))
    found = _follow(reached, first).select("uuid", "_begun", "ts", F.col("_next").alias("_event"))
    one = [F.col(f"f.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("uuid", "_begun", "ts")]
    return rows.alias("r").join(found.alias("f"), [
        *one, F.col("r.event_id").eqNullSafe(F.col("f._event"))], "left_semi")


def _follow(at: DataFrame, pointers: DataFrame) -> DataFrame:
    """Places with the `_next` of the pointer that starts there; an id may be NULL."""
    to = pointers.select(*(F.col(c).alias(f"_{c}_") for c in ("uuid", "_begun", "ts")), "_next")
    return at.join(to, [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in ("uuid", "_begun", "ts")])


def changes(ordered: pd.DataFrame, status: str | None, first, last, limit: pd.Timedelta):
    """(row, change, first_seen, previous) of the rows found, from run to run of a status.

    The rows of one id in order; a state that is more than the limit older than a row
    counts as never seen.  Loops over what is found, not over rows.
    """
    states, times = ordered["estatus"].to_numpy(), ordered["ts"]
    turns = [0, *(np.flatnonzero(states[1:] != states[:-1]) + 1), len(states)]
    for begin, end in zip(turns, turns[1:]):
        at = begin
        if status is not None and status == states[begin]:
            at = begin + int(times.iloc[begin:end].searchsorted(last + limit, "right"))
        while at < end:
            known = status is not None and times.iloc[at] - last <= limit
            first = first if known else times.iloc[at]
            yield (at, "status_change" if known else "new", first, status if known else None)
            status, last = states[at], times.iloc[at]
            at = at + 1 + int(times.iloc[at + 1:end].searchsorted(last + limit, "right"))


def follow(carried: list[str], max_age_days: float):
    """The stateful step for one id: rows found now, and the entry kept for later ones.

    Age is measured on the rows' own time, so a replay gives the same result; a
    timeout on event time removes the entry, so what is kept can still matter.
    """
    limit = pd.Timedelta(days=max_age_days)

    def step(key: tuple, frames: Iterator[pd.DataFrame],
             state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"], ignore_index=True)
        status, first, last = state.get if state.exists else (None, None, None)
        first, last = (pd.Timestamp(t, unit="us") for t in (first, last))
        found = list(changes(rows, status, first, last, limit))
        if found:
            picked = rows.iloc[[i for i, _, _, _ in found]]
            status, first, last = picked["estatus"].iloc[-1], found[-1][2], picked["ts"].iloc[-1]
            yield pd.DataFrame({
                "uuid": key[0], "estatus": picked["estatus"], "ts": picked["ts"],
                "event_id": picked["event_id"], "change": [c for _, c, _, _ in found],
                "first_seen": [f for _, _, f, _ in found],
                "previous": [p for _, _, _, p in found],
                **{c: picked[c] for c in carried}})
        past = (last + limit).value // 1_000_000 + 1
        if past <= state.getCurrentWatermarkMs():
            state.remove()
        else:
            state.update((status, first.value // 1000, last.value // 1000))
            state.setTimeoutTimestamp(past)

    return step


def stream_changes(feed: DataFrame, max_age_days: float = V.SEEN_MAX_AGE_DAYS,
                   carried: tuple[str, ...] = (), late_days: float | None = None) -> DataFrame:
    """The stateful form over a streaming feed (uuid, estatus, ts, event_id).

    `carried` text columns of the feed travel along with each change.  An entry is
    removed once no row within `late_days` of the newest could still find it fresh;
    rows later than that are dropped.  The default is the age limit itself.
    """
    late = max_age_days if late_days is None else late_days
    rows = feed.select(
        "uuid", "estatus", F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").cast("long").alias("event_id"), *carried)
    rows = rows.withWatermark("ts", f"{round(late * 86400)} seconds")
    schema = ("uuid string, estatus string, ts timestamp, event_id long, "
              "change string, first_seen timestamp, previous string")
    schema += "".join(f", {name} string" for name in carried)
    return rows.groupBy("uuid").applyInPandasWithState(
        follow(list(carried), max_age_days), schema, _STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout)


def changes_since(rows: DataFrame, entries: DataFrame,
                  max_age_days: float = V.SEEN_MAX_AGE_DAYS) -> DataFrame:
    """What a batch adds to the changes found before it, as the stateful step finds it.

    `entries` are the changes of earlier batches, with `batch`; the newest of an id is
    what was kept of it, so no state is stored beside them.  They go ahead of the rows
    in the line of their id, whatever their time.  One shuffle compares all rows; only
    turns of a status and rows past the limit go on.
    """
    line = entries.select(*(F.col(c) if c in ("uuid", "estatus", "ts", "event_id")
                            else F.lit(None).cast(rows.schema[c].dataType).alias(c)
                            for c in rows.columns),
                          F.col("batch").alias("_batch"), F.col("first_seen").alias("_entry"))
    none = line.schema["_entry"].dataType
    line = line.unionByName(rows.withColumns({
        "_batch": F.lit(None).cast("long"), "_entry": F.lit(None).cast(none)}))
    own = Window.partitionBy("uuid").orderBy(
        F.col("_batch").asc_nulls_last(), "ts", "event_id")
    earlier = own.rowsBetween(Window.unboundedPreceding, -1)
    compared = line.withColumn("_before", F.lag(F.struct("estatus")).over(own)).withColumn(
        "_turn", F.col("_entry").isNotNull() | F.col("_before").isNull()
        | ~F.col("_before.estatus").eqNullSafe(F.col("estatus"))).withColumn(
            "_begun", F.last(F.when(F.col("_turn"), F.col("ts")), ignorenulls=True).over(earlier))
    past = F.col("ts") > F.col("_begun") + _days(max_age_days)
    marked = stored(compared.where(F.col("_turn") | past))
    lasting = marked.where(~F.col("_turn")).drop("_before", "_turn", "_batch", "_entry")
    again = _found_again(lasting, "hour", max_age_days)
    found = marked.where("_turn").select(
        *rows.columns, "_batch", "_entry", F.col("_before.estatus").alias("_status")).unionByName(
            again.select(*rows.columns, F.col("estatus").alias("_status")), allowMissingColumns=True)
    last = F.lag("ts").over(own)
    aged = found.withColumn("_new", F.col("_entry").isNull() & (
        last.isNull() | (F.col("ts") > last + _days(max_age_days))))
    begun = F.when(F.col("_entry").isNotNull(), F.col("_entry")).when(F.col("_new"), F.col("ts"))
    return aged.withColumn("first_seen", F.last(begun, ignorenulls=True).over(
        own.rowsBetween(Window.unboundedPreceding, 0))).where("_entry IS NULL").select(
            *rows.columns, F.when(~F.col("_new"), F.col("_status")).alias("previous"),
            F.when(F.col("_new"), "new").otherwise("status_change").alias("change"), "first_seen")


def prune(seen: DataFrame, now, max_age_days: int = V.SEEN_MAX_AGE_DAYS) -> DataFrame:
    """Seen entries young enough to keep; entries without a time stay."""
    cutoff = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {max_age_days} DAYS")
    last = F.try_to_timestamp(F.col("last_seen").cast("string"))
    return seen.where(F.coalesce(last >= cutoff, F.lit(True)))


# tasks receive the helpers themselves, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
