"""Health of repeated tasks: failure streaks, gaps, alerts; errors in plain words; durations; budgets."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.columns import template
from vellum.operators.ranking import summed_before

#: Rules in one expression.
RULES = 100


def streaks(runs: DataFrame) -> DataFrame:
    """(task, first_fail, last_fail, fails, recovered): unbroken failures of each task, and the success that ended them.

    runs(task, run_id, ts, ok). A streak is named by the number of successes before it.
    """
    order = Window.partitionBy("task").orderBy("ts", "run_id")
    rows = runs.withColumn("_streak", F.count_if("ok").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    out = rows.groupBy("task", "_streak").agg(
        F.min(F.when(~F.col("ok"), F.col("ts"))).alias("first_fail"),
        F.max(F.when(~F.col("ok"), F.col("ts"))).alias("last_fail"),
        F.count_if(~F.col("ok")).alias("fails"),
        F.max(F.when(F.col("ok"), F.col("ts"))).alias("recovered"),
    )
    return out.where("fails > 0").drop("_streak")


def downtimes(runs: DataFrame, gap_minutes: int) -> DataFrame:
    """(task, start, end, minutes): gaps between two runs of a task of at least the given length."""
    order = Window.partitionBy("task").orderBy("ts", "run_id")
    rows = runs.select("task", F.lag("ts").over(order).alias("start"), F.col("ts").alias("end"))
    minutes = F.timestamp_diff("MINUTE", "start", "end")
    return rows.withColumn("minutes", minutes).where(F.col("minutes") >= gap_minutes)


_TOLD = pa.schema([("task", pa.string()), ("ts", pa.timestamp("us", "UTC")), ("kind", pa.string())])


def alerts(runs: DataFrame, after_minutes: int = 120, repeat_hours: int = 24) -> DataFrame:
    """(task, ts, kind): failing, recovered and recovered_unreported, in batch.

    runs may carry `sent`: whether a message sent at that run would get out; a failing
    alert that does not get out is due again at the next run. The alerts of a streak
    depend on the last one that was sent, so the runs of a task pass in order; what is
    carried from run to run is two times, however long a streak is.
    """
    sent = F.coalesce("sent", F.lit(True)) if "sent" in runs.columns else F.lit(True)
    rows = runs.select(F.col("task").cast("string").alias("task"), F.unix_micros("ts").alias("at"), "run_id", "ok", sent.alias("sent")).repartition("task").sortWithinPartitions("task", "at", "run_id")
    after, repeat = after_minutes * 60_000_000, repeat_hours * 3_600_000_000

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, task, first, last = False, None, None, None
        for batch in batches:
            out = ([], [], [])

            def say(kind: str, out=out) -> None:
                for values, v in zip(out, (task, at, kind), strict=True):
                    values.append(v)

            for name, at, ok, gets_out in zip(*(batch.column(c).to_pylist() for c in ("task", "at", "ok", "sent")), strict=True):
                if not begun or name != task:
                    begun, task, first, last = True, name, None, None
                if ok:
                    if last is not None or first is not None and at >= first + after:
                        say("recovered" if last is not None else "recovered_unreported")
                    first = last = None
                    continue
                first = at if first is None else first
                if gets_out and (at >= last + repeat if last is not None else at >= first + after):
                    say("failing")
                    last = at
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()).cast(f.type) if f.name == "ts" else pa.array(v, f.type) for v, f in zip(out, _TOLD, strict=True)], schema=_TOLD)

    told = rows.mapInArrow(tell, "task string, ts timestamp, kind string")
    return told.withColumn("task", F.col("task").cast(runs.schema["task"].dataType))


def explained(errors: DataFrame, rules: DataFrame, text: str = "detail") -> DataFrame:
    """errors with `reason`: that of the first rule (ord, match, reason) whose pattern occurs, in any letter case; null if none does.

    The rules are a list kept by hand. They become expressions over each row, RULES of
    them in one, so that nothing is joined.
    """
    kept = rules.orderBy("ord").collect()
    parts = []
    for i in range(0, len(kept), RULES):
        found = F.lit(None).cast("string")
        for r in reversed(kept[i : i + RULES]):
            found = F.when(F.col(text).rlike("(?i)" + r["match"]), r["reason"]).otherwise(found)
        parts.append(found)
    return errors.withColumn("reason", F.coalesce(*parts) if parts else F.lit(None).cast("string"))


def duration_text(minutes: Column) -> Column:
    """Days and hours, hours and minutes, or minutes, in words."""
    days, hours, rest = F.floor(minutes / 1440), F.floor(minutes / 60) % 24, minutes % 60
    return F.when(minutes >= 1440, template("{d} ngày {h} giờ", d=days, h=hours)).when(minutes >= 60, template("{h} giờ {m} phút", h=hours, m=rest)).otherwise(template("{m} phút", m=rest))


def admitted(pages: DataFrame, budget_seconds: float, workers: int = 1) -> DataFrame:
    """The pages (rank, seconds) that a time-boxed pass starts: those whose work before them fits, in order of rank.

    The deadline leaves 45 seconds or half of the budget, whichever is less, to what is
    running; what has started is finished.
    """
    deadline = max(budget_seconds - 45, budget_seconds / 2)
    rows = summed_before(pages, "rank", "seconds", "_before")
    return rows.where(F.col("_before") / workers < deadline).drop("_before")
