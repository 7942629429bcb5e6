"""The health machine of tasks as a stateful stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class HealthMachine(StatefulProcessor):
    """One state per task: first failure, last alert, last run. Runs of a batch are taken in order of time."""

    def __init__(self, after_minutes: int, repeat_hours: int, gap_minutes: int):
        self.after, self.repeat, self.gap = after_minutes * 60, repeat_hours * 3600, gap_minutes * 60

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("health", "first double, alert double, run double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, alert, last = self.state.get() if self.state.exists() else (None, None, None)
        out = []
        for r in pd.concat(list(rows)).sort_values("ts").itertuples():
            now = r.ts.timestamp()
            if self.gap and last is not None and now - last >= self.gap:
                out.append((r.ts, "downtime"))
            last = now
            if r.ok:
                if first is not None and (alert is not None or now - first >= self.after):
                    out.append((r.ts, "recovered" if alert is not None else "recovered_unreported"))
                first = alert = None
                continue
            first = now if first is None else first
            due = now - alert >= self.repeat if alert is not None else now - first >= self.after
            if due and bool(getattr(r, "sent", True)):
                out.append((r.ts, "failing"))
                alert = now
        self.state.update((first, alert, last))
        if out:
            yield pd.DataFrame({"task": [key[0]] * len(out), "ts": [t for t, _ in out], "kind": [k for _, k in out]})

    def close(self) -> None:
        pass


def alert_stream(runs: DataFrame, after_minutes: int = 120, repeat_hours: int = 24, gap_minutes: int = 0) -> DataFrame:
    """(task, ts, kind) of a stream of runs (task, ts, ok, sent)."""
    machine = HealthMachine(after_minutes, repeat_hours, gap_minutes)
    return runs.groupBy("task").transformWithStateInPandas(machine, "task string, ts timestamp, kind string", "Append", "None")
