"""Segments, trimmed ends and uniform sessions on an unbounded input.

Turns may arrive late and out of order within the watermark.  A session's state is what is not decided yet: turns newer than
the watermark, the number of blank turns so far, the short turns at the open end of its segment, and, until a second
different turn is seen, the turns of a session that may be uniform.  Everything else is emitted once, in order.  Event times
must not fall as turns rise: a turn is placed when no earlier one can come any more.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ListState

from corpuswash.functions import patterns as P
from corpuswash.model import SESSION
from corpuswash.plans import workers

TURN = "turn long, part int, text string"
OUT = ["segment", "turn", "part", "text"]


def _keep(state: ListState, rows: list[tuple]) -> None:
    """An empty list is no value."""
    if rows:
        state.put(rows)
    elif state.exists():
        state.clear()


class Segmenter(StatefulProcessor):
    def __init__(self, no_utter_dup: bool, no_short_response: bool, idle_ms: int) -> None:
        self.no_utter_dup, self.no_short_response, self.idle_ms = no_utter_dup, no_short_response, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"{TURN}, at long")
        self.short_end = handle.getListState("short_end", TURN)
        self.alike = handle.getListState("alike", TURN)
        self.open = handle.getValueState("open", "blanks long, varied boolean, last long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(t), int(p), x, int(at.value // 1_000_000)) for df in rows for t, p, x, at in zip(df["turn"], df["part"], df["text"], df["seen_at"], strict=True)]
        if not new:
            return
        held = list(self.waiting.get()) if self.waiting.exists() else []
        self.waiting.put([*held, *new])
        blanks, varied, last = self.open.get() if self.open.exists() else (0, not self.no_utter_dup, 0)
        self.open.update((blanks, varied, max(last, *(r[3] for r in new))))
        # one timer per session, for the earliest turn that waits
        if not held or min(r[3] for r in new) < min(r[3] for r in held):
            self.handle.registerTimer(min(r[3] for r in new))
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        held = list(self.waiting.get()) if self.waiting.exists() else []
        blanks, varied, last = self.open.get() if self.open.exists() else (0, True, 0)
        if not held:
            if last + self.idle_ms <= now:  # nothing more is awaited: what is still open is a short end or uniform
                for state in (self.waiting, self.short_end, self.alike, self.open):
                    state.clear()
            return
        due = sorted(r[:3] for r in held if r[3] <= now)
        rest = [r for r in held if r[3] > now]
        out: list[tuple] = []
        tail = list(self.short_end.get()) if self.short_end.exists() else []
        if not varied:
            due = [*(self.alike.get() if self.alike.exists() else []), *due]
            varied = len({r[2] for r in due}) > 1
            _keep(self.alike, [] if varied else due)
            due = due if varied else []
        for turn, part, text in due:
            if text == "":
                blanks, tail = blanks + 1, []
            elif self.no_short_response and len(text.replace(" ", "")) < P.SHORT_LEN:
                tail.append((turn, part, text))
            else:
                out += [(str(blanks), *r) for r in [*tail, (turn, part, text)]]
                tail = []
        _keep(self.short_end, tail)
        _keep(self.waiting, rest)
        self.open.update((blanks, varied, last))
        self.handle.registerTimer(min((r[3] for r in rest), default=max(last + self.idle_ms, now + 1)))
        if out:
            df = pd.DataFrame(out, columns=OUT)
            for name, value in zip(reversed(SESSION), reversed(key), strict=True):
                df.insert(0, name, value)
            yield df

    def close(self) -> None:
        pass


def segment_stream(rows: DataFrame, event_time: str, delay: str, no_utter_dup: bool = False, no_short_response: bool = False, idle_ms: int = 3_600_000) -> DataFrame:
    """Segments of the sessions in ``rows`` (utterance columns and ``event_time``) as ``operators.sessions`` cuts them.

    ``delay`` is how late a turn may come.  With ``no_utter_dup`` sessions whose turns are all alike give no rows, with
    ``no_short_response`` short turns at the end of a segment go.  A session's state is dropped ``idle_ms`` after its last
    turn.  Null texts count as blank; repeated turns are kept, as in a batch.  The session needs the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    workers.prepare(rows.sparkSession)
    text = F.coalesce("text", F.lit("")).alias("text")
    own = rows.withWatermark(event_time, delay).select(*SESSION, "turn", "part", text, F.col(event_time).cast("timestamp").alias("seen_at"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema if f.name in SESSION)
    return own.groupBy(*SESSION).transformWithStateInPandas(
        statefulProcessor=Segmenter(no_utter_dup, no_short_response, idle_ms),
        outputStructType=f"{kinds}, segment string, {TURN}",
        outputMode="Append",
        timeMode="EventTime",
    )
