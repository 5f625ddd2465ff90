"""State of one watched job.

The worker that prepares a stateful stream does not see shipped files, so this module imports nothing from the
package and its classes travel by value.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EVENT_SCHEMA = "us bigint, seq bigint, status string"
STATE_SCHEMA = "status string, first_us bigint, done boolean, until_ms bigint"
#: Events of a job that are taken in at a time.
AT_ONCE = 10_000


class JobMonitor(StatefulProcessor):
    """Per job: events the watermark has not passed yet, and of those before, the last state, the time of the first, and
    whether a terminal one was among them.

    Events wait in a list until the watermark reaches them, and are then reported in the order of ``us, seq``, so it
    doesn't matter in which micro-batches they came. A job that is done keeps no events, only the mark that it is done,
    which goes as well once ``forget_ms`` have passed since its last event; without a number it stays.
    """

    def __init__(self, terminal: tuple[str, ...], reprint_seconds: int, forget_ms: int | None = None):
        self.terminal, self.reprint, self.forget = terminal, reprint_seconds, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", EVENT_SCHEMA)
        self.state = handle.getValueState("job", STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows, state = iter(rows), self.state.get()
        if state is not None and state[2]:
            return iter(())
        first = end = None
        while part := sorted(((r["us"], r["seq"], r["status"]) for r in islice(rows, AT_ONCE)), key=_place):
            # What comes after the end of a job is never reported, so it need not wait.
            end = min([*([end] if end else []), *[_place(e) for e in part if e[2] in self.terminal][:1]], default=None)
            if kept := [e for e in part if end is None or _place(e) <= end]:
                self.waiting.appendList(kept)
            first = part[0][0] if first is None else min(first, part[0][0])
        if first is not None:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, first, done, until = self.state.get() or (None, None, False, None)
        if done:
            if until is not None and expiredTimerInfo.getExpiryTimeInMs() >= until:
                self.state.clear()
            return
        events = sorted(self.waiting.get(), key=_place)
        watermark = timerValues.getCurrentWatermarkInMs()
        ripe = bisect_right(events, watermark * 1000, key=lambda e: e[0])
        if not ripe:
            return  # another timer of this job came first, and left one for the next event
        events, later = events[:ripe], events[ripe:]
        first = events[0][0] if first is None else first
        for us, seq, status in events:
            elapsed = (us - first) // 1_000_000
            # A change, or a state at every ``reprint`` seconds, of which the first event is one.
            if status != last or elapsed % self.reprint == 0:
                yield Row(job_id=key[0], seq=seq, status=status, elapsed=elapsed)
            last = status
            if status in self.terminal:
                done = True
                break
        if done and self.forget is not None:
            until = max(us // 1000 + self.forget, watermark + 1)
            self.handle.registerTimer(until)
        self.state.update((last, first, done, until))
        if later and not done:
            self.waiting.put(later)
            self._wake(later[0][0])
        else:
            self.waiting.clear()

    def _wake(self, us: int) -> None:
        """A timer for the first whole millisecond that reaches ``us``. It is never the one that just fired, which Spark
        deletes afterwards."""
        self.handle.registerTimer(-(-int(us) // 1000))

    def close(self) -> None:
        pass


def _place(event: tuple) -> tuple:
    """Where an event stands among those of its job; without ``seq`` it comes last in its time."""
    us, seq, _ = event
    return us, seq is None, seq or 0


cloudpickle.register_pickle_by_value(sys.modules[__name__])
