"""Work that is repeated at an interval: publishing waiting events, repairing the index."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable

from driftmark.engine import Engine
from driftmark.sources.sinks import EventSink

_LOG = logging.getLogger(__name__)


class Loop:
    """Calls ``step`` until ``stop()``. ``step`` says whether there is more to do at once; if not, or if it failed,
    the loop waits for the interval, and ``stop()`` ends that wait."""

    def __init__(self, step: Callable[[], bool], interval_seconds: float, name: str = "loop") -> None:
        self.step, self.interval, self.errors = step, interval_seconds, 0
        self._stopped = threading.Event()
        self._thread = threading.Thread(target=self._run, name=name, daemon=True)

    def _run(self) -> None:
        while not self._stopped.is_set():
            more = False
            try:
                more = self.step()
            except Exception:  # the next round may do better, so the loop goes on
                self.errors += 1
                _LOG.exception("%s failed", self._thread.name)
            if not more:
                self._stopped.wait(self.interval)

    def start(self) -> Loop:
        self._thread.start()
        return self

    def running(self) -> bool:
        return self._thread.is_alive()

    def stop(self, timeout: float | None = None) -> None:
        """Finish the step in progress and end."""
        self._stopped.set()
        self._thread.join(timeout)


def relay(engine: Engine, sink: EventSink | str) -> Loop:
    """Publishes without a pause while batches are full, else every ``relay_poll_interval_ms``."""
    return Loop(lambda: engine.publish(sink) >= engine.settings.relay_batch, engine.settings.relay_poll_interval_ms / 1000, "relay")


def reconciler(engine: Engine) -> Loop:
    """Repairs the index every ``reconcile_interval_seconds``."""

    def step() -> bool:
        engine.reconcile()
        return False

    return Loop(step, engine.settings.reconcile_interval_seconds, "reconciler")
