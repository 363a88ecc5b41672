"""Repeated attempts with growing pauses."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from dataclasses import dataclass, field

log = logging.getLogger(__name__)


class Cancelled(RuntimeError):
    """A pause ended because the caller gave up."""


@dataclass(frozen=True)
class RetryPolicy:
    """Up to ``attempts`` tries; the pause before the second is doubled before every further one.

    Only for work that may be repeated: the sinks overwrite what an earlier try wrote.
    """

    attempts: int = 5
    backoff_s: float = 0.2
    cancelled: threading.Event = field(default_factory=threading.Event, compare=False)

    def run(self, what: str, work: Callable[[], None]) -> None:
        pause = self.backoff_s
        for n in range(1, self.attempts + 1):
            try:
                return work()
            except Exception as e:
                if n == self.attempts:
                    raise RuntimeError(f"{what}: failed after {n} attempts") from e
                log.warning("%s: attempt %d failed, again in %.1f s: %s", what, n, pause, e)
                if self.cancelled.wait(pause):
                    raise Cancelled(f"{what}: given up after {n} attempts") from e
                pause *= 2
