"""How often a site is asked, over all tasks of a crawl, and when it is left alone.

Time is cut into slots, and each slot belongs to one of a fixed number of tasks, by its partition. A task sends at the
beginning of a slot of its own and once in a slot, so tasks need no word of each other. The hosts' clocks must agree to a
fraction of a slot, as they do where they are set over a network. A task that has nothing to send leaves its slots unused.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import TaskContext

#: How far into a slot a request may still be sent, as a part of the slot.
LATE = 0.25


@dataclass(frozen=True)
class Pace:
    """At most per_second requests in any second, 1 or more, by tasks of which no two have one partition number modulo tasks at a time:
    tasks is at least the number of partitions that fetch."""

    per_second: int
    tasks: int

    def __post_init__(self):
        if self.per_second < 1 or self.tasks < 1:
            raise ValueError("per_second and tasks are 1 or more")

    @property
    def width(self) -> float:
        """per_second + 1 requests in a row are at least a second apart, even if the first is sent late."""
        return 1 / (self.per_second - LATE)

    def next_slot(self, now: float, owner: int, used: int) -> int:
        """The first slot of owner after the slot used that isn't over for it at the time now."""
        first = max(math.ceil(now / self.width - LATE), used + 1)
        return first + (owner - first) % self.tasks

    def gate(self, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep) -> Callable[[], None]:
        """A function that returns when the task that calls it may send."""
        context = TaskContext.get()
        owner, used = (context.partitionId() if context else 0) % self.tasks, -1

        def wait() -> None:
            nonlocal used
            while True:
                slot = self.next_slot(clock(), owner, used)
                if (left := slot * self.width - clock()) > 0:
                    sleep(left)
                used = slot
                if slot * self.width <= clock() <= (slot + LATE) * self.width:
                    return

        return wait


class Breaker:
    """Opens after failures in a row, and lets one request through each time that cool seconds have gone by, until one
    succeeds. Each session has its own."""

    def __init__(self, failures: int, cool: float, clock: Callable[[], float] = time.monotonic):
        self.failures, self.cool, self.clock = failures, cool, clock
        self.row, self.since = 0, 0.0

    def closed(self) -> bool:
        return not self.failures or self.row < self.failures or self.clock() - self.since >= self.cool

    def tell(self, worked: bool) -> None:
        self.row, self.since = (0 if worked else self.row + 1), self.clock()
