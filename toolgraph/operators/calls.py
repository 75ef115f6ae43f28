"""A bounded window of calls in flight inside a task: order kept, retries with back-off, a time limit a call.

Model services answer slowly and several at a time, so a task that waits for each
answer wastes its core. Calls run in threads of the task's Python worker; at most
``window`` are in flight, and results leave in the order of their items. A call
that fails is tried again after a pause that doubles; one that has no result
within its limit, pauses included, gives none, and its place in the window is free
at once, whatever its thread still does. At most ``BUFFERED`` windows of results
wait behind a slow one, so memory is bounded whatever the input.
"""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

#: windows of finished results that may wait behind one that is not
BUFFERED = 4


@dataclass(frozen=True)
class Patience:
    """How a task calls a service: calls in flight, more tries after a failure, seconds before the first of them, seconds a call may take in all (None: any)."""

    window: int = 20
    retries: int = 2
    pause: float = 0.1
    limit: float | None = None


class _Call:
    def __init__(self, limit: float | None):
        self.done, self.value = False, None
        self.deadline = None if limit is None else time.monotonic() + limit


def in_flight(call: Callable[[Any], Any], items: Iterable[Any], patience: Patience = Patience()) -> Iterator[Any]:
    """``call(item)`` of each item in the order of the items; None where all tries failed or the limit passed."""
    changed = threading.Condition()
    held: deque[_Call] = deque()
    running = 0

    def work(own: _Call, item: Any) -> None:
        nonlocal running
        value = None
        for k in range(patience.retries + 1):
            try:
                value = call(item)
                break
            except Exception:  # a service may fail in any way
                if own.done or k == patience.retries:
                    break
                time.sleep(patience.pause * 2**k)
        with changed:
            if not own.done:
                own.done, own.value = True, value
                running -= 1
                changed.notify()

    source = iter(items)
    more = True
    while True:
        with changed:
            now = time.monotonic()
            for own in held:
                if not own.done and own.deadline is not None and own.deadline <= now:
                    own.done = True
                    running -= 1
            ready = []
            while held and held[0].done:
                ready.append(held.popleft().value)
            room = running < patience.window and len(held) < BUFFERED * patience.window
            if not ready and held and not (more and room):
                first = min((own.deadline for own in held if not own.done and own.deadline is not None), default=None)
                changed.wait(None if first is None else max(0.0, first - now))
        yield from ready
        if more and room:
            try:
                item = next(source)
            except StopIteration:
                more = False
                continue
            own = _Call(patience.limit)
            with changed:
                held.append(own)
                running += 1
            threading.Thread(target=work, args=(own, item), daemon=True).start()
        elif not more and not held:
            return
