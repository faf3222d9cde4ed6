"""Counts of what a load landed, loaded, rejected and left out, observed while the rows are written.

Tasks that run again after an executor was lost may count their rows twice, so a
tally reports, and no load depends on it.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation

log = logging.getLogger("spendloom.loads")


@dataclass(frozen=True)
class Tally:
    """Rows of one step: ``outside`` are good ones that a window or a high-water mark leaves out."""

    step: str
    landed: int
    loaded: int
    rejected: int
    outside: int = 0

    @property
    def balanced(self) -> bool:
        return self.landed == self.loaded + self.rejected + self.outside

    def __str__(self) -> str:
        sides = f"{self.landed} landed, {self.loaded} loaded, {self.rejected} rejected, {self.outside} outside"
        return f"{self.step}: {sides}{'' if self.balanced else ' - NOT BALANCED'}"


_found: ContextVar[list[Tally] | None] = ContextVar("tallies", default=None)


@contextmanager
def collected() -> Iterator[list[Tally]]:
    """The tallies of all loads in the block."""
    found: list[Tally] = []
    token = _found.set(found)
    try:
        yield found
    finally:
        _found.reset(token)


def keep(tally: Tally) -> None:
    """Log a tally, as a warning if it isn't balanced, and hand it to whoever collects."""
    log.log(logging.INFO if tally.balanced else logging.WARNING, "%s", tally)
    if (found := _found.get()) is not None:
        found.append(tally)


class Counted:
    """A frame that counts while an action on it runs.

    ``rows`` is the frame to write; ``count(name)`` gives a count afterwards, 0 if no partition ran.
    """

    def __init__(self, df: DataFrame, **counts: Column):
        self._seen = Observation()
        self.rows = df.observe(self._seen, *[c.alias(name) for name, c in counts.items()])

    def count(self, name: str) -> int:
        return self._seen.get.get(name) or 0
