"""SRC-13: dimensions that change while a stream runs."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from tillstream.session import materialize


class Refreshed:
    """A table that is read anew when its last image is ``seconds`` old.

    Calling it inside ``foreachBatch`` gives the current image: a snapshot
    written under the checkpoint folder, so that all joins of the micro-batches
    that use it, and their retries, see the same rows whatever happens to the
    source meanwhile.  ``seconds=0`` reads the source for every micro-batch."""

    def __init__(self, load: Callable[[], DataFrame], seconds: float = 3600.0,
                 clock: Callable[[], float] = time.monotonic):
        self.load, self.seconds, self.clock = load, seconds, clock
        self.image: DataFrame | None = None
        self.read_at = 0.0
        self.reads = 0

    def __call__(self) -> DataFrame:
        now = self.clock()
        if self.image is None or now - self.read_at >= self.seconds:
            self.image, self.read_at, self.reads = materialize(self.load(), "refreshed"), now, self.reads + 1
        return self.image
