"""Running queries that pick up changed dimension tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery


def run_refreshing(start: Callable[[], StreamingQuery], refresh_s: float, until: Callable[[], bool] = lambda: False) -> None:
    """Keep a query running, and start it anew from its checkpoint every ``refresh_s`` seconds, until ``until()``.

    ``start`` builds the query from freshly loaded dimensions (``Dims`` with ``max_age``) and starts it with its usual
    checkpoint. Offsets and keyed state live there: a micro-batch that is cut short is run again, so nothing is lost, and
    sinks that replace a batch's rows hold nothing twice. A query that fails raises here.
    """
    while True:
        query = start()
        if not query.awaitTermination(refresh_s):
            query.stop()
        if until():
            return
