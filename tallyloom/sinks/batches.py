"""Fixed-size batches O5, for receivers that take so many rows at a time."""

from __future__ import annotations

from collections.abc import Callable
from itertools import batched

from pyspark.sql import DataFrame, Row

# Batch sizes of the receivers.
NAME_LOOKUP = 50
POST_STATISTICS = 20
ENTITY_WRITES = 100
COPY_ROWS = 1000


def send_batches(df: DataFrame, size: int, send: Callable[[list[Row]], None]) -> None:
    """Calls ``send`` with up to ``size`` rows at a time inside the tasks.

    A task that is repeated sends its rows again: ``send`` must be idempotent,
    as a keyed write is.
    """

    def run(rows):
        for chunk in batched(rows, size):
            send(list(chunk))

    df.foreachPartition(run)
