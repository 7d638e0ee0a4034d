"""The folder of one micro-batch: below its producer and its run."""

from __future__ import annotations

from pyspark.sql import DataFrame

_QUERY_ID = "sql.streaming.queryId"


def run_of(batch: DataFrame, run: str | None = None) -> str:
    """Who writes: the given name, else the id that a stream keeps in its checkpoint.

    A new checkpoint is a new run and starts a folder of its own; a restart of the same
    one continues its folder.
    """
    found = run or batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
    if not found:
        raise ValueError("name the run: outside a stream no checkpoint tells it")
    return found


def slot(batch: DataFrame, batch_id: int, run: str | None = None, producer: str | None = None) -> str:
    """Relative folder that a retried batch replaces, and no other batch touches."""
    head = f"producer={producer}/" if producer else ""
    return f"{head}run={run_of(batch, run)}/batch_id={batch_id}"
