"""Several queries over one stream, a sink each, that end together."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

# Starts a query that writes the rows, with its checkpoint at the given place.
Sink = Callable[[DataFrame, str], StreamingQuery]

# How long a look at one query lasts.
LOOK_SECONDS = 1


class SinkFailed(RuntimeError):
    """A sink's query ended with an error; all others have been stopped."""


def start_sinks(df: DataFrame, sinks: Mapping[str, Sink], checkpoint: str) -> dict[str, StreamingQuery]:
    """One query per sink, with a checkpoint of its own under ``checkpoint``.

    A sink keeps its place by its name, whatever others are added or fail. If one cannot be
    started, those before it are stopped.
    """
    running: dict[str, StreamingQuery] = {}
    try:
        for name, sink in sinks.items():
            running[name] = sink(df, f"{checkpoint}/{name}")
    except Exception:
        stop_all(running)
        raise
    return running


def stop_all(running: Mapping[str, StreamingQuery]) -> None:
    for query in running.values():
        query.stop()


def supervise(running: Mapping[str, StreamingQuery], look_seconds: int = LOOK_SECONDS) -> None:
    """Wait until all queries have ended; if one fails, stop the others and raise its error.

    Started again with the same checkpoints, each goes on from its own place.
    """
    waiting = dict(running)
    try:
        while waiting:
            for name in list(waiting):
                try:
                    if waiting[name].awaitTermination(look_seconds):
                        del waiting[name]
                except StreamingQueryException as error:
                    raise SinkFailed(f"{name}: {error}") from error
    finally:
        # Nothing is left running, be it that one failed or that the caller was interrupted.
        stop_all(waiting)
