"""Row counts observed while a job or stream runs, without a job of their own."""

from __future__ import annotations

import threading
from collections import defaultdict

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without a second job."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rows_seen(seen: Observation) -> int:
    """Rows observed; a plan that Spark proves empty carries no metrics at all. Any other
    error is raised."""
    try:
        return seen.get["rows"]
    except Py4JJavaError as error:
        if "NoSuchElementException" in error.java_exception.getClass().getName():
            return 0
        raise
    except KeyError:
        return 0


class StreamCounts(StreamingQueryListener):
    """Rows that streams have read, from the progress they report themselves."""

    def __init__(self) -> None:
        self._rows: dict[str, int] = defaultdict(int)
        self._batches: dict[str, int] = defaultdict(int)
        self._done: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self._rows[run] += event.progress.numInputRows
        self._batches[run] += event.progress.numInputRows > 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._done[str(event.runId)].set()

    def of(self, stream: StreamingQuery, timeout: float = 60) -> tuple[int, int]:
        """Rows and non-empty batches of a stream that has ended; its error is raised."""
        stream.awaitTermination()
        run = str(stream.runId)
        if not self._done[run].wait(timeout):
            raise TimeoutError(f"stream {run} has not reported its end")
        return self._rows[run], self._batches[run]
