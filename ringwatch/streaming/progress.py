"""What every micro-batch held, as Spark counts it on the way; no job of its own."""

import threading
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ringwatch.schemas import PRICE_EVENT, SOCIAL_EVENT

NAME = "ringwatch"
#: Batches that a listener keeps.
KEPT = 10_000


def observed(events: DataFrame) -> DataFrame:
    """Decoded events whose counts are reported with the progress of the query that reads them.

    A record that is no JSON object of an event has no kind and counts as malformed.
    """
    kind = F.col("event_type")
    return events.observe(
        NAME,
        F.count(F.lit(1)).alias("events"),
        F.count_if(kind == SOCIAL_EVENT).alias("social"),
        F.count_if(kind == PRICE_EVENT).alias("price"),
        F.count_if(kind.isNull()).alias("malformed"),
    )


class BatchProgress(StreamingQueryListener):
    """The counts of the last ``KEPT`` micro-batches: what ``observed`` counts, and ``late``.

    ``late`` is the number of rows that the state of a query dropped behind the watermark, after they
    were combined within their task.
    """

    def __init__(self, kept: int = KEPT):
        self.batches: deque[dict] = deque(maxlen=kept)
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(NAME)
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        if counts is None and not late:
            return
        with self._changed:
            self.batches.append({
                "query": progress.name, "batch_id": progress.batchId, "late": late,
                **(counts.asDict() if counts is not None else {}),
            })
            self._changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: str) -> list[dict]:
        return [b for b in list(self.batches) if b["query"] == query]

    def wait_for(self, query: str, batches: int, seconds: float = 30) -> list[dict]:
        """The batches of a query, once there are so many; progress is reported a little after a batch."""
        with self._changed:
            self._changed.wait_for(lambda: len(self.of(query)) >= batches, seconds)
        return self.of(query)
