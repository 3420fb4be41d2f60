"""Progress of the streams as a table."""

from __future__ import annotations

import logging
import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from chirplake.schemas import STREAM_PROGRESS

_LOG = logging.getLogger(__name__)


class ProgressLog(StreamingQueryListener):
    """Records every micro-batch of every stream, one row each.

    Use as a context manager around the streams to watch. Rows are held back and
    appended together, at the latest after ``seconds`` or when ``buffer_rows`` have come in. Rows
    whose write fails are held until the next one.
    """

    def __init__(
        self, spark: SparkSession, path: str, buffer_rows: int = 1000, seconds: float = 10
    ) -> None:
        self.spark, self.path, self.buffer_rows, self.seconds = spark, path, buffer_rows, seconds
        self._closing = threading.Event()
        self._writing = threading.Lock()
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = (
            datetime.fromisoformat(progress.timestamp),
            progress.name,
            progress.batchId,
            progress.numInputRows,
            progress.durationMs.get("addBatch"),
        )
        with self._changed:
            self._rows.append(row)
            full = len(self._rows) >= self.buffer_rows
        if full:
            self._try_flush()

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def await_end(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until all that a finished stream reported has arrived."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end reported for stream {query.name}")

    def flush(self) -> None:
        """Write what is held; if that fails, hold it again and raise."""
        with self._writing:
            with self._changed:
                rows, self._rows = self._rows, []
            if not rows:
                return
            try:
                table = self.spark.createDataFrame(rows, STREAM_PROGRESS)
                table.coalesce(1).write.mode("append").parquet(self.path)
            except Exception:
                with self._changed:
                    self._rows = rows + self._rows
                raise

    def _try_flush(self) -> None:
        try:
            self.flush()
        except Exception:
            _LOG.exception("progress rows are held until they can be written")

    def _flush_now_and_then(self) -> None:
        while not self._closing.wait(self.seconds):
            self._try_flush()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        self._flusher = threading.Thread(target=self._flush_now_and_then, daemon=True)
        self._flusher.start()
        return self

    def __exit__(self, *failure) -> None:
        self._closing.set()
        self._flusher.join()
        self.spark.streams.removeListener(self)
        self.flush()


def throughput(progress: DataFrame, every: str = "10 seconds") -> DataFrame:
    """Rows and mean batch time per stream and time slot; batches without a time do not count."""
    slot = F.window("observed_at", every)
    return (
        progress.groupBy("stream", slot.alias("slot"))
        .agg(F.sum("rows").alias("rows"), F.avg("duration_ms").alias("mean_duration_ms"))
        .select("stream", F.col("slot.start").alias("slot_start"), "rows", "mean_duration_ms")
    )


def live_throughput(
    progress: DataFrame, every: str = "10 seconds", late: str = "1 minute"
) -> DataFrame:
    """``throughput`` of a stream of progress rows, each slot given once, when it is complete.

    A slot is complete when a row has come in that is ``late`` past its end; a row of a slot that was given
    already is dropped and counted, see ``late_rows``. The state holds the open slots alone. The last slots
    stay open until a later row comes in, such as the one ``closing_row`` makes.
    """
    return throughput(progress.withWatermark("observed_at", late), every)


def closing_row(spark: SparkSession, moment: datetime) -> DataFrame:
    """A progress row of no stream, whose time ends all slots well before it."""
    return spark.createDataFrame([(moment, None, None, None, None)], STREAM_PROGRESS)


def late_rows(progress: list) -> int:
    """Rows that came too late for their slot, by the progress of the stream that adds slots up."""
    return sum(
        state["numRowsDroppedByWatermark"] for batch in progress for state in batch["stateOperators"]
    )


def rows_per_stream(progress: DataFrame) -> DataFrame:
    return progress.groupBy("stream").agg(F.sum("rows").alias("rows"))
