"""Landing that closes a batch when it is full, or when no message has come for a while.

A running query takes messages into an inbox as they come. Its progress tells when the last ones came and
how many wait. When as many wait as make a batch, or the last of them came long enough ago, what the
inbox holds is landed as one batch. Both steps keep their offsets, so each message lands once, whatever
stops in between; what waits in the inbox then is landed after the next start.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tideglass.streaming.landing import land_bronze

FULL, IDLE, STOPPED = "full", "idle", "stopped"


class IdleLanding(StreamingQueryListener):
    """A continuous landing of ``messages`` into ``path``.

    A batch closes at ``rows`` messages, or ``idle`` seconds after the last message. Messages are looked
    for every ``poll`` seconds, so a batch may hold what came since the last look in excess of ``rows``
    (bounded by the options of the source), and closes up to that much later. ``checkpoint`` holds the
    offsets and the inbox. ``closed`` lists why batches closed and how many messages waited.
    """

    def __init__(
        self, messages: DataFrame, path: str, checkpoint: str, rows: int, idle: float = 30, poll: float = 1
    ):
        self.path, self.checkpoint, self.rows, self.idle = path, checkpoint.rstrip("/"), rows, idle
        self.closed: list[tuple[str, int]] = []
        self._spark = messages.sparkSession
        self._change, self._waiting, self._last = threading.Condition(), 0, time.monotonic()
        self._ending, self._error = False, None
        # What an earlier run has left in the inbox waits as well: an idle time after the start.
        self._left = self._inbox_exists()
        self._spark.streams.addListener(self)
        self._query = (
            messages.select(F.col("value"))
            .writeStream.format("parquet")
            .option("path", f"{self.checkpoint}/inbox")
            .option("checkpointLocation", f"{self.checkpoint}/arrivals")
            .trigger(processingTime=f"{int(poll * 1000)} milliseconds")
            .start()
        )
        self._closer = threading.Thread(target=self._close_batches, daemon=True)
        self._closer.start()

    # --- events of the running query ---------------------------------------------------------

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if str(progress.runId) == str(self._query.runId) and progress.numInputRows:
            with self._change:
                self._waiting += progress.numInputRows
                self._last = time.monotonic()
                self._change.notify_all()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    # --- batches -----------------------------------------------------------------------------

    def _inbox_exists(self) -> bool:
        folder = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self.checkpoint}/inbox")
        return folder.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)

    def _reason(self) -> str | None:
        if self._waiting >= self.rows:
            return FULL
        if (self._waiting or self._left) and time.monotonic() - self._last >= self.idle:
            return IDLE
        return STOPPED if self._ending else None

    def _close_batches(self) -> None:
        try:
            while True:
                with self._change:
                    while (reason := self._reason()) is None:
                        due = self._last + self.idle - time.monotonic()
                        self._change.wait(max(0.01, due) if self._waiting or self._left else None)
                    if reason == STOPPED and not (self._waiting or self._left):
                        return
                    number, self._waiting, self._left = self._waiting, 0, False
                self._land()
                self.closed.append((reason, number))
                if reason == STOPPED:
                    return
                with self._change:
                    self._change.notify_all()
        except BaseException as error:  # told to whoever stops the landing or waits for it
            with self._change:
                self._error = error
                self._change.notify_all()

    def _land(self) -> None:
        if self._inbox_exists():
            waiting = self._spark.readStream.schema("value string").parquet(f"{self.checkpoint}/inbox")
            land_bronze(waiting, self.path, f"{self.checkpoint}/landed").awaitTermination()

    def await_batches(self, number: int, patience: float = 120) -> None:
        """Wait until so many batches have closed."""
        with self._change:
            done = self._change.wait_for(lambda: len(self.closed) >= number or self._error, patience)
        if self._error:
            raise self._error
        if not done:
            raise TimeoutError(f"{len(self.closed)} of {number} batches have closed")

    def stop(self, land: bool = True) -> None:
        """End the landing. What waits is landed now, or else after the next start."""
        self._query.processAllAvailable()
        self._query.stop()
        with self._change:
            if not land:
                self._waiting, self._left = 0, False
            elif self._inbox_exists():
                self._left = True
            self._ending = True
            self._change.notify_all()
        self._closer.join()
        self._spark.streams.removeListener(self)
        if self._error:
            raise self._error
