"""Progress of running streams as rows, for those who follow a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class Progress(StreamingQueryListener):
    """Keeps the last ``keep`` progress reports of a session's streams; add it with ``spark.streams.addListener``."""

    def __init__(self, keep: int = 1000):
        self.keep, self.rows, self.failed = keep, [], []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((str(p.id), p.name or "", int(p.batchId), int(p.numInputRows), float(p.inputRowsPerSecond or 0.0), float(p.processedRowsPerSecond or 0.0)))
        del self.rows[: -self.keep]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failed.append(str(event.exception))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "id string, name string, batch bigint, rows bigint, in_per_sec double, done_per_sec double")
