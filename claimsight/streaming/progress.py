"""What a stream reports about its micro-batches, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "query STRING, batch_id BIGINT, input_rows BIGINT, late_rows BIGINT, state_rows BIGINT, "
    "watermark TIMESTAMP"
)


class ProgressLog(StreamingQueryListener):
    """Keeps one row per micro-batch of every query below a folder.

    ``late_rows`` are the rows that state operators dropped as older than the watermark, which
    Spark reports but does not keep. A batch that runs again replaces its row.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (
            str(p.id),
            p.batchId,
            p.numInputRows,
            sum(op.numRowsDroppedByWatermark for op in p.stateOperators),
            sum(op.numRowsTotal for op in p.stateOperators),
            p.eventTime.get("watermark"),
        )
        text = SCHEMA.replace("TIMESTAMP", "STRING")
        rows = self.spark.createDataFrame([row], text).withColumn(
            "watermark", F.to_timestamp("watermark")
        )
        rows.coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/run={p.id}-{p.batchId:09d}"
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def read(self) -> DataFrame:
        """All rows so far; waits for reports that are on their way."""
        self.spark._jsc.sc().listenerBus().waitUntilEmpty()
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def close(self) -> None:
        self.spark._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
