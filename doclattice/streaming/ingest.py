"""File-stream ingest: documents arrive as files, are frozen once by content, and calls are rolled up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from doclattice.functions.text import canonical_sha256


def document_stream(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(path)


def freeze_stream(documents: DataFrame, out: str, checkpoint: str, payload: str = "payload") -> StreamingQuery:
    """Write-once snapshots. A batch that is run again finds its own rows there, so the sink is idempotent."""

    def one(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        named = batch.withColumn("snapshot_id", canonical_sha256(payload)).where("snapshot_id is not null").groupBy("snapshot_id").agg(F.first(payload).alias(payload))
        path = spark._jvm.org.apache.hadoop.fs.Path(out)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            named = named.join(spark.read.schema(named.schema).parquet(out).select("snapshot_id"), "snapshot_id", "left_anti")
        named.write.mode("append").parquet(out)

    return documents.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(one).start()


def usage_stream(calls: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Calls and tokens by window and document; late calls count until the watermark passes."""
    return calls.withWatermark("ts", late).groupBy(F.window("ts", window), "document_id").agg(F.count("*").alias("calls"), F.sum("tokens").alias("tokens"))
