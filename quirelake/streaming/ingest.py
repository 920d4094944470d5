"""Taking in new files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.sources import files

_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def watch(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """A stream of the document files that appear in a folder."""
    stream = spark.readStream.format("binaryFile").schema(_SCHEMA).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files._described(stream)


def ingest(spark: SparkSession, folder: str, target: str, checkpoint: str, pattern: str = "*", after: Callable[[DataFrame, int], None] | None = None) -> None:
    """Parses the files that have arrived since the last call and appends their segments to ``target``.

    The checkpoint makes every file count once; a batch that is run again after
    a failure replaces what it had written. ``after`` is called with the files
    of each batch that was written, without their bytes, and its number.
    """

    def write(batch: DataFrame, number: int) -> None:
        files.parse(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/batch={number}")
        if after is not None:
            after(batch.drop("content"), number)

    query = watch(spark, folder, pattern).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def unseen(incoming: DataFrame, known: DataFrame) -> DataFrame:
    """Files whose bytes are not known yet by their hash, each once."""
    hashed = incoming.withColumn("content_hash", F.sha2("content", 256))
    first = hashed.groupBy("content_hash").agg(F.min("source_path").alias("source_path"))
    return hashed.join(first, ["content_hash", "source_path"], "left_semi").join(known.select("content_hash"), "content_hash", "left_anti")


def parse_once(spark: SparkSession, incoming: DataFrame, cache: str) -> DataFrame:
    """The segments of ``incoming`` files, of which only those whose bytes are not in the cache are parsed.

    The cache holds ``segments`` by ``content_hash``, and ``hashes``, which are
    written last: what a lost run had not finished is parsed again and counts once.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{cache}/hashes")
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    known = spark.read.parquet(f"{cache}/hashes") if there else spark.createDataFrame([], "content_hash string")
    fresh = unseen(incoming, known)
    names = fresh.select("document_id", "content_hash")
    files.parse(fresh).join(names, "document_id").dropDuplicates(["content_hash", "segment_index"]).write.mode("append").parquet(f"{cache}/segments")
    fresh.select("content_hash").write.mode("append").parquet(f"{cache}/hashes")
    asked = incoming.select("document_id", F.sha2("content", 256).alias("content_hash"))
    stored = spark.read.parquet(f"{cache}/segments").drop("document_id").dropDuplicates(["content_hash", "segment_index"])
    return asked.join(stored, "content_hash").drop("content_hash")


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums of events by type in windows of time, for streams with a bound on lateness as for tables."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select("w.start", "w.end", "event_type", "n", "value")
