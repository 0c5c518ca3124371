"""Streams over messages that arrive in a known order, one slice a micro-batch: for replays and for tests of lateness."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skyledger.sources.folders import Folders
from skyledger.sources.messages import read_stream
from skyledger.streaming.ingest import watch


def files_a_slice(spark: SparkSession) -> int:
    """As many as tasks run at once, so that no task makes or reads a whole slice. Ask once: executors come and go."""
    return min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _part_files(folders: Folders, folder: str) -> int:
    return sum(name.startswith("part-") for name in folders.names(folder))


def write_slices(slices: list[DataFrame], folder: str, files: int) -> str:
    """Each slice of messages (``value``) as so many files, by as many tasks.

    A file stream reads files by their times, so one slice after the other. Tasks without a row write no file;
    empty ones take their place, for ``replay`` tells slices apart by the number of files.
    """
    for number, messages in enumerate(slices, 1):
        spark = messages.sparkSession
        folders = Folders(spark)
        messages.select("value").coalesce(files).write.mode("append").parquet(folder)
        for _ in range(number * files - _part_files(folders, folder)):
            spark.createDataFrame([], "value binary").coalesce(1).write.mode("append").parquet(folder)
        if _part_files(folders, folder) != number * files:
            raise RuntimeError(f"slice {number} is not of {files} files in {folder}")
    return folder


def replay(spark: SparkSession, folder: str, files: int) -> DataFrame:
    """The messages of ``write_slices`` as a stream, a slice a micro-batch."""
    return read_stream(spark, "parquet", folder, maxFilesPerTrigger=files)


def run_to_end(rows: DataFrame, path: str, checkpoint: str) -> tuple[StreamingQuery, int]:
    """Write a stream's rows as Parquet until all that has arrived is read; the rows dropped as too late."""
    query = rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return query, watch(query, 1.0)
