"""The streaming job: three queries over one message source, one sink and one checkpoint each."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger import fixed_values as fv, schemas
from skyledger.operators.dedup import dedup_stream
from skyledger.plans import ingest, refresh
from skyledger.session import ROCKSDB_PROVIDER
from skyledger.sources.layers import DAY, LAYOUTS, Layers


def stream_raw(messages: DataFrame, as_of: str | None = None) -> DataFrame:
    return ingest.raw_envelope(messages, as_of)


def stream_quarantine(messages: DataFrame, as_of: str | None = None) -> DataFrame:
    return ingest.quarantine(messages, as_of)


def stream_curated(
    messages: DataFrame, as_of: str | None = None, lateness: str = fv.ALLOWED_LATENESS, spread: int = 16
) -> DataFrame:
    """Valid readings, each once; rows later than the watermark are dropped and counted in the progress.

    Spark holds rows against the watermark with which the micro-batch before began, so that stateful steps may follow
    each other: one more micro-batch of lateness is forgiven than the newest event would tell.

    The event time is in the key, so equal keys always share a five-minute window: the window needs
    no column of its own. A key's state is cleared when the watermark passes event time + lateness.
    """
    readings = ingest.accepted(ingest.validated(messages, as_of), as_of)
    return dedup_stream(readings, lateness, spread).select(schemas.CURATED.fieldNames())


def window_metrics(
    messages: DataFrame, as_of: str | None = None, lateness: str = fv.ALLOWED_LATENESS, width: str = fv.EVENT_WINDOW, spread: int = 16
) -> DataFrame:
    """Per satellite and five-minute window of event time: readings (each once), lost links and the greatest latency.

    A window comes out once, when the watermark has passed its end; nothing can join it after that. Counts combine
    before the shuffle, so a satellite with a third of all rows leaves each task as one row a window.
    """
    readings = stream_curated(messages, as_of, lateness, spread)
    latency = F.timestamp_diff("MILLISECOND", F.col("event_timestamp"), F.col("received_timestamp"))
    grouped = readings.groupBy(F.window("event_timestamp", width).alias("span"), "satellite_id").agg(
        F.count("*").alias("readings"),
        F.count_if(F.col("comm_status") == "LOST").alias("lost_links"),
        F.max(latency).alias("max_latency_ms"),
    )
    return grouped.select(F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), "satellite_id", "readings", "lost_links", "max_latency_ms")


def start_fan_out(
    messages: DataFrame, layers: Layers, checkpoint: str, name: str = "telemetry", as_of: str | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """All three tables from one query that parses each message once.

    Every micro-batch is a batch of its own in the ledger, named by the stream and its number, so that one that is
    replayed after a failure adds nothing. Copies are found among the stored rows of the days touched, however
    old; no row is too late. Derived tables are brought up to date by ``refresh.refresh_days`` when wanted.
    """
    layers.create()

    def store(rows: DataFrame, number: int) -> None:
        refresh.ingest_batch(rows, Layers(rows.sparkSession, layers.root), as_of, f"{name}-{number}")

    return (
        messages.writeStream.queryName(f"{name}_fan_out").foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def start(
    messages: DataFrame, layers: Layers, checkpoints: str, as_of: str | None = None,
    lateness: str = fv.ALLOWED_LATENESS, trigger: dict | None = None, tables: list[str] | None = None,
) -> dict[str, StreamingQuery]:
    """Start the appending queries, all three or the named ones.

    ``checkpoints`` is a folder that all executors can reach.
    """
    spark = layers.spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    streams = {
        "telemetry_raw": stream_raw(messages, as_of),
        "telemetry_quarantine": stream_quarantine(messages, as_of),
        "telemetry_curated": stream_curated(messages, as_of, lateness),
    }
    started = {}
    for name in tables or streams:
        layers.expect_stream_table(name)
        layout, rows = LAYOUTS[name], streams[name]
        stored = schemas.conform(rows, layout.schema).withColumn(DAY, F.to_date(layout.day_of))
        started[name] = (
            stored.writeStream.queryName(name).format("parquet").outputMode("append")
            .partitionBy(DAY)
            .option("path", layers.path(name))
            .option("checkpointLocation", f"{checkpoints.rstrip('/')}/{name}")
            .trigger(**(trigger or {"processingTime": "1 minute"}))
            .start()
        )
    return started


def drain(messages: DataFrame, layers: Layers, checkpoints: str, **options) -> dict[str, StreamingQuery]:
    """Run the job over everything that has arrived, then stop."""
    queries = start(messages, layers, checkpoints, trigger={"availableNow": True}, **options)
    for query in queries.values():
        query.awaitTermination()
    return queries


class LateRows:
    """Rows that a query dropped as too late, from its start on.

    Spark holds only the newest progress reports. ``update`` adds up those that came since the last call, each
    micro-batch once; when reports were lost between two calls it raises and never returns a smaller count.
    """

    def __init__(self, query: StreamingQuery):
        self.query = query
        self.total = 0
        self.batch = None  # the newest micro-batch counted, and its rows so far
        self.rows = 0

    def update(self) -> int:
        for progress in self.query.recentProgress:
            number = progress["batchId"]
            rows = sum(o["numRowsDroppedByWatermark"] for o in progress["stateOperators"])
            if self.batch is not None and number <= self.batch:
                more = max(rows - self.rows, 0) if number == self.batch else 0  # idle reports repeat a number
                self.rows += more
                self.total += more
                continue
            if self.batch is not None and number > self.batch + 1:
                raise RuntimeError(f"reports of batches {self.batch + 1} to {number - 1} are gone; update more often")
            self.batch, self.rows = number, rows
            self.total += rows
        return self.total


def watch(query: StreamingQuery, every: float = 10.0) -> int:
    """Wait until the query ends; all rows it dropped as too late. The wait must see every report once."""
    late = LateRows(query)
    while not query.awaitTermination(every):
        late.update()
    return late.update()
