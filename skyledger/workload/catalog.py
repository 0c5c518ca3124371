"""Every query by name, over telemetry derived from the ``events`` table of a data folder."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger import fixed_values as fv
from skyledger.plans import gold, ingest, refresh, reports, silver
from skyledger.session import prepare, shared_dir
from skyledger.sources.layers import Layers
from skyledger.sources.messages import read_received_csv, to_messages
from skyledger.streaming import ingest as streaming, replay
from skyledger.workload.telemetry import (
    AS_OF, EVENT_COLUMNS, GRID_END, GRID_START, messages, read_events, received_csv_rows,
)

STORED_TABLES = [
    "telemetry_raw", "telemetry_quarantine", "telemetry_curated", "silver_telemetry", "silver_power",
    "silver_thermal", "silver_comms", "silver_orbital", "fact_telemetry",
]


# Two deliveries: the second brings the later days, half of one earlier day, and all of another day once more.
LATER = "(ts >= timestamp_ntz '2024-01-22' OR (date(ts) = date '2024-01-05' AND event_id % 2 = 0))"
REDELIVERED = "(date(ts) = date '2024-01-06')"

# Slices of five days in the order of their events; some events come two slices late, some once more with the next slice.
SLICES = 6
SLICE = "cast(least(floor((day(ts) - 1) / 5), 5) as int)"
LATE = "(event_id % 101 = 3)"
AGAIN = "(event_id % 7 = 0 AND day(ts) % 5 = 0 AND day(ts) < 30 AND hour(ts) = 23 AND minute(ts) >= 30)"


class Interrupted(Exception):
    """A run that dies, as a test of its repetition."""


class Breaking(Layers):
    """Layers whose writer dies before a table."""

    breaks_at: str

    def append(self, df: DataFrame, table: str, batch_id: str | None = None) -> None:
        if table == self.breaks_at:
            raise Interrupted(table)
        super().append(df, table, batch_id)


class Telemetry:
    """The layers of one data folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.events = read_events(spark, sf_dir)
        self.messages = messages(self.events)

    @property
    def checked(self) -> DataFrame:
        return ingest.validated(self.messages, AS_OF)

    @property
    def raw(self) -> DataFrame:
        return ingest.raw_envelope(self.messages, AS_OF)

    @property
    def quarantine(self) -> DataFrame:
        return ingest.quarantine(self.messages, AS_OF)

    @property
    def curated(self) -> DataFrame:
        return ingest.curated(self.messages, AS_OF)

    @property
    def accepted(self) -> DataFrame:
        return ingest.accepted(self.checked, AS_OF)

    @property
    def silver(self) -> DataFrame:
        return silver.silver_telemetry(self.curated)

    @property
    def comms(self) -> DataFrame:
        return silver.silver_comms(self.silver)

    @property
    def comm_health(self) -> DataFrame:
        return gold.gold_communication_health(self.comms)

    def completeness(self, readings_per_tick: int = 1) -> DataFrame:
        return gold.gold_data_completeness(
            self.silver, GRID_START, GRID_END, readings_per_tick=readings_per_tick)

    def rejected(self, code: str) -> DataFrame:
        rows = self.quarantine.filter(F.col("reason_code") == code)
        return rows.select(*fv.ID_FIELDS, "reason_detail", "raw_payload")

    def judged_by_dimension(self) -> DataFrame:
        """Reasons with the satellites taken from a table: those that the events name."""
        satellite = F.expr("concat('SAT-', lpad(string(user_id % 12 + 1), 2, '0'))").alias("satellite_id")
        checked = ingest.validated(self.messages, AS_OF, self.events.select(satellite))
        return checked.select(*fv.ID_FIELDS, "reason_code", "reason_detail")

    def curated_from_csv(self) -> DataFrame:
        """Write the received rows as CSV, then read, replay as messages and ingest them."""
        path = shared_dir(self.spark, "received-csv")
        received_csv_rows(self.events).write.option("header", True).csv(path)
        return ingest.curated(to_messages(read_received_csv(self.spark, path)), AS_OF)

    def refreshed(self) -> Layers:
        """Run the batch job into new layer folders."""
        layers = Layers(self.spark, shared_dir(self.spark, "layers"))
        refresh.refresh(self.messages, layers, AS_OF, GRID_START, GRID_END)
        return layers

    def redelivered(self) -> DataFrame:
        """Curated after the same messages came in two batches."""
        layers = Layers(self.spark, shared_dir(self.spark, "layers")).create()
        for _ in range(2):
            refresh.ingest_batch(self.messages, layers, AS_OF)
        return layers.read("telemetry_curated")

    def delivered(self, refresh_each: bool = True) -> Layers:
        """Layers after two deliveries, brought up to date after each."""
        layers = Layers(self.spark, shared_dir(self.spark, "layers")).create()
        for events in (self.events.filter(f"NOT {LATER}"), self.events.filter(f"{LATER} OR {REDELIVERED}")):
            refresh.ingest_batch(messages(events), layers, AS_OF)
            if refresh_each:
                refresh.refresh_days(layers, refresh.Grid(GRID_START, GRID_END))
        return layers

    def rerun(self) -> Layers:
        """Layers after a batch whose run died before each table in turn, and that was then run twice."""
        layers = Layers(self.spark, shared_dir(self.spark, "layers")).create()
        for table in ("telemetry_raw", "telemetry_quarantine", "telemetry_curated"):
            broken = Breaking(self.spark, layers.root)
            broken.breaks_at = table
            try:
                refresh.ingest_batch(self.messages, broken, AS_OF, "first")
            except Interrupted:
                continue
        for _ in range(2):
            refresh.ingest_batch(self.messages, layers, batch_id="first")
        return layers

    def sliced(self) -> DataFrame:
        """Messages as a stream of six micro-batches, in another session."""
        slices = [
            messages(self.events.filter(
                f"({SLICE} = {n} AND (NOT {LATE} OR {n >= SLICES - 2})) OR ({SLICE} = {n - 1} AND {AGAIN} AND (NOT {LATE} OR {n > SLICES - 2})) "
                f"OR ({SLICE} = {n - 2} AND {LATE})"
            ))
            for n in range(SLICES)
        ]
        files = replay.files_a_slice(self.spark)
        folder = replay.write_slices(slices, shared_dir(self.spark, "slices"), files)
        return replay.replay(prepare(self.spark.newSession()), folder, files)

    def sliced_rows(self, rows: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, int]:
        """What a stream over the slices wrote, and its late rows."""
        path = shared_dir(self.spark, "sliced")
        stream = rows(self.sliced())
        _, late = replay.run_to_end(stream, path, shared_dir(self.spark, "sliced-checkpoints"))
        return self.spark.read.schema(stream.schema).parquet(path), late

    def late_counts(self) -> DataFrame:
        stored, late = self.sliced_rows(lambda m: streaming.stream_curated(m, AS_OF))
        return stored.agg(F.lit(late).cast("long").alias("late_rows"), F.count("*").alias("stored_rows"))

    def fanned_out(self) -> Layers:
        """Layers after the one-pass stream over the slices, and after its first micro-batch came once more."""
        stream = self.sliced()
        layers = Layers(stream.sparkSession, shared_dir(self.spark, "layers"))
        for _ in range(2):  # the second run has a new checkpoint: it numbers its micro-batches as the first did
            checkpoint = shared_dir(self.spark, "fan-out-checkpoints")
            streaming.start_fan_out(stream, layers, checkpoint, as_of=AS_OF, trigger={"availableNow": True}).awaitTermination()
        return Layers(self.spark, layers.root)

    def streamed(self, table: str) -> DataFrame:
        """Run one table's stream over all events, then read what it wrote."""
        session = prepare(self.spark.newSession())
        events = (
            session.readStream.schema(EVENT_COLUMNS).option("pathGlobFilter", "events.parquet")
            .parquet(self.sf_dir)
        )
        layers = Layers(session, shared_dir(session, "stream-layers"))
        streaming.drain(
            messages(events), layers, shared_dir(session, "stream-checkpoints"), tables=[table], as_of=AS_OF)
        return Layers(self.spark, layers.root).read(table)


Query = Callable[[Telemetry], DataFrame]

QUERIES: dict[str, Query] = {
    # ingest
    "raw_envelope": lambda t: t.raw,
    "validate_reasons": lambda t: t.checked.select(*fv.ID_FIELDS, "reason_code", "reason_detail"),
    "reason_counts": lambda t: t.checked.groupBy("reason_code", "reason_detail").agg(
        F.count("*").alias("message_count")),
    "quarantine": lambda t: t.quarantine,
    "accepted_readings": lambda t: t.accepted,
    "curated": lambda t: t.curated,
    "curated_from_numbers": lambda t: ingest.curated(messages(t.events, numeric=True), AS_OF),
    "curated_from_booleans": lambda t: ingest.curated(messages(t.events, booleans=True), AS_OF),
    "curated_from_csv": lambda t: t.curated_from_csv(),
    "validate_reasons_by_dimension": lambda t: t.judged_by_dimension(),
    # silver
    "silver_telemetry": lambda t: t.silver,
    "silver_power": lambda t: silver.silver_power(t.silver),
    "silver_thermal": lambda t: silver.silver_thermal(t.silver),
    "silver_comms": lambda t: t.comms,
    "silver_orbital": lambda t: silver.silver_orbital(t.silver),
    # gold
    "dim_satellite": lambda t: gold.dim_satellite(t.accepted.select("satellite_id").distinct()),
    "dim_ground_station": lambda t: gold.dim_ground_station(t.accepted.select("ground_station_id").distinct()),
    "fact_telemetry": lambda t: gold.fact_telemetry(t.silver),
    "gold_satellite_health": lambda t: gold.gold_satellite_health(t.silver),
    "gold_communication_health": lambda t: t.comm_health,
    "gold_contact_gaps": lambda t: gold.gold_contact_gaps(t.silver),
    "gold_data_completeness": lambda t: t.completeness(),
    "gold_data_completeness_by_subsystem": lambda t: t.completeness(readings_per_tick=4),
    "gold_data_quality": lambda t: gold.gold_data_quality(t.quarantine),
    "gold_pipeline_quality": lambda t: gold.gold_pipeline_quality(t.raw, t.silver, t.quarantine),
    # reports
    "mission_operations_dashboard": lambda t: reports.mission_operations_dashboard(
        gold.gold_satellite_health(t.silver)),
    "communication_by_satellite": lambda t: reports.communication_by_satellite(t.comm_health),
    "weakest_communication_satellite": lambda t: reports.weakest_communication_satellite(t.comm_health),
    "satellite_telemetry_volume": lambda t: reports.satellite_telemetry_volume(t.silver),
    "battery_health": lambda t: reports.battery_health(silver.silver_power(t.silver)),
    "communication_signal": lambda t: reports.communication_signal(t.comms),
    "subsystem_alerts": lambda t: reports.subsystem_alerts(t.quarantine),
    "dataset_profile": lambda t: reports.dataset_profile(received_csv_rows(t.events)),
    "rows_per_satellite": lambda t: reports.rows_per_satellite(received_csv_rows(t.events)),
    # stored layers
    "stored_tables": lambda t: refresh.row_counts(t.refreshed(), STORED_TABLES),
    "stored_satellite_health": lambda t: t.refreshed().read("gold_satellite_health"),
    "stored_day_range": lambda t: t.refreshed().read("silver_telemetry", days=("2024-01-05", "2024-01-09")),
    "redelivered_batch": lambda t: t.redelivered(),
    "late_batch": lambda t: t.delivered(refresh_each=False).read("telemetry_curated"),
    "rerun_batch": lambda t: refresh.row_counts(t.rerun(), STORED_TABLES[:3]),
    "refreshed_silver_telemetry": lambda t: t.delivered().read("silver_telemetry"),
    "refreshed_communication_health": lambda t: t.delivered().read("gold_communication_health"),
    "refreshed_contact_gaps": lambda t: t.delivered().read("gold_contact_gaps"),
    "refreshed_data_completeness": lambda t: t.delivered().read("gold_data_completeness"),
    "refreshed_pipeline_quality": lambda t: t.delivered().read("gold_pipeline_quality"),
    # day tables and what merges over them
    "contact_gaps_from_segments": lambda t: gold.gaps_from_segments(gold.gold_gap_segments(t.silver)),
    "pipeline_quality_from_days": lambda t: gold.pipeline_quality_from_days(
        gold.gold_intake_days(t.raw, t.quarantine), gold.gold_quality_days(t.silver)),
    "estimated_events": lambda t: gold.estimated_events(gold.gold_quality_days(t.silver)).drop("estimated_events"),
    # streams
    "stream_raw": lambda t: t.streamed("telemetry_raw"),
    "stream_quarantine": lambda t: t.streamed("telemetry_quarantine"),
    "stream_curated": lambda t: t.streamed("telemetry_curated").drop("message_id", "received_timestamp"),
    "stream_windows": lambda t: t.sliced_rows(lambda m: streaming.window_metrics(m, AS_OF))[0].drop("max_latency_ms"),
    "stream_in_order": lambda t: t.sliced_rows(lambda m: streaming.stream_curated(m, AS_OF))[0].drop("message_id", "received_timestamp"),
    "stream_late_counts": lambda t: t.late_counts(),
    "stream_fan_out": lambda t: refresh.row_counts(t.fanned_out(), STORED_TABLES[:3]),
    "stream_fan_out_curated": lambda t: t.fanned_out().read("telemetry_curated").drop("message_id", "received_timestamp"),
}
for _code in fv.REASON_CODES:
    QUERIES[f"reject_{_code.lower()}"] = lambda t, code=_code: t.rejected(code)


def without_zone(df: DataFrame) -> DataFrame:
    """UTC timestamps as plain timestamps, the type that the given tables use."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(QUERIES[name](Telemetry(spark, sf_dir)))
