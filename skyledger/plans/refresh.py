"""The batch job: store a batch of messages in the base tables, then bring silver and gold up to date.

A batch touches a few days. Tables by day are rebuilt for these alone, from the stored rows of these days;
tables over all days are rebuilt from small day tables. ``rebuild`` makes everything anew.
"""

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, functions as F

from skyledger import fixed_values as fv
from skyledger.operators.dedup import dedup_batch, event_days, without_known
from skyledger.plans import gold, ingest, silver
from skyledger.session import remove_folder, shared_dir
from skyledger.sources.layers import Layers

PARALLEL_TABLES = 4


def stage(messages: DataFrame, path: str, as_of: str | None = None) -> DataFrame:
    """Parse and validate once, and keep the outcome in a shared folder, ``path``: raw, quarantine and curated start here."""
    checked = ingest.validated(messages, as_of).withColumn("is_valid", F.col("reason_code").isNull())
    checked.write.partitionBy("is_valid").parquet(path)
    return messages.sparkSession.read.schema(checked.schema).parquet(path)


def ingest_batch(messages: DataFrame, layers: Layers, as_of: str | None = None, batch_id: str | None = None) -> bool:
    """raw, quarantine and curated. Readings that an earlier batch stored are not stored again.

    A batch with an id is stored once: a repeated run of a stored batch does nothing and returns False; a run
    after one that died first removes what that one left, and goes by its clock.
    """
    batch_id = batch_id or uuid.uuid4().hex
    note, died = layers.ledger.begin(batch_id, as_of)
    if note is None:
        return False
    if died:
        layers.forget(batch_id)
    path = shared_dir(messages.sparkSession, "validated")
    try:
        staged = stage(messages, path, note.clock)
        layers.append(ingest.enveloped(staged, note.clock), "telemetry_raw", batch_id)
        layers.append(ingest.quarantined(staged.filter(~F.col("is_valid")), note.clock), "telemetry_quarantine", batch_id)
        new = ingest.accepted(staged.filter("is_valid"), note.clock)
        days = event_days(new)
        unseen = without_known(dedup_batch(new), layers.read("telemetry_curated", days))
        layers.append(unseen, "telemetry_curated", batch_id)
    finally:
        remove_folder(messages.sparkSession, path)
    layers.ledger.commit(batch_id, replace(note, event_days=days, arrival_days=[note.clock[:10]]))
    return True


# --- silver and gold --------------------------------------------------------------------------

@dataclass(frozen=True)
class Grid:
    """What completeness expects: the grid's ends, and what else ``gold_data_completeness`` takes."""

    start: str = fv.GRID_START
    end: str = fv.GRID_END
    options: dict = field(default_factory=dict)  # fleet, minutes a step, readings a tick


def _replace_all(layers: Layers, tables: dict[str, DataFrame], days: list[str] | None = None) -> None:
    """Rebuild tables that do not depend on each other, some at a time: many are too small to fill a cluster."""
    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        for done in [pool.submit(layers.replace, table, name, days) for name, table in tables.items()]:
            done.result()


def build_event_days(layers: Layers, days: list[str] | None = None) -> None:
    """The tables by event day, for some days or all: each reads no other days than it writes."""
    layers.replace(silver.silver_telemetry(layers.read("telemetry_curated", days)), "silver_telemetry", days)
    telemetry = layers.read("silver_telemetry", days)
    splits = (silver.silver_power, silver.silver_thermal, silver.silver_comms, silver.silver_orbital)
    _replace_all(layers, {build.__name__: build(telemetry) for build in splits} | {
        "fact_telemetry": gold.fact_telemetry(telemetry),
        "gold_satellite_health": gold.gold_satellite_health(telemetry),
        "gold_gap_segments": gold.gold_gap_segments(telemetry),
        "gold_quality_days": gold.gold_quality_days(telemetry),
    }, days)
    layers.replace(gold.gold_communication_health(layers.read("silver_comms", days)), "gold_communication_health", days)


def build_arrival_days(layers: Layers, days: list[str] | None = None) -> None:
    """The tables by day of arrival."""
    raw, quarantine = layers.read("telemetry_raw", days), layers.read("telemetry_quarantine", days)
    _replace_all(layers, {
        "gold_intake_days": gold.gold_intake_days(raw, quarantine),
        "gold_data_quality": gold.gold_data_quality(quarantine),
    }, days)


def build_totals(layers: Layers, grid: Grid = Grid()) -> None:
    """The tables over all days, from day tables: their cost does not grow with the readings of a day."""
    spark = layers.spark
    satellites = grid.options.get("satellites", fv.SATELLITES)
    _replace_all(layers, {
        "dim_satellite": gold.dim_satellite(gold.inline_ids(spark, "satellite_id", satellites)),
        "dim_ground_station": gold.dim_ground_station(
            gold.inline_ids(spark, "ground_station_id", fv.GROUND_STATIONS)),
        "gold_contact_gaps": gold.gaps_from_segments(layers.read("gold_gap_segments")),
        "gold_data_completeness": gold.completeness_from_health(
            layers.read("gold_satellite_health"), grid.start, grid.end, **grid.options),
        "gold_pipeline_quality": gold.pipeline_quality_from_days(
            layers.read("gold_intake_days"), layers.read("gold_quality_days")),
    })


def refresh_days(layers: Layers, grid: Grid = Grid()) -> tuple[list[str], list[str]]:
    """Bring silver and gold up to date with all committed batches; the event days and arrival days rebuilt.

    The days come from the ledger. A run that died is made good by the next one: days are settled last.
    """
    owed = layers.ledger.owed()
    events = sorted({day for note in owed.values() for day in note.event_days})
    arrivals = sorted({day for note in owed.values() for day in note.arrival_days})
    first = not layers.exists("gold_pipeline_quality")
    if owed or first:
        build_event_days(layers, events)
        build_arrival_days(layers, arrivals)
        build_totals(layers, grid)
    layers.ledger.settle(list(owed))
    return events, arrivals


def rebuild(layers: Layers, grid: Grid = Grid()) -> None:
    """Make silver and gold anew from all stored rows, for instance after a change of their definition."""
    owed = list(layers.ledger.owed())
    build_event_days(layers)
    build_arrival_days(layers)
    build_totals(layers, grid)
    layers.ledger.settle(owed)


def refresh(
    messages: DataFrame, layers: Layers, as_of: str | None = None,
    grid_start: str = fv.GRID_START, grid_end: str = fv.GRID_END, batch_id: str | None = None, **options,
) -> None:
    """One run of everything: store the batch, then rebuild what it touched."""
    layers.create()
    ingest_batch(messages, layers, as_of, batch_id)
    refresh_days(layers, Grid(grid_start, grid_end, options))


def row_counts(layers: Layers, tables: list[str]) -> DataFrame:
    """(table_name, row_count) of stored tables."""
    counts = [layers.read(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("row_count")) for t in tables]
    stacked = counts[0]
    for count in counts[1:]:
        stacked = stacked.unionByName(count)
    return stacked
