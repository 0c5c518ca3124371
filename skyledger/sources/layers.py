"""Layer tables as Parquet folders: ``<root>/<layer>/<table>``, day-partitioned and sorted by cluster keys.

Three kinds of table:

* *appended* (they have a declared schema): ``partition_date=…/batch_id=…``. Rows of open batches are left out.
* *by day*: ``version=…/partition_date=…`` and a manifest that names one version for each day. A rebuild of some
  days writes these alone and a new manifest; the files of all other days stay.
* *whole*: ``v1``, ``v2``, …, the newest finished one counts.

An appended table that a stream fills has no batches; the stream's own log says which files count. Its days can be
*closed*: their many small files are rewritten as a table by day, ``<table>_closed``, sorted by cluster keys, and readers
take closed days from there. The stream's files and log stay as they are.

A reader keeps what it has opened: the version before the newest is removed one rebuild later.
"""

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger import schemas
from skyledger.session import remove_folder
from skyledger.sources.folders import Folders
from skyledger.sources.ledger import Ledger

DAY = "partition_date"
BATCH = "batch_id"
VERSION = "version"
CLOSED = "_closed"


@dataclass(frozen=True)
class Layout:
    """Where a table lives, the column whose UTC day partitions it, and its cluster keys.

    ``gather`` brings the rows of a day together before the write. It is left out where rows already
    come day by day: a batch has one ingestion day, and tables derived from day folders read these.
    """

    layer: str
    day_of: str | None = None
    cluster: tuple[str, ...] = ()
    schema: T.StructType | None = None
    gather: bool = False


_BY_STATION = ("satellite_id", "ground_station_id")

LAYOUTS = {
    "telemetry_raw": Layout(
        "raw", "ingestion_timestamp", ("satellite_id", "ground_station_id", "subsystem"), schemas.RAW),
    "telemetry_quarantine": Layout(
        "quarantine", "quarantined_at", ("satellite_id", "reason_code"), schemas.QUARANTINE, gather=True),
    "telemetry_curated": Layout(  # by event day: later batches and rebuilds look up the days they touch
        "curated", "event_timestamp", ("satellite_id", "ground_station_id", "subsystem"), schemas.CURATED, gather=True),
    "silver_telemetry": Layout("silver", "event_timestamp", ("satellite_id", "subsystem", "ground_station_id")),
    "silver_power": Layout("silver", "event_timestamp", _BY_STATION),
    "silver_thermal": Layout("silver", "event_timestamp", _BY_STATION),
    "silver_comms": Layout("silver", "event_timestamp", _BY_STATION),
    "silver_orbital": Layout("silver", "event_timestamp", _BY_STATION),
    "dim_satellite": Layout("gold"),
    "dim_ground_station": Layout("gold"),
    "fact_telemetry": Layout(
        "gold", "event_timestamp", ("satellite_id", "subsystem", "ground_station_id")),
    "gold_satellite_health": Layout("gold", "metric_date", ("satellite_id",), gather=True),
    "gold_communication_health": Layout("gold", "metric_date", ("satellite_id",), gather=True),
    "gold_gap_segments": Layout("gold", "event_date", ("satellite_id",), gather=True),
    "gold_quality_days": Layout("gold", "event_date"),
    "gold_intake_days": Layout("gold", "arrival_date"),
    "gold_contact_gaps": Layout("gold"),
    "gold_data_completeness": Layout("gold"),
    "gold_data_quality": Layout("gold", "quarantine_date"),
    "gold_pipeline_quality": Layout("gold"),
}
LAYER_NAMES = ["raw", "quarantine", "curated", "silver", "gold"]


def arranged(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows as they are stored: one day per partition folder, sorted by cluster keys in each file.

    ``rebalance`` brings a day's rows together, and AQE splits a day that is too large for one task,
    so a day with a third of all rows is written by many tasks.
    """
    if not layout.day_of:
        return df
    dated = df.withColumn(DAY, F.to_date(layout.day_of))
    if layout.gather:
        dated = dated.hint("rebalance", DAY)
    return dated.sortWithinPartitions(DAY, *layout.cluster)


class Layers:
    """All tables of one installation, below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folders = Folders(spark)
        self.ledger = Ledger(spark, self.root)

    def folder(self, table: str) -> str:
        return f"{self.root}/{LAYOUTS[table.removesuffix(CLOSED)].layer}/{table}"

    # --- versions and manifests ---------------------------------------------------------------

    def _is_by_day(self, table: str) -> bool:
        return table.endswith(CLOSED) or (LAYOUTS[table].schema is None and LAYOUTS[table].day_of is not None)

    def path(self, table: str) -> str:
        """Where the rows of a table are now: its folder, or the newest finished version of a whole table."""
        whole = [number for number, done in self._versions(table) if done]
        return f"{self.folder(table)}/v{whole[-1]}" if whole else self.folder(table)

    def _versions(self, table: str) -> list[tuple[int, bool]]:
        """(number, written to the end) of a whole table's versions. Spark marks a folder last of all, when it commits."""
        if LAYOUTS[table].schema is not None or self._is_by_day(table):
            return []
        numbers = sorted(int(name[1:]) for name in self.folders.names(self.folder(table)) if name[:1] == "v" and name[1:].isdigit())
        return [(number, self.folders.exists(f"{self.folder(table)}/v{number}/_SUCCESS")) for number in numbers]

    def _manifests(self, table: str) -> list[int]:
        names = self.folders.names(f"{self.folder(table)}/_manifests")
        return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())

    def _manifest(self, table: str, number: int) -> dict:
        return json.loads(self.folders.get(f"{self.folder(table)}/_manifests/{number}.json"))

    def day_versions(self, table: str) -> dict[str, int]:
        """The version that counts for each day of a table by day."""
        numbers = self._manifests(table)
        return self._manifest(table, numbers[-1])["days"] if numbers else {}

    def _day_path(self, table: str, day: str, version: int) -> str:
        return f"{self.folder(table)}/{VERSION}={version}/{DAY}={day}"

    # --- reading ------------------------------------------------------------------------------

    def create(self) -> "Layers":
        """Make the append tables, empty, so that readers and appends find them."""
        for table, layout in LAYOUTS.items():
            if layout.schema is not None and not self.exists(table):
                empty = self.spark.createDataFrame([], layout.schema)
                empty.withColumns({DAY: F.to_date(layout.day_of), BATCH: F.lit("")}).write.partitionBy(DAY, BATCH).mode("ignore").parquet(self.folder(table))
        return self

    def exists(self, table: str) -> bool:
        return bool(self._manifests(table)) if self._is_by_day(table) else self.folders.exists(self.path(table))

    def _is_streamed(self, table: str) -> bool:
        """A stream's own log says which files count; files of other writers would not be read."""
        return self.folders.exists(f"{self.folder(table)}/_spark_metadata")

    def expect_stream_table(self, table: str) -> None:
        """A stream may start a new table or go on with its own, not with one that batches filled."""
        if self.exists(table) and not self._is_streamed(table) and self.read(table).inputFiles():
            raise ValueError(f"table {table} holds batch files; give the stream its own root")

    def read(self, table: str, days: tuple[str, str] | list[str] | None = None, batch_id: str | None = None) -> DataFrame:
        """The table's own columns. ``days`` reads only the folders of these days: a range as a tuple, or a list.

        ``batch_id`` reads the rows of one batch, whether it counts yet or not.
        """
        layout = LAYOUTS[table]
        if days is not None and not layout.day_of:
            raise ValueError(f"table {table} is not stored by day")
        stored = self._by_day(table, days) if self._is_by_day(table) else self._appended(table, days, batch_id) if layout.schema else None
        if stored is None:
            return self.spark.read.parquet(self.path(table))
        if days is not None:
            day = F.col(DAY)
            stored = stored.filter(
                day.between(*[F.lit(d).cast("date") for d in days]) if isinstance(days, tuple) else day.isin([F.lit(d).cast("date") for d in days]))
        return stored.drop(DAY, BATCH, VERSION)

    def _by_day(self, table: str, days) -> DataFrame:
        numbers = self._manifests(table)
        if not numbers:
            raise ValueError(f"table {table} does not exist")
        manifest = self._manifest(table, numbers[-1])
        schema = T.StructType.fromJson(json.loads(manifest["schema"])).add(VERSION, T.IntegerType()).add(DAY, T.DateType())
        wanted = [day for day in sorted(manifest["days"]) if days is None or (days[0] <= day <= days[1] if isinstance(days, tuple) else day in set(days))]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [self._day_path(table, day, manifest["days"][day]) for day in wanted]
        return self.spark.read.schema(schema).option("basePath", self.folder(table)).parquet(*paths)

    def _appended(self, table: str, days, batch_id: str | None) -> DataFrame:
        folder, streamed = self.folder(table), self._is_streamed(table)
        partitions = [T.StructField(DAY, T.DateType())] + [T.StructField(BATCH, T.StringType())] * (not streamed)
        reader = self.spark.read.schema(T.StructType(LAYOUTS[table].schema.fields + partitions))
        if streamed:
            live, closed = reader.parquet(folder), sorted(self.day_versions(f"{table}{CLOSED}"))
            if not closed:
                return live
            rest = live.filter(~F.col(DAY).isin([F.lit(day).cast("date") for day in closed]))
            return rest.unionByName(self._by_day(f"{table}{CLOSED}", days).select(rest.columns))
        paths = [folder]
        if isinstance(days, list):  # only these folders are listed
            paths = [path for path in (f"{folder}/{DAY}={day}" for day in days) if self.folders.exists(path)]
            if not paths:
                return self.spark.createDataFrame([], T.StructType(LAYOUTS[table].schema.fields + partitions))
        stored = reader.option("basePath", folder).parquet(*paths)
        if batch_id is not None:
            return stored.filter(F.col(BATCH) == batch_id)
        hidden = self.ledger.open_batches()
        return stored.filter(~F.col(BATCH).isin(hidden)) if hidden else stored

    # --- writing ------------------------------------------------------------------------------

    def append(self, df: DataFrame, table: str, batch_id: str | None = None) -> None:
        """Add rows to an existing table with a declared schema, under the id of their batch (else a new one)."""
        if not self.exists(table):
            raise ValueError(f"table {table} does not exist; appends do not create tables")
        if self._is_streamed(table):
            raise ValueError(f"table {table} belongs to a stream; give batches their own root")
        layout = LAYOUTS[table]
        rows = arranged(schemas.conform(df, layout.schema), layout).withColumn(BATCH, F.lit(batch_id or uuid.uuid4().hex))
        rows.write.mode("append").partitionBy(DAY, BATCH).parquet(self.folder(table))

    def close_days(self, table: str, days: list[str]) -> None:
        """Rewrite days of a stream's table to which no row can come any more, in few sorted files.

        That is so for curated once the watermark has passed a day, and for the other tables once the day is over.
        A closed day does not change: closing it again does nothing.
        """
        if not self._is_streamed(table):
            raise ValueError(f"table {table} has no stream")
        name = f"{table}{CLOSED}"
        known = self.day_versions(name)
        new = [day for day in days if day not in known]
        if new:
            self._replace_days(self.read(table, new).hint("rebalance", LAYOUTS[table].day_of), name, new)

    def forget(self, batch_id: str) -> None:
        """Remove what a run that died has stored of an open batch."""
        if self.ledger.is_done(batch_id):
            raise ValueError(f"batch {batch_id} counts already")
        for table, layout in LAYOUTS.items():
            if layout.schema is not None:
                for day in self.folders.names(self.folder(table)):
                    path = f"{self.folder(table)}/{day}/{BATCH}={batch_id}"
                    if day.startswith(f"{DAY}=") and self.folders.exists(path):
                        self.folders.remove(path)

    def replace(self, df: DataFrame, table: str, days: list[str] | None = None) -> None:
        """Rebuild a table, or of a table by day only ``days``, beside the version that readers still use.

        A write that fails leaves the old version in place. One writer a table at a time.
        """
        if LAYOUTS[table].schema is not None:
            raise ValueError(f"table {table} is appended to, not replaced")
        if self._is_by_day(table):
            self._replace_days(df, table, days)
        elif days is not None:
            raise ValueError(f"table {table} is not stored by day")
        else:
            self._replace_whole(df, table)

    def _replace_whole(self, df: DataFrame, table: str) -> None:
        before = self._versions(table)
        number = before[-1][0] + 1 if before else 1
        df.write.mode("errorifexists").parquet(f"{self.folder(table)}/v{number}")
        kept = max((old for old, done in before if done), default=None)
        for old, _ in before:
            if old != kept:
                remove_folder(self.spark, f"{self.folder(table)}/v{old}")

    def _replace_days(self, df: DataFrame, table: str, days: list[str] | None) -> None:
        folder, manifests = self.folder(table), self._manifests(table)
        held = {name for name in self.folders.names(folder) if name.startswith(f"{VERSION}=")}
        number = max([0, *manifests, *(int(name.partition("=")[2]) for name in held)]) + 1
        rows = arranged(df, LAYOUTS[table.removesuffix(CLOSED)])
        if days is not None:
            rows = rows.filter(F.col(DAY).isin([F.lit(d).cast("date") for d in days]))
        rows.write.partitionBy(DAY).parquet(f"{folder}/{VERSION}={number}")
        written = [name.partition("=")[2] for name in self.folders.names(f"{folder}/{VERSION}={number}") if name.startswith(f"{DAY}=")]
        old = self.day_versions(table) if days is not None else {}
        now = {day: version for day, version in old.items() if day not in set(days or ())} | dict.fromkeys(written, number)
        self.folders.put(f"{folder}/_manifests/{number}.json", json.dumps({"schema": df.schema.json(), "days": now}))
        self._drop_unused(table, [*manifests, number], held)

    def _drop_unused(self, table: str, manifests: list[int], held: set[str]) -> None:
        """Day folders that only manifests before the last two name go, and versions that neither of these names."""
        used = set().union(*(self._manifest(table, number)["days"].items() for number in manifests[-2:]))
        versions = {f"{VERSION}={version}" for _, version in used}
        for number in manifests[:-2]:
            for day, version in set(self._manifest(table, number)["days"].items()) - used:
                if f"{VERSION}={version}" in versions:
                    self.folders.remove(self._day_path(table, day, version))
            self.folders.remove(f"{self.folder(table)}/_manifests/{number}.json")
        for name in held - versions:
            self.folders.remove(f"{self.folder(table)}/{name}")

    # --- names --------------------------------------------------------------------------------

    def publish(self, prefix: str = "") -> list[str]:
        """Make every stored table readable by name: database per layer, table over its folders.

        A name keeps to the versions it was published with, so publish after each refresh.
        """
        published = []
        for layer in LAYER_NAMES:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}`")
        for table, layout in LAYOUTS.items():
            if not self.exists(table):
                continue
            name = f"{prefix}{layout.layer}.{table}"
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            if not layout.day_of:
                self.spark.catalog.createTable(name, path=self.path(table), source="parquet")
            else:
                self._publish_days(name, table)
            published.append(name)
        return published

    def _publish_days(self, name: str, table: str) -> None:
        """A partitioned table whose partitions are the folders that count."""
        own = self.read(table).schema
        partitions = {DAY: "date"} if self._is_by_day(table) or self._is_streamed(table) else {DAY: "date", BATCH: "string"}
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.fields) + "".join(f", `{n}` {t}" for n, t in partitions.items())
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(partitions)}) LOCATION '{self.folder(table)}'")
        if not self._is_by_day(table):
            self.spark.catalog.recoverPartitions(name)
            for batch in self.ledger.open_batches():
                for row in self.spark.sql(f"SHOW PARTITIONS {name} PARTITION ({BATCH} = '{batch}')").collect():
                    spec = ", ".join("{} = '{}'".format(*part.split("=", 1)) for part in row.partition.split("/"))
                    self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
            return
        added = "".join(f" PARTITION ({DAY} = '{day}') LOCATION '{self._day_path(table, day, version)}'" for day, version in sorted(self.day_versions(table).items()))
        if added:
            self.spark.sql(f"ALTER TABLE {name} ADD{added}")
