"""The same results in DuckDB SQL, written independently of the Spark code.

``WITH`` parts build on each other: messages -> judged -> accepted -> curated -> silver. A query names
the last part it needs.
"""

from skyledger import fixed_values as fv
from skyledger.workload.telemetry import AS_OF, GRID_END, GRID_START

_SIX_DIGITS = "%Y-%m-%dT%H:%M:%S.%fZ"


def _measure(subsystem, modulus, factor, start, faults=None):
    """Text of a measure: start + (event_id % modulus) * factor, or the text of a fault."""
    value = f"cast({start} as double) + (event_id % {modulus}) * cast({factor} as double)"
    return _measure_text(subsystem, value, faults)


def _measure_text(subsystem, value, faults=None):
    branches = "".join(
        f" when d = {fault} then {'null' if text is None else repr(text)}" for fault, text in (faults or {}).items()
    )
    text = f"cast(cast({value} as decimal(24,16)) as varchar)"
    return f"case when sub <> '{subsystem}' then null{branches} else {text} end"


_MEASURES = {
    "battery_voltage_v": _measure("POWER", 64, 0.015625, 27.5, {8: "-40", 9: None}),
    "battery_current_a": _measure("POWER", 32, 0.015625, 1.75, {10: "N/A"}),
    "solar_output_w": _measure("POWER", 480, 0.25, 80),
    "internal_temp_c": _measure("THERMAL", 48, 0.125, 18, {8: "700", 9: None}),
    "external_temp_c": _measure("THERMAL", 320, 0.25, -60, {10: "N/A"}),
    "signal_strength_dbm": _measure_text("COMMS", "signal", {8: "30", 9: None}),
    "bit_error_rate": _measure("COMMS", 128, 0.0000152587890625, 0, {10: "N/A"}),
    "latitude": "case when d = 16 then 'abc' else "
                + _measure("ORBITAL", 412, 0.25, -51.5, {9: None}) + " end",
    "longitude": _measure("ORBITAL", 1440, 0.25, -180),
    "altitude_km": _measure("ORBITAL", 160, 0.125, 530, {8: "-250"}),
    "velocity_kms": _measure("ORBITAL", 16, 0.015625, 7.5, {10: "N/A"}),
}
_OWN = {
    "POWER": [("battery_voltage_v", 20, 35), ("battery_current_a", 0, 10), ("solar_output_w", 0, 1000)],
    "THERMAL": [("internal_temp_c", -100, 100), ("external_temp_c", -200, 150)],
    "COMMS": [("signal_strength_dbm", -150, 0), ("bit_error_rate", 0, 1)],
    "ORBITAL": [("latitude", -90, 90), ("longitude", -180, 180), ("altitude_km", 0, 2000), ("velocity_kms", 0, 15)],
}
_FIELDS = [
    "message_id", "satellite_id", "ground_station_id", "subsystem", "event_timestamp", "received_timestamp",
    "battery_voltage_v", "battery_current_a", "solar_output_w", "internal_temp_c", "external_temp_c",
    "signal_strength_dbm", "bit_error_rate", "comm_status", "latitude", "longitude", "altitude_km", "velocity_kms",
]

_ROWS = f"""
copies as (
  select event_id, ts, user_id, event_type, unnest(case when event_id % 33 = 5 then [0, 1] else [0] end) as copy
  from events
), base as (
  select *,
    case when event_id % 50 = 7 then (event_id % 400) // 50 + 1
         when event_id % 50 = 23 then (event_id % 400) // 50 + 9 else 0 end as d,
    case event_type when 'click' then 'POWER' when 'view' then 'THERMAL' when 'error' then 'ORBITAL'
         else 'COMMS' end as sub,
    case when user_id % 12 = 10 then cast(-110 as double) + (event_id % 176) * cast(0.125 as double)
         else cast(-75 as double) + (event_id % 200) * cast(0.125 as double) end as signal
  from copies
), received as (
  select d, event_id, ts,
    case when d = 15 then '' else concat(case when copy = 0 then 'm' else 'd' end, event_id) end as message_id,
    case when d = 1 then null when d = 2 then 'SAT-99'
         else concat('SAT-', lpad(cast(user_id % 12 + 1 as varchar), 2, '0')) end as satellite_id,
    case when d = 3 then 'GS-9' else concat('GS-', event_id % 4 + 1) end as ground_station_id,
    case when d = 4 then 'PAYLOAD' else sub end as subsystem,
    case when d = 5 then 'not-a-time' when d = 6 then '2100-01-01T00:00:00Z'
         else strftime(ts, '{_SIX_DIGITS}') end as event_timestamp,
    strftime(ts + to_milliseconds(case when d = 7 then -5000
                                       else 1000 + (event_id * 37) % 7000 + copy * 1500 end), '{_SIX_DIGITS}')
      as received_timestamp,
    {", ".join(f"{text} as {name}" for name, text in _MEASURES.items())},
    case when sub <> 'COMMS' then null when d = 11 then 'UNKNOWN'
         when d = 12 then case when signal >= -80 then 'LOST' else 'NOMINAL' end
         when signal >= -80 then 'NOMINAL' when signal >= -95 then 'DEGRADED' else 'LOST' end as comm_status,
    case when d > 0 then 'true' else 'false' end as is_malformed,
    case when copy = 1 then 'true' else 'false' end as is_duplicate
  from base
)"""

_PAYLOAD = "cast(to_json({" + ", ".join(f"'{f}': {f}" for f in _FIELDS) + "}) as varchar)"


def _messages(broken: bool = True) -> str:
    payload = f"""case d when 13 then left({_PAYLOAD}, length({_PAYLOAD}) - 1)
                         when 14 then '[' || {_PAYLOAD} || ']' else {_PAYLOAD} end""" if broken else _PAYLOAD
    return f"messages as (select *, {payload} as raw_payload from received)"


def _range_cases():
    for subsystem, columns in _OWN.items():
        for name, low, high in columns:
            yield f"when subsystem = '{subsystem}' and n_{name} is null", "INVALID_NUMERIC_TYPE", f"'{subsystem}'"
            yield (f"when subsystem = '{subsystem}' and not (n_{name} between {low} and {high} and not isnan(n_{name}))",
                   "OUT_OF_PHYSICAL_RANGE", f"'{name}'")
        if subsystem == "COMMS":
            yield ("when subsystem = 'COMMS' and coalesce(comm_status, 'None') not in ('NOMINAL', 'DEGRADED', 'LOST')",
                   "INVALID_COMM_STATUS", "coalesce(comm_status, 'None')")
            signal = "n_signal_strength_dbm"
            for test, status, text in [
                (f"{signal} >= -80", "NOMINAL", "Signal >= -80 dBm must be NOMINAL"),
                (f"{signal} >= -95 and {signal} < -80", "DEGRADED",
                 "Signal between -95 and -80 dBm must be DEGRADED"),
                (f"{signal} < -95", "LOST", "Signal below -95 dBm must be LOST"),
            ]:
                yield (f"when subsystem = 'COMMS' and {test} and comm_status <> '{status}'",
                       "INCONSISTENT_COMM_STATUS", f"'{text}'")


def _cases():
    yield "when not json_valid(raw_payload)", "INVALID_JSON", "'Payload is not valid JSON'"
    yield "when left(raw_payload, 1) <> '{'", "INVALID_JSON", "'Payload must be a JSON object'"
    for name in _FIELDS[:6]:
        yield f"when coalesce({name}, '') = ''", "MISSING_REQUIRED_FIELD", f"'{name}'"
    satellites = ", ".join(f"'SAT-{n:02d}'" for n in range(1, 13))
    yield f"when satellite_id not in ({satellites})", "INVALID_SATELLITE", "satellite_id"
    yield "when ground_station_id not in ('GS-1', 'GS-2', 'GS-3', 'GS-4')", "INVALID_GROUND_STATION", "ground_station_id"
    yield "when subsystem not in ('POWER', 'THERMAL', 'COMMS', 'ORBITAL')", "INVALID_SUBSYSTEM", "subsystem"
    for name, short in (("event_timestamp", "event_at"), ("received_timestamp", "received_at")):
        text = f"concat('Invalid isoformat string: ''', replace({name}, 'Z', '+00:00'), '''')"
        yield f"when {short} is null", "INVALID_TIMESTAMP", text
    yield f"when event_at > timestamp '{AS_OF}'", "FUTURE_EVENT_TIMESTAMP", "event_timestamp"
    yield "when received_at < event_at", "INVALID_RECEIVED_TIMESTAMP", "'received_timestamp is before event_timestamp'"
    yield from _range_cases()
    stray = " or ".join(f"(coalesce({n}, '') <> '' and n_{n} is null)" for n in _MEASURES)
    yield f"when {stray}", "INVALID_NUMERIC_TYPE", "subsystem"


_JUDGED = f"""
typed as (
  select *, try_cast(replace(event_timestamp, 'Z', '') as timestamp) as event_at,
    try_cast(replace(received_timestamp, 'Z', '') as timestamp) as received_at,
    {", ".join(f"try_cast({n} as double) as n_{n}" for n in _MEASURES)}
  from messages
), judged as (
  select *,
    case {" ".join(f"{test} then '{code}'" for test, code, _ in _cases())} end as reason_code,
    case {" ".join(f"{test} then {detail}" for test, _, detail in _cases())} end as reason_detail
  from typed
)"""

_KEY_MEMBERS = {n: f"""'"{n}":' || coalesce(cast(n_{n} as varchar), 'null')""" for n in _MEASURES} | {
    n: f"""'"{n}":' || coalesce('"' || {n} || '"', 'null')"""
    for n in ("satellite_id", "ground_station_id", "subsystem", "event_timestamp", "comm_status")
}
_KEY = "sha256('{' || " + " || ',' || ".join(_KEY_MEMBERS[n] for n in sorted(_KEY_MEMBERS)) + " || '}')"

_ACCEPTED = f"""
accepted as (
  select message_id, {_KEY} as dedup_key, satellite_id, ground_station_id, subsystem,
    event_at as event_timestamp, received_at as received_timestamp,
    {", ".join(f"n_{n} as {n}" for n in _MEASURES)}, comm_status,
    timestamp '{AS_OF}' as ingestion_timestamp, '1.0.0' as pipeline_version,
    ground_station_id as source_ground_station
  from judged where reason_code is null
)"""
_CURATED = """
curated as (
  select * exclude (copy_rank) from (
    select *, row_number() over (partition by dedup_key order by received_timestamp, message_id) as copy_rank
    from accepted) where copy_rank = 1
)"""
_SILVER = """
silver as (
  select *, datesub('millisecond', event_timestamp, received_timestamp) as latency_ms from curated
)"""

_VALID_ID = "case when reason_code = 'INVALID_JSON' then null else {0} end as {0}"
_IDS = ", ".join(_VALID_ID.format(n) for n in _FIELDS[:4])
_QUARANTINE = f"""
quarantine as (
  select {_IDS}, case when reason_code <> 'INVALID_JSON' then event_at end as event_timestamp,
    reason_code, reason_detail, timestamp '{AS_OF}' as quarantined_at, '1.0.0' as pipeline_version, raw_payload
  from judged where reason_code is not null
)"""

_CHAIN = {
    "received": _ROWS, "messages": _messages(), "judged": _JUDGED, "quarantine": _QUARANTINE,
    "accepted": _ACCEPTED, "curated": _CURATED, "silver": _SILVER,
}


def query(select: str, *, whole_json: bool = False) -> str:
    """``select`` over the chain of parts. ``whole_json`` leaves the payloads unbroken."""
    parts = dict(_CHAIN)
    if whole_json:
        parts["messages"] = _messages(broken=False)
    return "with " + ",\n".join(part.strip() for part in parts.values()) + "\n" + select.strip()


def _round(value: str, digits: int) -> str:
    return f"cast(round(cast(cast({value} as varchar) as decimal(30,15)), {digits}) as double)"


def _ratio(part: str, whole: str) -> str:
    return f"cast({part} as double) / nullif({whole}, 0)"


_HEALTH = f"""
daily as (
  select cast(event_timestamp as date) as metric_date, satellite_id, count(*) as telemetry_rows,
    cast(count_if(subsystem = 'POWER') as bigint) as power_readings, cast(count_if(subsystem = 'THERMAL') as bigint) as thermal_readings,
    cast(count_if(subsystem = 'COMMS') as bigint) as comms_readings, cast(count_if(subsystem = 'ORBITAL') as bigint) as orbital_readings,
    avg(battery_voltage_v) filter (subsystem = 'POWER') as avg_battery_voltage_v,
    avg(internal_temp_c) filter (subsystem = 'THERMAL') as avg_internal_temp_c,
    avg(signal_strength_dbm) filter (subsystem = 'COMMS') as avg_signal_strength_dbm,
    avg(bit_error_rate) filter (subsystem = 'COMMS') as avg_bit_error_rate,
    cast(count_if(subsystem = 'COMMS' and comm_status = 'DEGRADED') as bigint) as degraded_comms_count,
    cast(count_if(subsystem = 'COMMS' and comm_status = 'LOST') as bigint) as lost_comms_count,
    avg(latency_ms) as avg_latency_ms, max(latency_ms) as max_latency_ms
  from silver group by all
), health as (
  select *, {_ratio("degraded_comms_count + lost_comms_count", "comms_readings")} as communication_issue_rate,
    cast(telemetry_rows as double) / (4 * 288) as daily_completeness_rate
  from daily
)"""

_LINK = f"""count(*) as comm_readings, avg(signal_strength_dbm) as avg_signal_strength_dbm,
    min(signal_strength_dbm) as min_signal_strength_dbm, max(signal_strength_dbm) as max_signal_strength_dbm,
    avg(bit_error_rate) as avg_bit_error_rate, cast(count_if(comm_status = 'NOMINAL') as bigint) as nominal_count,
    cast(count_if(comm_status = 'DEGRADED') as bigint) as degraded_count, cast(count_if(comm_status = 'LOST') as bigint) as lost_count,
    {_ratio("cast(count_if(comm_status in ('DEGRADED', 'LOST')) as bigint)", "count(*)")} as degraded_or_lost_rate"""

_COMM_HEALTH = f"""
comm_health as (
  select cast(event_timestamp as date) as metric_date, satellite_id, {_LINK}
  from silver where subsystem = 'COMMS' group by all
)"""

_ROLLUP = f"""
rollup_by_satellite as (
  select satellite_id, {_round("avg(avg_signal_strength_dbm)", 2)} as avg_signal_strength_dbm,
    {_round("avg(avg_bit_error_rate)", 6)} as avg_bit_error_rate,
    cast(sum(degraded_count) as bigint) as degraded_count, cast(sum(lost_count) as bigint) as lost_count,
    {_round(_ratio("sum(degraded_count + lost_count)", "sum(comm_readings)"), 4)} as degraded_or_lost_rate
  from comm_health group by satellite_id
)"""

_HEAD = "message_id, satellite_id, ground_station_id, event_timestamp, received_timestamp"
_TAIL = "latency_ms, dedup_key, ingestion_timestamp, pipeline_version"
_SPLITS = {
    "power": "battery_voltage_v, battery_current_a, solar_output_w",
    "thermal": "internal_temp_c, external_temp_c",
    "comms": "signal_strength_dbm, bit_error_rate, comm_status",
    "orbital": "latitude, longitude, altitude_km, velocity_kms",
}


def _with(extra: str, select: str) -> str:
    return query("").rstrip() + ",\n" + extra.strip() + "\n" + select.strip()


def _completeness(readings_per_tick: int) -> str:
    return query(f"""
select satellite_id, event_date, expected_readings, coalesce(found, 0) as actual_readings,
  expected_readings - coalesce(found, 0) as missing_readings,
  {_ratio("coalesce(found, 0)", "expected_readings")} as completeness_rate
from (select satellite_id, cast(tick as date) as event_date, count(*) * {readings_per_tick} as expected_readings
      from unnest(generate_series(timestamp '{GRID_START}', timestamp '{GRID_END}', interval 5 minutes)) as g(tick),
           (select distinct concat('SAT-', lpad(cast(n as varchar), 2, '0')) as satellite_id
            from range(1, 13) as r(n))
      group by all) expected
left join (select satellite_id, cast(event_timestamp as date) as event_date, count(*) as found
           from silver group by all) actual using (satellite_id, event_date)
""")


_GAPS = """
select satellite_id, gap_start, gap_end, gap_minutes,
  case when gap_minutes >= 360 then 'MAJOR_CONTACT_GAP' when gap_minutes >= 30 then 'SIGNIFICANT_CONTACT_GAP'
       else 'MINOR_CONTACT_GAP' end as gap_severity
from (select satellite_id, gap_start, event_timestamp as gap_end,
             datesub('minute', gap_start, event_timestamp) as gap_minutes
      from (select satellite_id, event_timestamp,
                   lag(event_timestamp) over (partition by satellite_id order by event_timestamp) as gap_start
            from silver))
where gap_minutes > 5
"""

_PIPELINE = f"""
select raw_records, curated_records, quarantined_records, unique_semantic_events, avg_latency_ms, max_latency_ms,
  {_ratio("quarantined_records", "raw_records")} as quarantine_rate,
  {_ratio("curated_records", "raw_records")} as curated_rate
from (select (select count(*) from messages) as raw_records, (select count(*) from silver) as curated_records,
             (select count(*) from quarantine) as quarantined_records,
             (select count(distinct dedup_key) from silver) as unique_semantic_events,
             (select avg(latency_ms) from silver) as avg_latency_ms,
             (select max(latency_ms) from silver) as max_latency_ms)
"""

_DASHBOARD = f"""
select metric_date, satellite_id, telemetry_rows,
  {_round("daily_completeness_rate * 100", 2)} as completeness_pct,
  {_round("avg_battery_voltage_v", 3)} as avg_battery_voltage_v,
  {_round("avg_internal_temp_c", 2)} as avg_internal_temp_c,
  {_round("avg_signal_strength_dbm", 2)} as avg_signal_strength_dbm,
  {_round("avg_bit_error_rate", 6)} as avg_bit_error_rate, degraded_comms_count, lost_comms_count,
  {_round("communication_issue_rate * 100", 2)} as communication_issue_pct,
  {_round("avg_latency_ms", 2)} as avg_latency_ms, cast(max_latency_ms as double) as max_latency_ms
from health order by metric_date, satellite_id
"""

_STORED = [
    ("telemetry_raw", "messages"), ("telemetry_quarantine", "quarantine"), ("telemetry_curated", "curated"),
    ("silver_telemetry", "silver"), ("silver_power", "silver where subsystem = 'POWER'"),
    ("silver_thermal", "silver where subsystem = 'THERMAL'"), ("silver_comms", "silver where subsystem = 'COMMS'"),
    ("silver_orbital", "silver where subsystem = 'ORBITAL'"), ("fact_telemetry", "silver"),
]

_RAW = f"""
select raw_payload, {_IDS}, timestamp '{AS_OF}' as ingestion_timestamp, '1.0.0' as pipeline_version,
  'pubsub' as source
from judged
"""
_TWICE = "ts >= timestamp '2024-01-06' and ts < timestamp '2024-01-07'"  # the day that came once more

_DELIVERED = f"""
select raw_records, curated_records, quarantined_records, unique_semantic_events, avg_latency_ms, max_latency_ms,
  {_ratio("quarantined_records", "raw_records")} as quarantine_rate,
  {_ratio("curated_records", "raw_records")} as curated_rate
from (select (select count(*) + count_if({_TWICE}) from messages) as raw_records, (select count(*) from silver) as curated_records,
             (select count(*) + count_if({_TWICE}) from judged where reason_code is not null) as quarantined_records,
             (select count(distinct dedup_key) from silver) as unique_semantic_events,
             (select avg(latency_ms) from silver) as avg_latency_ms,
             (select max(latency_ms) from silver) as max_latency_ms)
"""

# Which slice of the stream brings a message, and the watermark that it is held against: one hour below the newest
# valid event, as it was when the slice before began.
_SLICED = f"""
arrivals as (
  select *, unnest(case when late and slice < 4 then [slice + 2] when again then [slice, slice + 1] else [slice] end) as arrival
  from (select *, cast(least((day(ts) - 1) // 5, 5) as integer) as slice, event_id % 101 = 3 as late,
               event_id % 7 = 0 and day(ts) % 5 = 0 and day(ts) < 30 and hour(ts) = 23 and minute(ts) >= 30 as again
        from judged)
), newest as (
  select arrival, max(event_at) as newest_at from arrivals where reason_code is null group by arrival
), timed as (
  select a.*, (select max(newest_at) - interval 1 hour from newest n where n.arrival < a.arrival - 1) as watermark from arrivals a
), in_time as (
  select * from timed where reason_code is null and (watermark is null or event_at > watermark)
)"""
_IN_TIME = query("").rstrip() + ",\n" + _SLICED.strip() + """, kept as (
  select distinct curated.* from curated join in_time i
    on curated.event_timestamp = i.event_at and curated.satellite_id = i.satellite_id and curated.subsystem = i.subsystem
  where curated.message_id in (concat('m', i.event_id), concat('d', i.event_id))
)
"""

_READING_COLUMNS = ("dedup_key, satellite_id, ground_station_id, subsystem, event_timestamp, "
                    + ", ".join(_MEASURES) + ", comm_status, ingestion_timestamp, pipeline_version, "
                    "source_ground_station")


def all_queries() -> dict[str, str]:
    fact_columns = "* exclude (source_ground_station)"
    sql = {
        "raw_envelope": query(_RAW),
        "validate_reasons": query(f"select {_IDS}, reason_code, reason_detail from judged"),
        "validate_reasons_by_dimension": query(f"select {_IDS}, reason_code, reason_detail from judged"),
        "curated_from_booleans": query("select * from curated"),
        "reason_counts": query("select reason_code, reason_detail, count(*) as message_count from judged group by all"),
        "quarantine": query("select * from quarantine"),
        "accepted_readings": query("select * from accepted"),
        "curated": query("select * from curated"),
        "stored_day_range": query(
            "select * from silver where event_timestamp >= timestamp '2024-01-05' and event_timestamp < timestamp '2024-01-10'"),
        "curated_from_numbers": query("select * from curated"),
        "silver_telemetry": query("select * from silver"),
        "dim_satellite": query("""
select distinct satellite_id,
  case satellite_id when 'SAT-07' then 'DROP_OUT_TEST_SATELLITE' when 'SAT-11' then 'DEGRADED_COMMS_TEST_SATELLITE'
       else 'NOMINAL' end as mission_test_profile,
  satellite_id = 'SAT-07' as known_dropout_satellite, satellite_id = 'SAT-11' as known_degraded_comms_satellite
from silver"""),
        "dim_ground_station": query("""
select distinct ground_station_id, concat('Ground Station ', right(ground_station_id, 1)) as ground_station_name
from silver"""),
        "fact_telemetry": query(f"select {fact_columns} from silver"),
        "gold_satellite_health": _with(_HEALTH, "select * from health"),
        "gold_communication_health": _with(_COMM_HEALTH, "select * from comm_health"),
        "gold_contact_gaps": query(_GAPS),
        "gold_data_completeness": _completeness(1),
        "gold_data_completeness_by_subsystem": _completeness(4),
        "gold_data_quality": query("""
select cast(quarantined_at as date) as quarantine_date, reason_code, count(*) as rejected_records
from quarantine group by all"""),
        "gold_pipeline_quality": query(_PIPELINE),
        "mission_operations_dashboard": _with(_HEALTH, _DASHBOARD),
        "communication_by_satellite": _with(
            _COMM_HEALTH.strip() + ",\n" + _ROLLUP.strip(), "select * from rollup_by_satellite"),
        "weakest_communication_satellite": _with(
            _COMM_HEALTH.strip() + ",\n" + _ROLLUP.strip(),
            "select * from rollup_by_satellite order by avg_signal_strength_dbm, satellite_id limit 1"),
        "satellite_telemetry_volume": query("""
select satellite_id, count(*) as telemetry_count, count(distinct ground_station_id) as ground_station_count,
  min(event_timestamp) as first_event_timestamp, max(event_timestamp) as last_event_timestamp
from silver group by satellite_id"""),
        "battery_health": query("""
select cast(event_timestamp as date) as metric_date, satellite_id, count(*) as power_readings,
  min(battery_voltage_v) as min_battery_voltage_v, avg(battery_voltage_v) as avg_battery_voltage_v,
  max(battery_voltage_v) as max_battery_voltage_v, min(battery_current_a) as min_battery_current_a,
  avg(battery_current_a) as avg_battery_current_a, max(battery_current_a) as max_battery_current_a,
  min(solar_output_w) as min_solar_output_w, avg(solar_output_w) as avg_solar_output_w,
  max(solar_output_w) as max_solar_output_w
from silver where subsystem = 'POWER' group by all"""),
        "communication_signal": query(
            f"select satellite_id, {_LINK} from silver where subsystem = 'COMMS' group by satellite_id"),
        "subsystem_alerts": query("""
select satellite_id, subsystem, reason_code, count(*) as rejected_records from quarantine group by all"""),
        "dataset_profile": query(f"""
select total_rows, malformed_rows, {_round("malformed_rows * cast(100 as double) / total_rows", 3)} as malformed_pct,
  duplicate_rows, {_round("duplicate_rows * cast(100 as double) / total_rows", 3)} as duplicate_pct
from (select count(*) as total_rows, cast(count_if(is_malformed = 'true') as bigint) as malformed_rows,
             cast(count_if(is_duplicate = 'true') as bigint) as duplicate_rows from received)"""),
        "rows_per_satellite": query("select satellite_id, count(*) as row_count from received group by satellite_id"),
        "curated_from_csv": query("select * from curated", whole_json=True),
        "stored_tables": query(" union all ".join(
            f"select '{name}' as table_name, count(*) as row_count from {part}" for name, part in _STORED)),
        "stored_satellite_health": _with(_HEALTH, "select * from health"),
        "redelivered_batch": query("select * from curated"),
        "late_batch": query("select * from curated"),
        "rerun_batch": query(" union all ".join(
            f"select '{name}' as table_name, count(*) as row_count from {part}" for name, part in _STORED[:3])),
        "refreshed_silver_telemetry": query("select * from silver"),
        "refreshed_communication_health": _with(_COMM_HEALTH, "select * from comm_health"),
        "refreshed_contact_gaps": query(_GAPS),
        "refreshed_data_completeness": _completeness(1),
        "refreshed_pipeline_quality": query(_DELIVERED),
        "contact_gaps_from_segments": query(_GAPS),
        "pipeline_quality_from_days": query(_PIPELINE),
        "estimated_events": query("select count(distinct dedup_key) as unique_semantic_events, true as within_bound from silver"),
        "stream_windows": _IN_TIME + """
select time_bucket(interval 5 minutes, event_timestamp) as window_start,
  time_bucket(interval 5 minutes, event_timestamp) + interval 5 minutes as window_end, satellite_id,
  count(*) as readings, count(*) filter (comm_status = 'LOST') as lost_links
from kept
where time_bucket(interval 5 minutes, event_timestamp) + interval 5 minutes <= (select max(newest_at) - interval 1 hour from newest)
group by all""",
        "stream_in_order": _IN_TIME + f"select {_READING_COLUMNS} from kept",
        "stream_late_counts": _IN_TIME + """
select (select count(*) from timed where reason_code is null and event_at <= watermark) as late_rows, count(*) as stored_rows from kept""",
        "stream_fan_out": query("").rstrip() + ",\n" + _SLICED.strip() + """
select 'telemetry_raw' as table_name, count(*) as row_count from arrivals
union all select 'telemetry_quarantine', count(*) from arrivals where reason_code is not null
union all select 'telemetry_curated', count(*) from curated""",
        "stream_fan_out_curated": query(f"select {_READING_COLUMNS} from curated"),
        "stream_raw": query(_RAW),
        "stream_quarantine": query("select * from quarantine"),
        "stream_curated": query(f"select {_READING_COLUMNS} from curated"),
    }
    for name, columns in _SPLITS.items():
        sql[f"silver_{name}"] = query(
            f"select {_HEAD}, {columns}, {_TAIL} from silver where subsystem = '{name.upper()}'")
    for code in fv.REASON_CODES:
        sql[f"reject_{code.lower()}"] = query(
            f"select {_IDS}, reason_detail, raw_payload from judged where reason_code = '{code}'")
    return sql
