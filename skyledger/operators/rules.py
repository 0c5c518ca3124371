"""Ordered validation rules. The first rule that fails names the reason and the detail.

A rule is (condition, reason code, detail), condition and detail as SQL text over the columns
``raw_payload``, ``message`` (text fields) and the typed times and measures.
"""

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import fixed_values as fv
from skyledger.functions.parsing import number, utc_time
from skyledger.operators.parse import materialise
from skyledger.schemas import MEASURES

INVALID_JSON_TEXT = "Payload is not valid JSON"

Rule = tuple[str, str, str]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def _listed(values: list[str]) -> str:
    return "(" + ", ".join(_quoted(v) for v in values) + ")"


def _blank(name: str) -> str:
    return f"coalesce(message.{name}, '') = ''"


def payload_rules() -> list[Rule]:
    detail = f"""CASE WHEN try_parse_json(raw_payload) IS NOT NULL THEN {_quoted(fv.NOT_AN_OBJECT_TEXT)}
                      ELSE {_quoted(INVALID_JSON_TEXT)} END"""
    return [("message IS NULL", fv.INVALID_JSON, detail)]


def required_rules() -> list[Rule]:
    return [(_blank(name), fv.MISSING_REQUIRED_FIELD, _quoted(name)) for name in fv.REQUIRED_FIELDS]


def domain_rules(by_dimension: bool = False) -> list[Rule]:
    """The satellites are a short list, or those that ``with_known_satellites`` has marked."""
    domains = [
        ("satellite_id", fv.SATELLITES, fv.INVALID_SATELLITE),
        ("ground_station_id", fv.GROUND_STATIONS, fv.INVALID_GROUND_STATION),
        ("subsystem", fv.SUBSYSTEMS, fv.INVALID_SUBSYSTEM),
    ]
    rules = [(f"message.{name} NOT IN {_listed(domain)}", code, f"message.{name}") for name, domain, code in domains]
    if by_dimension:
        rules[0] = ("known_satellite IS NULL", *rules[0][1:])
    return rules


def with_known_satellites(parsed: DataFrame, satellites: DataFrame) -> DataFrame:
    """``known_satellite``: the message's satellite if the dimension (``satellite_id``) has it.

    An equality join, for fleets too large for a list. Spark broadcasts the ids while they are small by its own
    measure; beyond that it shuffles, and splits a satellite with very many messages.
    """
    known = satellites.select(F.col("satellite_id").alias("known_satellite")).where("known_satellite IS NOT NULL").distinct()
    return parsed.join(known, F.col("message.satellite_id") == F.col("known_satellite"), "left")


def time_rules() -> list[Rule]:
    def unparsed(name):
        read = f"replace(message.{name}, 'Z', '+00:00')"
        return f"{name} IS NULL", fv.INVALID_TIMESTAMP, f"""concat("Invalid isoformat string: '", {read}, "'")"""

    return [
        unparsed("event_timestamp"),
        unparsed("received_timestamp"),
        ("event_timestamp > now", fv.FUTURE_EVENT_TIMESTAMP, "message.event_timestamp"),
        ("received_timestamp < event_timestamp", fv.INVALID_RECEIVED_TIMESTAMP,
         _quoted(fv.RECEIVED_BEFORE_EVENT_TEXT)),
    ]


def range_rules(subsystem: str) -> list[Rule]:
    """Per measure in order: it must be a number, then it must be in range."""
    rules = []
    for name, low, high in fv.PHYSICAL_RANGES[subsystem]:
        rules.append((f"{name} IS NULL", fv.INVALID_NUMERIC_TYPE, _quoted(subsystem)))
        rules.append((f"{name} NOT BETWEEN {low}D AND {high}D", fv.OUT_OF_PHYSICAL_RANGE, _quoted(name)))
    return rules


def link_rules() -> list[Rule]:
    """The status must be known and agree with the signal strength."""
    signal, status = "signal_strength_dbm", "message.comm_status"
    known = f"coalesce({status}, 'None')"

    def by_signal(nominal, degraded, lost):
        return f"""CASE WHEN {signal} >= {fv.NOMINAL_FROM_DBM}D THEN {_quoted(nominal)}
                        WHEN {signal} >= {fv.DEGRADED_FROM_DBM}D THEN {_quoted(degraded)}
                        ELSE {_quoted(lost)} END"""

    texts = (fv.MUST_BE_NOMINAL_TEXT, fv.MUST_BE_DEGRADED_TEXT, fv.MUST_BE_LOST_TEXT)
    return [
        (f"{known} NOT IN {_listed(fv.COMM_STATUSES)}", fv.INVALID_COMM_STATUS, known),
        (f"{status} <> {by_signal(*fv.COMM_STATUSES)}", fv.INCONSISTENT_COMM_STATUS, by_signal(*texts)),
    ]


def foreign_measure_rules() -> list[Rule]:
    """A measure of another subsystem may be blank, but not a text that is no number."""
    broken = " OR ".join(f"({name} IS NULL AND NOT {_blank(name)})" for name in MEASURES)
    return [(broken, fv.INVALID_NUMERIC_TYPE, "message.subsystem")]


def general_rules(by_dimension: bool = False) -> list[Rule]:
    return payload_rules() + required_rules() + domain_rules(by_dimension) + time_rules()


def own_rules(subsystem: str) -> list[Rule]:
    return range_rules(subsystem) + (link_rules() if subsystem == "COMMS" else [])


def all_rules() -> list[Rule]:
    """In the order that numbers them, from 1."""
    own = [rule for subsystem in fv.SUBSYSTEMS for rule in own_rules(subsystem)]
    return general_rules() + own + foreign_measure_rules()


def failed_rule(by_dimension: bool = False) -> str:
    """Number of the first rule that fails, else NULL.

    General rules come first, then those of the record's own subsystem, then foreign measures.
    """
    numbered = iter(range(1, len(all_rules()) + 1))

    def first(rules, otherwise="NULL"):
        branches = " ".join(f"WHEN {test} THEN {next(numbered)}" for test, _, _ in rules)
        return f"CASE {branches} ELSE {otherwise} END"

    general = first(general_rules(by_dimension), otherwise="{measured}")
    own = " ".join(f"WHEN {_quoted(s)} THEN {first(own_rules(s))}" for s in fv.SUBSYSTEMS)
    foreign = first(foreign_measure_rules())
    return general.replace("{measured}", f"coalesce(CASE message.subsystem {own} END, {foreign})")


def reason_columns(rule: str) -> list[str]:
    """Code and detail of a failed rule's number."""
    rules = all_rules()
    codes = ", ".join(_quoted(code) for _, code, _ in rules)
    details = " ".join(f"WHEN {n} THEN {detail}" for n, (_, _, detail) in enumerate(rules, 1))
    return [
        f"CASE WHEN {rule} IS NOT NULL THEN element_at(array({codes}), {rule}) END AS reason_code",
        f"CASE {rule} {details} END AS reason_detail",
    ]


def validate(parsed: DataFrame, now: Column, satellites: DataFrame | None = None) -> DataFrame:
    """One row per payload: typed fields, plus ``reason_code`` and ``reason_detail`` (NULL if valid).

    ``satellites`` is a dimension to look satellites up in, in the place of the built-in list; the rules keep their order.
    """
    if satellites is not None:
        parsed = with_known_satellites(parsed, satellites)
    typed = parsed.withColumn("now", now).selectExpr(
        "*",
        *[f"{utc_time('message.' + name)} AS {name}" for name in fv.TIME_FIELDS],
        *[f"{number('message.' + name)} AS {name}" for name in MEASURES],
    )
    return materialise(typed, F.expr(failed_rule(satellites is not None)), "failed_rule").selectExpr(
        "raw_payload",
        *[f"message.{name} AS {name}" for name in fv.ID_FIELDS],
        "message.event_timestamp AS event_text",
        *fv.TIME_FIELDS,
        *MEASURES,
        "message.comm_status AS comm_status",
        *reason_columns("failed_rule"),
    )
