"""Canonical JSON text of a reading, so that equal readings give equal SHA-256 keys.

Keys are sorted, there is no white space, and numbers are written the way Python writes floats.
Expressions are SQL text, as in ``parsing``.
"""

from skyledger.schemas import IDENTITY_FIELDS, MEASURES

# Fields whose text is free; the other text fields hold one of a few plain ids.
_FREE_TEXT = ("event_timestamp", "comm_status")


def float_text(value: str) -> str:
    """A double as shortest round-trip text: 0.00012, 1.5e-05, 12345678.0, 1e+16; NULL as null.

    Spark writes an exponent below 0.001 and from 1e7; Python does below 0.0001 and from 1e16.
    Tests on the size come first, so that most values need no change of their text.
    """
    text, size = f"string({value})", f"abs({value})"
    mantissa, power = f"substring_index({text}, 'E', 1)", f"substring_index({text}, 'E-', -1)"
    short = f"CASE WHEN endswith({mantissa}, '.0') THEN substring_index({mantissa}, '.', 1) ELSE {mantissa} END"
    tiny = f"concat({short}, CASE WHEN length({power}) < 2 THEN 'e-0' ELSE 'e-' END, {power})"
    digits = f"rtrim('0', replace(replace({mantissa}, '.', ''), '-', ''))"
    small = f"concat(CASE WHEN {value} < 0 THEN '-0.000' ELSE '0.000' END, {digits})"
    large = rf"regexp_replace(string(try_cast({text} AS DECIMAL(38,22))), r'(\.\d+?)0+$', '$1')"
    huge = rf"regexp_replace({text}, r'(?:\.0)?E(\d+)$', 'e+$1')"
    return f"""CASE WHEN {value} IS NULL THEN 'null'
                    WHEN {size} >= 1e-3 AND {size} < 1e7 OR {value} = 0 THEN {text}
                    WHEN {size} < 1e-4 THEN {tiny} WHEN {size} < 1e-3 THEN {small}
                    WHEN {size} < 1e16 THEN {large} ELSE {huge} END"""


def json_text(value: str) -> str:
    """A string as a quoted and escaped JSON string."""
    listed = f"to_json(array({value}))"
    return rf"""CASE WHEN {value} RLIKE r'["\\\x00-\x1f]' THEN substring({listed}, 2, length({listed}) - 2)
                     ELSE concat('"', {value}, '"') END"""


def canonical_json(fields: dict[str, str]) -> str:
    """Identity fields (SQL text by name) as one JSON object."""

    def member(name):
        if name in MEASURES:
            value = float_text(fields[name])
        elif name in _FREE_TEXT:
            value = f"coalesce({json_text(fields[name])}, 'null')"
        else:
            value = f"""coalesce(concat('"', {fields[name]}, '"'), 'null')"""
        return f"""'"{name}":', {value}"""

    body = ", ',', ".join(member(name) for name in sorted(IDENTITY_FIELDS))
    return f"concat('{{', {body}, '}}')"


def dedup_key(fields: dict[str, str]) -> str:
    """SHA-256 hex of the canonical JSON."""
    return f"sha2({canonical_json(fields)}, 256)"
