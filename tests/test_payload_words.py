"""Words that make a payload special are looked for on its bytes first; a pattern sees few payloads."""

from skyledger import schemas
from skyledger.operators.parse import parse_payloads

PAYLOADS = {
    '{"latitude": true, "longitude": false}': ("1.0", "0.0"),
    '{"latitude": "true", "longitude": "false"}': ("true", "false"),
    '{"latitude": "a", "longitude": true}': ("a", "1.0"),
    '{"latitude": "+INF", "longitude": "INF"}': ("+INF", "INF"),
    '{"latitude": "+I", "longitude": "tru"}': ("+I", "tru"),
    '{"latitude": +INF}': None,
    '{"latitude": -INF}': None,
    '{"latitude": +Infinity}': None,
    '{"latitude": "\\"", "longitude": true, "satellite_id": "INF \\" true"}': ('"', "1.0"),
}


def test_words_inside_and_outside_strings(spark):
    rows = spark.createDataFrame([(text,) for text in PAYLOADS], "value string")
    got = {r.raw_payload: r.message and (r.message.latitude, r.message.longitude) for r in parse_payloads(rows, schemas.PAYLOAD).collect()}
    assert got == PAYLOADS


def test_no_pattern_reads_every_payload(spark):
    plan = parse_payloads(spark.createDataFrame([("{}",)], "value string"), schemas.PAYLOAD)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in plan  # behind the words
    assert "RLIKE(raw_payload" not in plan.replace(" ", "") and "RLIKE(value" not in plan.replace(" ", "")
