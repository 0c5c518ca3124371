"""Message bytes to a payload text and a struct of text fields."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyledger.functions.parsing import utf8_text
from skyledger.schemas import MEASURES

STRICT_JSON = {"allowSingleQuotes": "false"}


def materialise(df: DataFrame, column, name: str) -> DataFrame:
    """Add ``column`` so that later filters work on its value.

    A one-element explode is a stage of the plan that filters on its output do not move through.
    Without it, Catalyst would copy the whole expression, JSON parsing included, into each filter.
    """
    held = f"{name}_value"
    computed = df.withColumn(held, column)
    return computed.select("*", F.explode(F.array(held)).alias(name)).drop(held)


def parse_payloads(messages: DataFrame, fields: T.StructType, value: str = "value", hold: bool = True) -> DataFrame:
    """``raw_payload`` and ``message``, a struct of text fields; NULL unless one whole JSON object.

    The payload is parsed as the only element of an array: trailing text, a second object, an empty
    payload, scalars and arrays then all fail to give exactly one object. A payload that closes that
    array itself needs a ``]`` to do so; such payloads are parsed once more as an object's member,
    where that would be an error.

    ``hold=False`` leaves out the ``materialise`` step, for users that do not filter on the fields.
    """
    text = messages.select(utf8_text(messages, value).alias("raw_payload"))
    listed = F.concat(F.lit("["), F.col("raw_payload"), F.lit("]"))
    # Escaped pairs go first, then strings: single loops over one class, which need no stack however long the text.
    outside = F.regexp_replace(F.regexp_replace("raw_payload", r"(?s)\\.", ""), r'"[^"]*"', '""')
    objects = _with_numbers_for_booleans(F.from_json(listed, T.ArrayType(fields), STRICT_JSON), outside, fields)
    parsed = materialise(text, objects, "objects") if hold else text.withColumn("objects", objects)
    member = F.concat(F.lit('{"whole":'), F.col("raw_payload"), F.lit("}"))
    checked = F.from_json(member, "whole STRING, broken STRING", {**STRICT_JSON, "columnNameOfCorruptRecord": "broken"})
    # Spark's parser also takes +INF, -INF, INF and +Infinity as numbers; outside strings they are no JSON.
    is_foreign = _holds("raw_payload", "+I", "INF") & outside.rlike(r"\+I|INF")
    is_one = ~is_foreign & (F.size("objects") == 1) & (~F.col("raw_payload").contains("]") | checked["broken"].isNull())
    return parsed.select("raw_payload", F.when(is_one, F.col("objects")[0]).alias("message"))


def _holds(name: str, first: str, second: str) -> Column:
    """Whether the text holds one of two words: on its bytes as they are, where a pattern would decode every payload."""
    return F.col(name).contains(first) | F.col(name).contains(second)


def _with_numbers_for_booleans(objects: Column, outside: Column, fields: T.StructType) -> Column:
    """JSON's true and false count as 1.0 and 0.0 in measures; the texts "true" and "false" do not.

    Text fields can not tell these apart, typed JSON (VARIANT) can. It is parsed only for payloads of one object that
    hold one of the words outside strings. ``outside`` is the payload without its strings.
    """
    measures = [name for name in fields.fieldNames() if name in MEASURES]
    if not measures:
        return objects

    def numbered(message: Column, typed: Column) -> Column:
        def field(name: str) -> Column:
            kind = F.schema_of_variant(F.try_variant_get(typed, f"$.{name}", "variant"))
            number = F.when(message[name] == "true", "1.0").otherwise("0.0")
            return F.when(kind == "BOOLEAN", number).otherwise(message[name])

        return F.struct(*[(field(name) if name in measures else message[name]).alias(name) for name in fields.fieldNames()])

    has_words = _holds("raw_payload", "true", "false") & outside.rlike("true|false")
    return F.when(has_words & (F.size(objects) == 1), F.zip_with(objects, F.array(F.try_parse_json("raw_payload")), numbered)).otherwise(objects)
