"""Text to typed values: UTF-8, numbers and ISO-8601 times. Bad input gives NULL, never an error.

The larger expressions are SQL text: one call builds them, where nested column calls take hundreds.
"""

from pyspark.sql import Column, DataFrame, functions as F

# What nearly all measures look like; the full shape takes longer to test.
PLAIN_NUMBER_SHAPE = r"^-?\d+(?:\.\d+)?$"
_DIGITS = r"\d+(?:_\d+)*"
NUMBER_SHAPE = (
    rf"^\s*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))\s*$"
)

# The everyday form, which Spark parses as it stands.
PLAIN_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})?$"

# Any ISO-8601 form: calendar or week date, extended or basic, any one-character separator.
_DATE = r"\d{4}(?:-\d{2}-\d{2}|\d{4}|-W\d{2}(?:-[1-7])?|W\d{2}[1-7]?)"
_CLOCK = r".\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?|\d{2}(?:\d{2}(?:[.,]\d+)?)?)?"
ANY_TIME_SHAPE = rf"(?s)^{_DATE}(?:{_CLOCK}(?:[+-]\d{{2}}(?::?\d{{2}}(?::?\d{{2}})?)?)?)?$"
# Offsets of 18 to 24 hours, which ISO-8601 allows and Spark's own parser does not.
FAR_OFFSET = rf"(?s)^({_DATE}{_CLOCK})([+-])(1[89]|2[0-3])(?::?([0-5]\d)(?::?([0-5]\d))?)?$"
WEEK_DATE = r"^\d{4}-?W(\d{2})-?([1-7]?)"


def utf8_text(df: DataFrame, column: str) -> Column:
    """Message bytes as text, bad bytes replaced; text columns pass through."""
    value = F.col(column)
    if df.schema[column].dataType.typeName() == "binary":
        return F.make_valid_utf8(value.cast("string"))
    return value


def number(text: str) -> str:
    """Decimal, exponent, inf and nan forms as double; '' and anything else as NULL.

    ``from_json`` puts quotes around JSON's bare NaN and Infinity; these spellings, and no other text
    with quotes, are numbers.
    """
    bare = f"""CASE WHEN {text} IN ('"NaN"', '"Infinity"', '"-Infinity"') THEN btrim({text}, '"') ELSE {text} END"""
    return f"""CASE WHEN {text} RLIKE r'{PLAIN_NUMBER_SHAPE}' THEN try_cast({text} AS DOUBLE)
                    WHEN {bare} RLIKE r'{NUMBER_SHAPE}' THEN try_cast(replace({bare}, '_', '') AS DOUBLE) END"""


def utc_time(text: str) -> str:
    """ISO-8601 text as a UTC timestamp; no offset means UTC."""
    plain = f"CASE WHEN {text} RLIKE r'{PLAIN_TIME_SHAPE}' THEN try_to_timestamp({text}) END"
    return f"CASE WHEN NOT startswith({text}, '0000') THEN coalesce({plain}, {_any_utc_time(text)}) END"


def _any_utc_time(text: str) -> str:
    """Other forms are brought into the everyday one, piece by piece; a far offset is taken off afterwards."""
    zoned = f"regexp_replace(replace({text}, 'Z', '+00:00'), r'{FAR_OFFSET}', '$1+00:00')"
    sign, hours, minutes, seconds = (f"regexp_extract({text}, r'{FAR_OFFSET}', {group})" for group in (2, 3, 4, 5))
    far = f"""CASE WHEN {text} RLIKE r'{FAR_OFFSET}'
                   THEN make_dt_interval(0, int({hours}), int(concat('0', {minutes})), int(concat('0', {seconds})))
                        * if({sign} = '-', -1, 1)
                   ELSE make_dt_interval() END"""
    week = f"int(regexp_extract({zoned}, r'{WEEK_DATE}', 1))"
    weekday = f"int(coalesce(nullif(regexp_extract({zoned}, r'{WEEK_DATE}', 2), ''), '1'))"
    first_monday = f"date(date_trunc('week', try_cast(concat(left({zoned}, 4), '-01-04') AS TIMESTAMP)))"
    week_day = f"date_add({first_monday}, ({week} - 1) * 7 + {weekday} - 1)"
    from_week = f"""CASE WHEN weekofyear({week_day}) = {week}
                         THEN concat(string({week_day}), regexp_replace({zoned}, r'{WEEK_DATE}', '')) END"""
    from_calendar = rf"regexp_replace({zoned}, r'^(\d{{4}})-?(\d{{2}})-?(\d{{2}})', '$1-$2-$3')"
    dated = rf"CASE WHEN {zoned} RLIKE r'^\d{{4}}-?W' THEN {from_week} ELSE {from_calendar} END"
    separated = rf"regexp_replace({dated}, r'(?s)^(.{{10}}).', '$1T')"
    clock = rf"regexp_replace({separated}, r'T(\d{{2}})(\d{{2}})(\d{{2}})', 'T$1:$2:$3')"
    clock = rf"regexp_replace({clock}, r'T(\d{{2}})(\d{{2}})', 'T$1:$2')"
    # Spark takes an offset only after seconds.
    clock = rf"regexp_replace({clock}, r'T(\d{{2}})([+-])', 'T$1:00$2')"
    clock = rf"regexp_replace({clock}, r'T(\d{{2}}:\d{{2}})([+-])', 'T$1:00$2')"
    return f"""CASE WHEN {zoned} RLIKE r'{ANY_TIME_SHAPE}'
                    THEN try_to_timestamp(replace({clock}, ',', '.')) - {far} END"""
