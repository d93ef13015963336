"""Text to typed values, strictly (a bad value fails the job) or leniently (it becomes null)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strict(text: Column, to: T.DataType, date_format: str | None = None) -> Column:
    """The ANSI cast, which fails on a value that is not of the type; so does a decimal with too many digits."""
    if date_format and isinstance(to, T.DateType):
        return F.to_date(text, date_format)
    if isinstance(to, T.DecimalType):
        return F.when(_too_precise(text, to), _refused(text, to)).otherwise(text.cast(to))
    return text.cast(to)


def lenient(text: Column, to: T.DataType, date_format: str | None = None) -> Column:
    """Null where the value is not of the type. What shows that at a glance is not parsed: a parser that gives up throws, which is slow."""
    if date_format and isinstance(to, T.DateType):
        parsed = F.when(~_no_such_day(text, date_format), F.try_to_date(text, date_format))
        if date_format not in _PLAIN_DAY:
            return parsed
        pattern, iso = _PLAIN_DAY[date_format]
        shown = text.cast("string")  # the cast of an ISO day takes less time than a parser by format
        return F.when(shown.rlike(pattern), iso(shown).try_cast(to)).otherwise(parsed)
    if isinstance(to, T.DecimalType):
        return F.when(_plain(text, to), text.try_cast(to)).when(~_no_number(text) & ~_too_precise(text, to), text.try_cast(to))
    return text.try_cast(to)


# Formats of digits alone, by the pattern of a text whose day does not exist: a 30th of February, a 31st of a short month, a 13th month.
_NO_SUCH_DAY = {
    "MMddyyyy": r"^(?:(?:0230|(?:02|04|06|09|11)31)[0-9]{4}|(?:00|1[3-9]|[2-9][0-9])[0-9]{6}|[0-9]{2}(?:00|3[2-9]|[4-9][0-9])[0-9]{4})$",
    "M/d/yyyy": r"^(?:2/30/[0-9]{4}|(?:2|4|6|9|11)/31/[0-9]{4}|(?:0|1[3-9]|[2-9][0-9])/[0-9]{1,2}/[0-9]{4}"
                r"|[0-9]{1,2}/(?:0|3[2-9]|[4-9][0-9])/[0-9]{4})$",
}


def _iso(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, month, day)


# Formats of digits alone: the pattern of a text that is a day of every year of four digits, and that text as an ISO day.
_PLAIN_DAY = {
    "MMddyyyy": (r"^(?:(?:0[1-9]|1[0-2])(?:0[1-9]|1[0-9]|2[0-8])|(?:0[13-9]|1[0-2])(?:29|30)|(?:0[13578]|1[02])31)[1-9][0-9]{3}$",
                 lambda text: _iso(F.substring(text, 5, 4), F.substring(text, 1, 2), F.substring(text, 3, 2))),
    "M/d/yyyy": (r"^(?:(?:[1-9]|1[0-2])/(?:[1-9]|1[0-9]|2[0-8])|(?:[13-9]|1[0-2])/(?:29|30)|(?:[13578]|1[02])/31)/[1-9][0-9]{3}$",
                 lambda text: _iso(F.substring_index(text, "/", -1), F.substring_index(text, "/", 1),
                                   F.substring_index(F.substring_index(text, "/", 2), "/", -1))),
}


def _no_such_day(text: Column, date_format: str) -> Column:
    """True for some of the texts that are no date: those with a letter, or with a day that no year has."""
    pattern = _NO_SUCH_DAY.get(date_format)
    return F.coalesce(text.cast("string").rlike(rf"[A-Za-z]|{pattern}"), F.lit(False)) if pattern else F.lit(False)


def _plain(text: Column, to: T.DecimalType) -> Column:
    """True for digits, with no more of them before and after the point than the type has."""
    return text.cast("string").rlike(rf"^-?[0-9]{{1,{to.precision - to.scale}}}(?:\.[0-9]{{1,{to.scale}}})?$" if to.scale else
                                     rf"^-?[0-9]{{1,{to.precision}}}$")


def _no_number(text: Column) -> Column:
    """True for some of the texts that are no number: those with a letter that no number has."""
    shown = text.cast("string")
    return F.coalesce(shown.rlike("[A-DF-Za-df-z]") & ~shown.isin("true", "false"), F.lit(False))


def _too_precise(text: Column, to: T.DecimalType) -> Column:
    """True for a number that the cast would round: other than zero digits beyond the scale."""
    wide = text.try_cast(T.DecimalType(38, 38 - to.precision + to.scale))
    digits = text.cast("string").rlike(rf"\.\d{{{to.scale}}}\d*[1-9]\d*\s*$")
    return F.coalesce((wide != text.try_cast(to)) | (wide.isNotNull() & digits), F.lit(False))


def _refused(text: Column, to: T.DataType) -> Column:
    return F.raise_error(F.concat(F.lit(f"not a {to.simpleString()}: "), text.cast("string")))


def unconvertible(text: Column, to: T.DataType, date_format: str | None = None) -> Column:
    """True where there is a value, but not one of the declared type."""
    unknown = text.isNotNull()
    if isinstance(to, T.DecimalType):  # what is surely of the type is not converted to see it
        unknown &= ~_plain(text, to)
    elif isinstance(to, T.DateType) and date_format in _PLAIN_DAY:
        unknown &= ~text.cast("string").rlike(_PLAIN_DAY[date_format][0])
    return unknown & lenient(text, to, date_format).isNull()


def failing(text: Column, to: T.DataType, date_format: str | None = None) -> Column:
    """What ``strict`` gives, also in a session whose casts turn bad values null."""
    return F.when(unconvertible(text, to, date_format), _refused(text, to)).otherwise(lenient(text, to, date_format))


def cast_to_schema(rows: DataFrame, schema: T.StructType, date_format: str | None = None) -> DataFrame:
    """Every column in its declared type and order; a bad value fails the job."""
    ansi = str(rows.sparkSession.conf.get("spark.sql.ansi.enabled")).lower() == "true"
    convert = strict if ansi else failing
    return rows.select([convert(F.col(f.name), f.dataType, date_format).alias(f.name) for f in schema])


def try_cast_to_schema(rows: DataFrame, schema: T.StructType, date_format: str | None = None) -> DataFrame:
    """Every column in its declared type and order; a bad value turns null."""
    return rows.select([lenient(F.col(f.name), f.dataType, date_format).alias(f.name) for f in schema])
