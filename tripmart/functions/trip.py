"""Column builders for trip measures, record identity and labels."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Separator (character 31) and mark for NULL in the text that is hashed.
FIELD_SEPARATOR = "\x1f"
NULL_MARK = "<NULL>"


def epoch_seconds(timestamp: str) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp, whatever the session time zone."""
    ts = F.col(timestamp)
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(ts.cast("date")).cast("bigint") * 86400 + clock


def elapsed_seconds(start: str, end: str) -> Column:
    """Second boundaries crossed between two timestamps: 00.9 to 02.1 counts 2."""
    return epoch_seconds(end) - epoch_seconds(start)


def exact_minutes(start: str, end: str) -> Column:
    """Elapsed minutes including fractions of a second."""
    fraction = F.date_part(F.lit("SECOND"), F.col(end)) - F.date_part(F.lit("SECOND"), F.col(start))
    whole = F.second(F.col(end)) - F.second(F.col(start))
    return (elapsed_seconds(start, end) - whole + fraction).cast("double") / 60.0


def minutes(seconds: Column) -> Column:
    return seconds.cast("double") / 60.0


def miles_per_hour(distance: Column, seconds: Column) -> Column:
    """NULL unless time passed."""
    return F.when(seconds > 0, distance / (seconds.cast("double") / 3600.0))


def per_mile(amount: Column, distance: Column) -> Column:
    """NULL unless the trip covered ground."""
    return F.when(distance > 0, amount / distance)


def touches(zone_ids: Iterable[int], *columns: str) -> Column:
    """True when any of the columns holds one of the ids; NULL stays undecided."""
    ids = list(zone_ids)
    found = F.col(columns[0]).isin(ids)
    for name in columns[1:]:
        found = found | F.col(name).isin(ids)
    return found


def _texts(columns: Sequence[tuple[str, str]]) -> list[str]:
    return [f"coalesce(cast({name} AS string), '{NULL_MARK}')" for name, _ in columns]


def record_text(columns: Sequence[tuple[str, str]]) -> Column:
    """Typed columns, given as (name, type), joined in order as Spark prints them."""
    return F.expr(f"concat_ws('{FIELD_SEPARATOR}', {', '.join(_texts(columns))})")


# Writes out the digits of a double's text: 1.0E7 becomes 10000000.0, 1.0E-4 becomes 0.0001. Done
# for sizes from 1e-4 up to 1e16; beyond that, and for other columns, the text stays as it is.
DIGITS = "regexp_replace(cast(try_cast(part.text AS decimal(38,20)) AS string), '0+$', '')"
WITHOUT_EXPONENT = f"""
    CASE WHEN part.number AND part.text RLIKE '^-?[0-9]+[.][0-9]+E-?[0-9]+$'
              AND abs(try_cast(part.text AS double)) BETWEEN 1e-4 AND 9999999999999998
         THEN {DIGITS} || CASE WHEN {DIGITS} LIKE '%.' THEN '0' ELSE '' END
         ELSE part.text END"""


def record_hash(text: str, columns: Sequence[tuple[str, str]]) -> Column:
    """md5 of a record_text column, with the digits of very large or small doubles written out.

    Exponents are rare: most rows are only searched for the letter.
    """
    marked = [
        f"named_struct('text', {value}, 'number', {'true' if kind == 'double' else 'false'})"
        for value, (_, kind) in zip(_texts(columns), columns, strict=True)
    ]
    rewritten = f"transform(array({', '.join(marked)}), part -> {WITHOUT_EXPONENT})"
    return F.expr(
        f"md5(CASE WHEN contains({text}, 'E') AND {text} RLIKE '[0-9]E-?[0-9]' "
        f"THEN concat_ws('{FIELD_SEPARATOR}', {rewritten}) ELSE {text} END)"
    )


def trip_id(record: Column, rank: Column) -> Column:
    """Hash, dash, occurrence number of at least four digits; more digits are never cut off."""
    text = rank.cast("string")
    return F.concat(record, F.lit("-"), F.when(rank < 10_000, F.lpad(text, 4, "0")).otherwise(text))


def ratio(total: str, count: str) -> Column:
    """Mean from a sum and a count; NULL when nothing was counted."""
    return F.when(F.col(count) > 0, F.col(total) / F.col(count))
