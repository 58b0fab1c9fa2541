"""Clock arithmetic on HHmm integers and timestamps, as Spark SQL expressions.

Every function returns SQL text. The DataFrame operators wrap it in `F.expr`
and the saved pipelines put it in an `SQLTransformer`, so both share one
definition. All of it is built-in, code-generated Spark SQL.

Timestamps are `TIMESTAMP_NTZ`: a flight record holds local wall-clock times,
and results must not depend on the session time zone.
"""

from __future__ import annotations

from collections.abc import Sequence

MIDNIGHT_NEXT_DAY = 2400


def hour_of(hhmm: str) -> str:
    """Hour of an HHmm integer. 2400 gives 24."""
    return f"CAST(floor(({hhmm}) / 100) AS INT)"


def minute_of(hhmm: str) -> str:
    return f"CAST(({hhmm}) % 100 AS INT)"


def departure(
    year: str = "Year", month: str = "Month", day: str = "DayofMonth", hhmm: str = "CRSDepTime"
) -> str:
    """Timestamp of a calendar day and an HHmm time; 2400 is the next midnight.

    Built from the integers, which costs about a fifth of padding, joining and
    parsing text, and once for both kinds of time, which keeps the generated
    method short. Impossible dates and times give null instead of failing.
    """
    midnight = f"{hhmm} = {MIDNIGHT_NEXT_DAY}"
    hour = f"if({midnight}, 0, {hour_of(hhmm)})"
    return (
        f"try_make_timestamp_ntz({year}, {month}, {day}, {hour}, {minute_of(hhmm)}, 0) "
        f"+ if({midnight}, INTERVAL 1 DAY, INTERVAL 0 DAY)"
    )


def departure_text(
    year: str = "Year", month: str = "Month", day: str = "DayofMonth", hhmm: str = "CRSDepTime"
) -> str:
    """`yyyyMMddHHmm` text; null if any part is null."""
    return f"concat({year}, lpad({month}, 2, '0'), lpad({day}, 2, '0'), lpad({hhmm}, 4, '0'))"


def departure_parsed(
    year: str = "Year", month: str = "Month", day: str = "DayofMonth", hhmm: str = "CRSDepTime"
) -> str:
    """`departure` by way of text, for input that holds the parts as text."""

    def parse(text: str) -> str:
        return f"CAST(try_to_timestamp({text}, 'yyyyMMddHHmm') AS TIMESTAMP_NTZ)"

    return (
        f"CASE WHEN {hhmm} = {MIDNIGHT_NEXT_DAY} "
        f"THEN {parse(departure_text(year, month, day, '0'))} + INTERVAL 1 DAY "
        f"ELSE {parse(departure_text(year, month, day, hhmm))} END"
    )


def minutes_total(columns: Sequence[str], null_as_zero: bool = False) -> str:
    """Sum of minute columns. Null if any is null, unless nulls count as zero."""
    parts = [f"coalesce(CAST({c} AS INT), 0)" if null_as_zero else f"CAST({c} AS INT)" for c in columns]
    return " + ".join(parts)


def shifted(timestamp: str, minutes: str) -> str:
    return f"{timestamp} + ({minutes}) * INTERVAL 1 MINUTE"


def hhmm_of(timestamp: str) -> str:
    """HHmm integer of a timestamp."""
    return f"hour({timestamp}) * 100 + minute({timestamp})"


def clock_text(timestamp: str) -> str:
    """HHmm text of a timestamp, leading zeros kept."""
    return f"date_format({timestamp}, 'HHmm')"
