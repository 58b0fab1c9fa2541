"""The relational steps as pipeline stages.

`SQLTransformer` stages save and load with the fitted pipeline and need no
class of ours when loaded. They only rename and derive columns, so Catalyst
merges them into one projection over the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import SQLTransformer

from latebird.functions import clock
from latebird.operators.timefeatures import (
    landing_expression,
    split_expressions,
    takeoff_expression,
)
from latebird.schema import CLOCK_COLUMNS, DEPARTURE, FLIGHT_COLUMNS, TAKEOFF_COLUMNS


def sql_stage(
    columns: Mapping[str, str] | None = None,
    *,
    keep: str = "*",
    where: str | None = None,
) -> SQLTransformer:
    """A stage that keeps `keep` and adds `columns` (name -> SQL expression).
    A later expression may use an earlier name."""
    items = [keep] if keep else []
    items += [f"{expression} AS {name}" for name, expression in (columns or {}).items()]
    condition = f" WHERE {where}" if where else ""
    return SQLTransformer(statement=f"SELECT {', '.join(items)} FROM __THIS__{condition}")


def clean_stage(required: Sequence[str], zero_fill: Sequence[str] = ()) -> SQLTransformer:
    """Pin names and types, then drop cancelled and incomplete rows.

    A WHERE sees the input's columns, so it tests the typed values, not the
    input's: text that is no number counts as missing. Where the input already
    has the type, the cast falls away and the test reaches the scan.
    """

    def typed(name: str) -> str:
        return f"try_cast({name} AS {FLIGHT_COLUMNS[name].simpleString()})"

    pinned = {
        name: f"coalesce({typed(name)}, 0)" if name in zero_fill else typed(name)
        for name in FLIGHT_COLUMNS
    }
    conditions = [f"{typed(name)} IS NOT NULL" for name in required]
    conditions.append(f"{typed('Cancelled')} <> 1")
    return sql_stage(pinned, keep="", where=" AND ".join(conditions))


def time_stage(
    *,
    null_as_zero: bool = False,
    landing_after_takeoff: bool = True,
    taxi_out: str = "TaxiOut",
) -> SQLTransformer:
    """Keep what is known at take-off and add departure, take-off and landing.

    Take-off is worked out from the incoming `TaxiOut`, never from the filled
    one: inside this SELECT an input column wins over an alias of that name.
    """
    return sql_stage(
        {
            "TaxiOut": taxi_out,
            DEPARTURE: clock.departure(),
            "TakeOffTime": takeoff_expression(null_as_zero),
            "LandingEst": landing_expression(landing_after_takeoff, null_as_zero),
        },
        keep=", ".join(TAKEOFF_COLUMNS),
    )


def batch_median(column: str = "TaxiOut") -> str:
    """The batch's own median for every row, as a scalar subquery; the same
    approximate median as `fill_with_batch_median`."""
    return f"coalesce((SELECT percentile_approx({column}, 0.5) FROM __THIS__), 0)"


def split_clock_stage() -> SQLTransformer:
    return sql_stage(split_expressions())


def drop_clock_stage() -> SQLTransformer:
    return sql_stage(keep=f"* EXCEPT ({', '.join([*CLOCK_COLUMNS, DEPARTURE])})")
