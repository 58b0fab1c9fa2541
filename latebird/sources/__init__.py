from latebird.sources.flights import (
    count_malformed,
    read_flights_csv,
    read_flights_parquet,
    write_flights_csv,
    write_table,
)
from latebird.sources.types import merged_schema, narrowest_types, widened

__all__ = [
    "count_malformed",
    "merged_schema",
    "narrowest_types",
    "read_flights_csv",
    "read_flights_parquet",
    "widened",
    "write_flights_csv",
    "write_table",
]
