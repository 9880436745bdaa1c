"""Sources and sinks: delimited landing files, parquet inputs, ORC tables."""

from tallyframe.sources.delimited import (
    malformed_rows,
    normalise_names,
    read_delimited,
    read_inferred,
    read_with_rejects,
    write_delimited,
)
from tallyframe.sources.schema import TICKET_RAW_SCHEMA, TRIP_RAW_SCHEMA, subset, without_spaces
from tallyframe.sources.tables import (
    check_table,
    column_histograms,
    column_statistics,
    create_table_if_absent,
    drop_table,
    gather_statistics,
    literal_table,
    load_table,
    overwrite_partitions,
    read_parquet,
    save_table,
    table_location,
)

__all__ = [
    "TICKET_RAW_SCHEMA",
    "TRIP_RAW_SCHEMA",
    "check_table",
    "column_histograms",
    "column_statistics",
    "create_table_if_absent",
    "drop_table",
    "gather_statistics",
    "literal_table",
    "load_table",
    "malformed_rows",
    "normalise_names",
    "overwrite_partitions",
    "read_delimited",
    "read_inferred",
    "read_parquet",
    "read_with_rejects",
    "save_table",
    "subset",
    "table_location",
    "without_spaces",
    "write_delimited",
]
