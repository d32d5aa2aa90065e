"""Sources and sinks: CSV, JSON payloads, array series, Parquet tables, views, SQL."""

from strata.sources.csv import read_csv, sniff_delimiter, string_schema, write_csv
from strata.sources.harmonise import (
    DEFORESTATION_ALIASES,
    TAX_ALIASES,
    first_alias,
    harmonise,
    harmonise_deforestation,
    harmonise_tax,
)
from strata.sources.json_items import explode_items, read_json_items, read_json_lines_items
from strata.sources.landing import group_layouts, header_lines, read_landing
from strata.sources.ranges import file_heads, list_files, read_columns
from strata.sources.series import explode_series
from strata.sources.tables import (
    create_path_view,
    read_table,
    register_views,
    sql_text,
    run_sql,
    with_audit,
    write_table,
)

__all__ = [
    "DEFORESTATION_ALIASES",
    "TAX_ALIASES",
    "create_path_view",
    "explode_items",
    "explode_series",
    "file_heads",
    "first_alias",
    "group_layouts",
    "harmonise",
    "harmonise_deforestation",
    "harmonise_tax",
    "header_lines",
    "list_files",
    "read_columns",
    "read_csv",
    "read_json_items",
    "read_json_lines_items",
    "read_landing",
    "read_table",
    "register_views",
    "sql_text",
    "run_sql",
    "sniff_delimiter",
    "string_schema",
    "with_audit",
    "write_csv",
    "write_table",
]
