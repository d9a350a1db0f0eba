from tallyloom.sources.catalog import TableDetails, name_for_sql, table_columns, table_details
from tallyloom.sources.csv import read_csv
from tallyloom.sources.files import find_file, list_files, read_files, read_landed, read_landed_csv
from tallyloom.sources.jdbc import JdbcDatabase, read_jdbc
from tallyloom.sources.landing import (
    current_files,
    landing_manifest,
    landings,
    read_landing,
    read_landing_csv,
    read_landing_files,
)
from tallyloom.sources.types import infer_schema, narrowest_types

__all__ = [
    "JdbcDatabase",
    "TableDetails",
    "current_files",
    "find_file",
    "infer_schema",
    "landing_manifest",
    "landings",
    "list_files",
    "name_for_sql",
    "narrowest_types",
    "read_csv",
    "read_files",
    "read_jdbc",
    "read_landed",
    "read_landed_csv",
    "read_landing",
    "read_landing_csv",
    "read_landing_files",
    "table_columns",
    "table_details",
]
