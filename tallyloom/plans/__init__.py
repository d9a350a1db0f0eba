from tallyloom.plans.bulk import load
from tallyloom.plans.incremental import refresh_incremental, tally_landed
from tallyloom.plans.jobs import MEDALS, load_fact_and_dimension, local_extract, refresh
from tallyloom.plans.loads import (
    create_schema,
    create_table,
    create_table_as,
    drop_table,
    insert_into,
    replace_table,
    truncate_table,
)
from tallyloom.plans.partitions import create_keyed_table, merge_latest, replace_partitions
from tallyloom.plans.versions import table_version

__all__ = [
    "MEDALS",
    "create_keyed_table",
    "create_schema",
    "create_table",
    "create_table_as",
    "drop_table",
    "insert_into",
    "load",
    "load_fact_and_dimension",
    "local_extract",
    "merge_latest",
    "refresh",
    "refresh_incremental",
    "replace_partitions",
    "replace_table",
    "table_version",
    "tally_landed",
    "truncate_table",
]
