from tallyloom.sinks.csv import write_csv
from tallyloom.sinks.jdbc import append_jdbc, replace_jdbc
from tallyloom.sinks.landing import land_exact, vacuum_landings
from tallyloom.sinks.layout import co_locate
from tallyloom.sinks.raw import land_raw

__all__ = [
    "append_jdbc",
    "co_locate",
    "land_exact",
    "land_raw",
    "replace_jdbc",
    "vacuum_landings",
    "write_csv",
]
