from orderlens.sources.jdbc import jdbc_options, read_jdbc_snapshot
from orderlens.sources.landing import bad_records, good_records, landed_files, landed_schema, read_landing_json
from orderlens.sources.sinks import land_batch, shuffles_removed, write_metrics, write_table
from orderlens.sources.tables import load_metrics, read_table, shared_dir

__all__ = [
    "bad_records",
    "good_records",
    "jdbc_options",
    "land_batch",
    "landed_files",
    "landed_schema",
    "load_metrics",
    "read_jdbc_snapshot",
    "read_landing_json",
    "read_table",
    "shared_dir",
    "shuffles_removed",
    "write_metrics",
    "write_table",
]
