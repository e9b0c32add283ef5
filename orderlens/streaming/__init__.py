from orderlens.streaming.landing import Once, convert_new_batches, present_files, read_converted
from orderlens.streaming.loads import compact, last_load, loads_between, read_loads, vacuum

__all__ = ["Once", "compact", "convert_new_batches", "last_load", "loads_between", "present_files", "read_converted", "read_loads", "vacuum"]
