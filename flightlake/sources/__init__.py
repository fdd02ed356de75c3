from .bronze import (drift_report, land_snapshot, read_envelopes, read_ontime_csv, rejects,
                     wrap_envelope, write_ontime_csv)
from .sinks import append_new, observed_write, replace_table, unseen
from .tables import Tables

__all__ = [
    "drift_report", "land_snapshot", "read_envelopes", "read_ontime_csv", "rejects",
    "wrap_envelope", "write_ontime_csv",
    "append_new", "observed_write", "replace_table", "unseen",
    "Tables",
]
