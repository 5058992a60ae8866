from .admission import admit, bad_record
from .tables import (
    conform,
    cut_lineage,
    materialize,
    new_kept_path,
    read_source,
    remove_at_exit,
    remove_kept,
    replace_days,
    replace_partitions,
)

__all__ = [
    "admit",
    "bad_record",
    "conform",
    "cut_lineage",
    "materialize",
    "new_kept_path",
    "read_source",
    "remove_at_exit",
    "remove_kept",
    "replace_days",
    "replace_partitions",
]
