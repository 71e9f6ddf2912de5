from farmledger.sources.ledger import ledger_rows, load_changes, load_landing
from farmledger.sources.snapshots import drop_unnamed, month_rows, read_snapshot, replace_months_at_once
from farmledger.sources.tables import (
    Tables,
    load_list,
    read_table,
    read_table_list,
    run_table_list,
    strip_prefix,
)
from farmledger.sources.sinks import (
    append,
    detached,
    drop_old_versions,
    full_reload,
    merge_partitions,
    replace_months,
    safe_overwrite,
)

__all__ = [
    "Tables",
    "append",
    "detached",
    "drop_old_versions",
    "drop_unnamed",
    "full_reload",
    "ledger_rows",
    "load_changes",
    "load_landing",
    "load_list",
    "merge_partitions",
    "month_rows",
    "read_snapshot",
    "read_table",
    "read_table_list",
    "replace_months",
    "replace_months_at_once",
    "run_table_list",
    "safe_overwrite",
    "strip_prefix",
]
