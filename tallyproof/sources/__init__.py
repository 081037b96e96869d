from tallyproof.sources.changes import finish_changes, rewrite_partitions
from tallyproof.sources.compaction import compact_partitions
from tallyproof.sources.counter_store import recheck
from tallyproof.sources.external import read_csv, read_jdbc, write_csv, write_jdbc
from tallyproof.sources.switching import finish_switches, partition_columns, rewrite_table_partitions
from tallyproof.sources.tables import (
    add_columns,
    append_by_name,
    create_table,
    overwrite_partitions,
    overwrite_table_partitions,
    reload_by_sql,
    write_bucketed,
)
from tallyproof.sources.versioned import (
    back_up,
    compact,
    current_version,
    full_refresh,
    publish,
    read_current,
    retain_versions,
    staged_rewrite,
)
from tallyproof.sources.watermarks import partitioned_watermark

__all__ = [
    "add_columns",
    "append_by_name",
    "back_up",
    "compact",
    "compact_partitions",
    "create_table",
    "current_version",
    "finish_changes",
    "finish_switches",
    "full_refresh",
    "overwrite_partitions",
    "overwrite_table_partitions",
    "partition_columns",
    "partitioned_watermark",
    "publish",
    "read_csv",
    "read_current",
    "read_jdbc",
    "recheck",
    "reload_by_sql",
    "retain_versions",
    "rewrite_partitions",
    "rewrite_table_partitions",
    "staged_rewrite",
    "write_bucketed",
    "write_csv",
    "write_jdbc",
]
