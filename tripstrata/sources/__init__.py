from tripstrata.sources.files import new_files, read_new_files, source_files
from tripstrata.sources.ledger import (
    ensure_ledger,
    load_new_files,
    load_new_months,
    pending_files,
    read_files,
)
from tripstrata.sources.scan import (
    footers,
    listed_files,
    read_dataset,
    read_drifting,
    with_ingest_metadata,
    with_partition_columns,
    with_source_file,
)
from tripstrata.sources.tables import (
    ensure_layers,
    in_months,
    overwrite_months,
    read_table,
    release_replaced,
    replace_files,
    replace_split_months,
    run_query,
    stored_months,
    write_bucketed,
    write_split,
    write_split_passes,
    write_table,
)

__all__ = [
    "ensure_layers",
    "ensure_ledger",
    "footers",
    "in_months",
    "listed_files",
    "load_new_files",
    "load_new_months",
    "new_files",
    "overwrite_months",
    "pending_files",
    "read_dataset",
    "read_drifting",
    "read_files",
    "read_new_files",
    "read_table",
    "release_replaced",
    "replace_files",
    "replace_split_months",
    "run_query",
    "source_files",
    "stored_months",
    "with_ingest_metadata",
    "with_partition_columns",
    "with_source_file",
    "write_bucketed",
    "write_split",
    "write_split_passes",
    "write_table",
]
