from tidemark.sinks.current import CurrentTable
from tidemark.sinks.landed import merge_landed, read_landed, read_landed_as_is
from tidemark.sinks.manifest import (
    CommitConflict,
    RunTable,
    SumTable,
    is_managed,
    publish_slices,
    publish_table,
    read_published,
)
from tidemark.sinks.tables import (
    BATCH,
    append_counted,
    append_observed,
    land_batch,
    replace_slice,
    replace_slices,
    replace_table,
)

__all__ = [
    "BATCH",
    "CommitConflict",
    "CurrentTable",
    "RunTable",
    "SumTable",
    "append_counted",
    "append_observed",
    "is_managed",
    "land_batch",
    "merge_landed",
    "publish_slices",
    "publish_table",
    "read_landed",
    "read_landed_as_is",
    "read_published",
    "replace_slice",
    "replace_slices",
    "replace_table",
]
