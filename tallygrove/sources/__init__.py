from tallygrove.sources.sinks import preview, report_lines, write_scored
from tallygrove.sources.tables import read_table
from tallygrove.sources.workspace import (
    held,
    leaving_nothing,
    remove,
    shared_dir,
    shared_path,
    stage,
)

__all__ = [
    "held",
    "leaving_nothing",
    "preview",
    "read_table",
    "remove",
    "report_lines",
    "shared_dir",
    "shared_path",
    "stage",
    "write_scored",
]
