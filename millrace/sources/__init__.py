from millrace.sources.scratch import scratch_path
from millrace.sources.sinks import (
    adjacency_lines,
    schema_report,
    write_adjacency,
    write_csv,
    write_lines,
)
from millrace.sources.text import (
    parse_adjacency,
    parse_edges,
    parse_points,
    read_csv,
    read_lines,
)

__all__ = [
    "adjacency_lines",
    "parse_adjacency",
    "parse_edges",
    "parse_points",
    "read_csv",
    "read_lines",
    "schema_report",
    "scratch_path",
    "write_adjacency",
    "write_csv",
    "write_lines",
]
