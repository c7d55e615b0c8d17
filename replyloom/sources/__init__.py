from .jsonl import (
    as_bad_lines,
    number_lines,
    read_jsonl,
    read_jsonl_dir,
    scan_lines,
)
from .sinks import (
    check_shards,
    read_shards,
    read_split,
    scores_to_csv,
    write_jsonl,
    write_shards,
    write_split,
    write_stats,
)

__all__ = [
    "as_bad_lines",
    "check_shards",
    "number_lines",
    "read_jsonl",
    "read_jsonl_dir",
    "read_shards",
    "read_split",
    "scan_lines",
    "scores_to_csv",
    "write_jsonl",
    "write_shards",
    "write_split",
    "write_stats",
]
