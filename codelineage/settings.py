"""Limits and naming options shared by the jobs; every value ends up as a plan literal."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Limits are off unless they are asked for: nothing is dropped or cut by default.
    max_file_size: int | None = None
    max_codebase_size: int | None = None
    include_dependencies: bool = True
    dependency_depth: int = 1
    output_format: str = "jsonl"
    max_dependencies: int | None = None
    context_lines: int = 3
    max_diff_size: int | None = None
    # Largest text kept in one cell. Invalid bytes become three-byte replacement
    # characters, so three times this value must stay under Spark's 2 GB cell.
    max_cell_bytes: int = 268435456

    def __post_init__(self):
        if self.dependency_depth != 1:
            raise ValueError("dependency_depth: only depth 1 is supported")
        if self.output_format not in ("jsonl", "parquet", "both"):
            raise ValueError("output_format: expected jsonl, parquet or both")
        if not 0 < self.max_cell_bytes <= 700000000:
            raise ValueError("max_cell_bytes: must lie between 1 and 700000000")
