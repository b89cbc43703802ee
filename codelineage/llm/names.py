"""Names for helper columns beside those of a caller's table."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with as many underscores behind it as it takes to be none of ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
