"""Shell-style file patterns as anchored regular expressions."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codelineage.functions.text import basename

# Workers get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEVER = r"\z\A."


def glob_regex(pattern: str) -> str:
    """Regex body for one pattern; ``*`` crosses slashes and case matters."""
    out, at = [], 0
    while at < len(pattern):
        c = pattern[at]
        at += 1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[" and (end := _set_end(pattern, at)) > 0:
            out.append(_set_regex(pattern[at:end]))
            at = end + 1
        else:
            out.append(c if c.isalnum() or ord(c) > 127 else "\\" + c)
    return "".join(out)


def _set_end(pattern: str, start: int) -> int:
    """Index of the bracket that closes a set; a bracket in first place is a member."""
    first = start + 1 if pattern[start:start + 1] == "!" else start
    return pattern.find("]", first + 1)


def _set_regex(body: str) -> str:
    negated = body.startswith("!")
    members = "".join(c if c.isalnum() or c == "-" or ord(c) > 127 else "\\" + c for c in body[negated:])
    return f"[{'^' if negated else ''}{members}]"


def any_glob_regex(patterns: Sequence[str]) -> str:
    """One regex that matches the whole text against any of the patterns."""
    if not patterns:
        return NEVER
    return r"(?s)\A(?:" + "|".join(glob_regex(p) for p in patterns) + r")\z"


def name_or_path_matches(path: Column, patterns: Sequence[str]) -> Column:
    if "*" in patterns:
        return F.lit(True)
    regex = any_glob_regex(patterns)
    return path.rlike(regex) | basename(path).rlike(regex)


def in_snapshot(path: Column, include: Sequence[str] = ("*",), exclude: Sequence[str] = ()) -> Column:
    """Snapshot rule: includes look at name or path, excludes at the path only, hidden parts are out."""
    keep = name_or_path_matches(path, include) & ~is_hidden(path)
    return keep & ~path.rlike(any_glob_regex(exclude)) if exclude else keep


def in_diff(path: Column, include: Sequence[str] = ("*",), exclude: Sequence[str] = ()) -> Column:
    """Diff rule: both lists look at name or path; an empty include list keeps everything."""
    keep = name_or_path_matches(path, include) if include else F.lit(True)
    return keep & ~name_or_path_matches(path, exclude) if exclude else keep


def is_hidden(path: Column) -> Column:
    return path.rlike(r"(?:\A|/)\.")


# --- patterns that differ per repository -----------------------------------


def with_pattern_regexes(config: DataFrame) -> DataFrame:
    """Add ``include_regex`` (NULL = everything) and ``exclude_regex`` (NULL = nothing).

    Patterns are translated once per configured repository, not per file.
    """
    bodies = _regex_udf()
    everything = F.array_contains("file_patterns", "*")
    return config.withColumns({
        "include_regex": F.when(~everything, bodies("file_patterns")),
        "exclude_regex": F.when(F.size("exclude_patterns") > 0, bodies("exclude_patterns")),
    })


def _regex_udf():
    @F.pandas_udf(T.StringType())
    def bodies(lists: pd.Series) -> pd.Series:
        return lists.map(lambda patterns: any_glob_regex(list(patterns)))

    return bodies


def in_snapshot_by(path: Column, include: Column, exclude: Column) -> Column:
    """:func:`in_snapshot` with regex columns of :func:`with_pattern_regexes`."""
    included = include.isNull() | F.rlike(path, include) | F.rlike(basename(path), include)
    excluded = exclude.isNotNull() & F.rlike(path, exclude)
    return included & ~F.coalesce(excluded, F.lit(False)) & ~is_hidden(path)


def in_diff_by(path: Column, include: Column, exclude: Column) -> Column:
    """:func:`in_diff` with regex columns of :func:`with_pattern_regexes`."""
    included = include.isNull() | F.rlike(path, include) | F.rlike(basename(path), include)
    excluded = exclude.isNotNull() & (F.rlike(path, exclude) | F.rlike(basename(path), exclude))
    return included & ~F.coalesce(excluded, F.lit(False))
