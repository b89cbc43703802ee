"""Parse one requirement string with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codelineage.functions.text import SPACE, stripped

# Name, blanks, then the rest of the line.
REQUIREMENT = rf"(?U)\A([a-zA-Z0-9_-]+){SPACE}*([^\n]*)"
# First a name character, after blanks and [extras]; no URL, VCS link or local path.
STARTS_WITH_NAME = rf"(?U)\A{SPACE}*+(?!https?://|git\+|[./])(?>\[[^\n]*?\])*+[a-zA-Z0-9_-]"
# First a character other than # and -, after blanks.
CARRIES_REQUIREMENT = rf"(?U)\A{SPACE}*+[^#-]"


def _without_comment(text: Column) -> Column:
    return F.split_part(text, F.lit("#"), F.lit(1))


def bare_requirement(text: Column) -> Column:
    """The string without comment, surrounding blanks and [extras]."""
    return F.regexp_replace(stripped(_without_comment(text)), r"\[[^\n]*?\]", "")


def is_requirement(text: Column) -> Column:
    """True where the string names a package."""
    return _without_comment(text).rlike(STARTS_WITH_NAME)


def bare_name(bare: Column) -> Column:
    return F.regexp_extract(bare, REQUIREMENT, 1)


def bare_spec(bare: Column) -> Column:
    return F.nullif(stripped(F.regexp_extract(bare, REQUIREMENT, 2)), F.lit(""))


def requirement_name(text: Column) -> Column:
    return bare_name(bare_requirement(text))


def requirement_spec(text: Column) -> Column:
    """Version part, NULL when there is none."""
    return bare_spec(bare_requirement(text))


def is_manifest_line(line: Column) -> Column:
    """Requirements-file line that is neither blank, a comment nor an option."""
    return line.rlike(CARRIES_REQUIREMENT)
