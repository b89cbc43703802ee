"""Text expressions: decoding, line handling, number and size formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line ends as Python's str.splitlines sees them; \r\n is one boundary and is
# taken as a unit so that it is never cut in the middle.
LINE_END = r"(?>\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}])"
NOT_LINE_END = r"[^\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
AFTER_LINE_END = r"(?<=[\n\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}])|(?<=\r)(?!\n)"
# Whitespace as Python's str.strip sees it; the class needs the (?U) flag.
SPACE = r"[\s\x1C-\x1F]"
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

BAR = "=" * 80


def decoded(binary: Column) -> Column:
    """UTF-8 text of a byte column, malformed sequences replaced."""
    return F.make_valid_utf8(binary.cast("string"))


def text_mode(text: Column) -> Column:
    """Newlines as a text-mode read gives them: ``\\r\\n`` and ``\\r`` become ``\\n``."""
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def lines_with_ends(text: Column) -> Column:
    """Array of lines, each keeping its line end; empty text has no line."""
    # Cut behind each end: extracting all matches takes time that grows with the square of a text's length.
    return F.filter(F.split(text, AFTER_LINE_END), lambda line: line != "")


def line_count(text: Column) -> Column:
    """Number of lines without building the array."""
    ends = F.regexp_count(text, F.lit(LINE_END))
    open_end = F.right(text, F.lit(1)).rlike(NOT_LINE_END)
    return (ends + open_end.cast("int")).cast("long")


def lines_marked(text: Column, marker: str) -> Column:
    """Text with ``marker`` put in front of each line; empty text stays empty."""
    marked = F.concat(F.lit(marker), F.regexp_replace(text, rf"({LINE_END})(?!\z)", f"$1{marker}"))
    return F.when(F.length(text) > 0, marked).otherwise(F.lit(""))


def lines_starting(text: Column, prefix: str) -> Column:
    """Number of lines starting with ``prefix`` (a literal text)."""
    quoted = "".join("\\" + c if not c.isalnum() else c for c in prefix)
    pattern = rf"(?:\A|{LINE_END}){quoted}"
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def commas(number: Column) -> Column:
    return F.format_number(number, 0)


def human_size(size: Column, unit: str = "bytes") -> Column:
    """Decimal size with two digits from a thousand up, else whole units."""
    def shown(value, pattern):
        return F.call_function("format_number", value, F.lit(pattern))

    def scaled(divisor, suffix):
        return F.concat(shown(size / F.lit(divisor), "0.00"), F.lit(suffix))

    return (
        F.when(size >= 1_000_000_000, scaled(1e9, " GB"))
        .when(size >= 1_000_000, scaled(1e6, " MB"))
        .when(size >= 1_000, scaled(1e3, " KB"))
        .otherwise(F.concat(shown(size.cast("double"), "0"), F.lit(f" {unit}")))
    )


def size_category(count: Column) -> Column:
    return (
        F.when(count < 1_000, "n<1K")
        .when(count < 10_000, "1K<n<10K")
        .when(count < 100_000, "10K<n<100K")
        .when(count < 1_000_000, "100K<n<1M")
        .otherwise("n>1M")
    )


def approx_tokens(text: Column) -> Column:
    return F.floor(F.length(text) / 4).cast("long")


def shortened(text: Column, limit: int) -> Column:
    """First ``limit`` characters and dots when the text is longer."""
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("..."))).otherwise(text)


def repo_owner(full_name: Column) -> Column:
    return F.split_part(full_name, F.lit("/"), F.lit(1))


def repo_short_name(full_name: Column) -> Column:
    return F.split_part(full_name, F.lit("/"), F.lit(2))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-cased last suffix with its dot, or an empty string (no dot, a leading or a final one)."""
    name = basename(path)
    suffix = F.substring_index(name, ".", -1)
    dot_at = F.length(name) - F.length(suffix) - 1
    return F.when((dot_at > 0) & (F.length(suffix) > 0), F.concat(F.lit("."), F.lower(suffix))).otherwise(F.lit(""))


def dataset_name(naming: str, base_name: str, username: str = "", repo: Column | None = None) -> Column:
    """Output dataset name: one per repository, or one shared base name."""
    if naming == "per_repo" and repo is not None:
        safe = F.lower(F.replace(repo, F.lit("/"), F.lit("-")))
        name = F.when(F.length(repo) > 0, F.concat(F.lit("sft-"), safe)).otherwise(F.lit(base_name))
    else:
        name = F.lit(base_name)
    return F.concat(F.lit(f"{username}/"), name) if username else name


def version_matches(tag: Column, version: Column) -> Column:
    """Tag starts with the version, ignoring case and one leading ``v`` on each."""
    def plain(c):
        return F.regexp_replace(F.lower(c), "^v", "")

    return F.startswith(plain(tag), plain(version))
