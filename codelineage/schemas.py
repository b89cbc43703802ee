"""Table layouts. Keys are never null; Optional columns are marked nullable."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*columns):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in columns])


S, L, B, I = T.StringType(), T.LongType(), T.BooleanType(), T.IntegerType()
TS, STRINGS = T.TimestampType(), T.ArrayType(T.StringType())

REPOS = _table(
    ("full_name", S, False), ("owner", S, False), ("name", S, False), ("description", S, True),
    ("default_branch", S, True), ("clone_url", S, True), ("stars", L, False), ("language", S, True),
    ("topics", STRINGS, True), ("updated_at", TS, True), ("url", S, True),
)

RELEASES = _table(
    ("repo", S, False), ("tag_name", S, False), ("name", S, False), ("published_at", TS, False),
    ("tarball_url", S, True), ("commit_sha", S, False), ("is_prerelease", B, False),
    ("release_id", L, False),
)

REPO_CONFIG = _table(
    ("name", S, False), ("description", S, True), ("min_version", S, True),
    ("max_versions", I, True), ("file_patterns", STRINGS, True), ("exclude_patterns", STRINGS, True),
)

RAW_FILES = _table(
    ("repo", S, False), ("version", S, False), ("path", S, False), ("content", T.BinaryType(), False),
    ("size", L, False), ("head", T.BinaryType(), False), ("content_sha", S, False),
)

EXAMPLES = _table(
    ("repo_name", S, False), ("from_version", S, False), ("to_version", S, False),
    ("created_at", S, False), ("input_text", S, True), ("output_text", S, True),
    ("input_tokens_approx", L, False), ("output_tokens_approx", L, False),
    ("num_files_in_codebase", L, False), ("num_files_changed", L, False),
    ("num_dependencies", L, False),
)

EXAMPLE_COLUMNS = EXAMPLES.fieldNames()

# An example as the job gives it: one row for each part of its texts, whose parts in order are the texts. A text
# with fewer parts than the other is empty in the rest; all other columns are those of the whole example in every row.
RECORDS = _table(*[(f.name, f.dataType, f.nullable) for f in EXAMPLES.fields], ("part_no", I, False), ("parts", I, False))
RECORD_COLUMNS = RECORDS.fieldNames()

# Light rows kept for statistics: the texts are replaced by their lengths.
EXAMPLE_META = _table(
    ("repo_name", S, False), ("from_version", S, False), ("to_version", S, False),
    ("input_size", L, False), ("output_size", L, False),
    ("input_tokens_approx", L, False), ("output_tokens_approx", L, False),
    ("num_files_in_codebase", L, False), ("num_files_changed", L, False),
    ("num_dependencies", L, False),
)
