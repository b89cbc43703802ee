"""Ordered text assembly: snapshots, diffs, file trees, dependency summaries.

The long form (one row per section, with its order columns) is the primary
product. ``text_parts`` makes texts of it, each in as many numbered parts as its size
needs; ``part_index`` says where they are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codelineage.functions.text import BAR, commas
from codelineage.operators.diff import PAIR, version_diffs
from codelineage.operators.joins import BROADCAST_BYTES, lookup_join, salted_join, size_of
from codelineage.operators.ordered import with_order
from codelineage.settings import Settings
from codelineage.storage import written

# Fixed value: the request that ends an input.
NEXT_VERSION_REQUEST = (
    "Based on the codebase above, predict the changes that will be made in the next version release. "
    "Output the changes as a unified diff."
)


def lines(*parts: Column | str) -> Column:
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def joined(text: str, order: str, separator: str = "\\n") -> Column:
    """Ordered concatenation of a group; ``text`` and ``order`` are SQL expressions."""
    return F.expr(f"listagg({text}, '{separator}') WITHIN GROUP (ORDER BY {order})")


# --- sections ---------------------------------------------------------------


def file_section(path: Column, content: Column) -> Column:
    return lines(BAR, F.concat(F.lit("FILE: "), path), BAR, content, "")


def diff_section(change_type: Column, old_path: Column, path: Column, adds: Column, dels: Column, diff: Column) -> Column:
    title = F.when(
        change_type == "renamed", F.concat(F.lit("RENAMED: "), old_path, F.lit(" -> "), path)
    ).otherwise(F.concat(F.upper(change_type), F.lit(": "), path))
    counts = F.concat(F.lit("(+"), adds.cast("string"), F.lit(", -"), dels.cast("string"), F.lit(")"))
    return lines(BAR, title, counts, BAR, diff, "")


def diff_sections(diffs: DataFrame) -> DataFrame:
    section = diff_section(*[F.col(c) for c in (
        "change_type", "old_path", "file_path", "additions", "deletions", "diff_content")])
    return diffs.select(*PAIR, "file_path", section.alias("piece"))


# --- headers ----------------------------------------------------------------
# The labels of the headers and wrappers below.


def snapshot_header(repo: Column, version: Column, num_files: Column, total_size: Column) -> Column:
    return lines(
        F.concat(F.lit("# Repository: "), repo),
        F.concat(F.lit("# Version: "), version),
        F.concat(F.lit("# Total Files: "), num_files.cast("string")),
        F.concat(F.lit("# Total Size: "), commas(total_size), F.lit(" bytes")),
        "",
    )


def diff_header(totals: dict[str, Column]) -> Column:
    """Header of a version diff; the repository is named as its folder, owner_name."""
    def line(label, value):
        return F.concat(F.lit(label), value.cast("string"))

    return lines(
        line("# Repository: ", F.replace(totals["repo"], F.lit("/"), F.lit("_"))),
        line("# From Version: ", totals["from_version"]),
        line("# To Version: ", totals["to_version"]),
        line("# Files Changed: ", totals["files_changed"]),
        line("# Additions: +", totals["total_additions"]),
        line("# Deletions: -", totals["total_deletions"]),
        "",
        "# Summary:",
        line("#   Added: ", totals["files_added"]),
        line("#   Modified: ", totals["files_modified"]),
        line("#   Deleted: ", totals["files_deleted"]),
        "",
    )


DIFF_TOTALS = ["files_changed", "total_additions", "total_deletions", "files_added", "files_modified", "files_deleted"]


def diff_header_of(row_has: list[str]) -> Column:
    """Header from columns of a version_diffs row; missing totals count as zero."""
    totals = {c: F.col(c) for c in ("repo", "from_version", "to_version")}
    totals |= {c: F.coalesce(F.col(c), F.lit(0)) if c in row_has else F.lit(0) for c in DIFF_TOTALS}
    return diff_header(totals)


def input_opening(repo: Column, version: Column) -> Column:
    return lines(
        "<repository>",
        F.concat(F.lit("<name>"), repo, F.lit("</name>")),
        F.concat(F.lit("<version>"), version, F.lit("</version>")),
        "<codebase>",
    )


INPUT_CLOSING = "\n".join(["</codebase>", "</repository>", "", NEXT_VERSION_REQUEST])


def input_text(repo: Column, version: Column, codebase: Column) -> Column:
    return lines(input_opening(repo, version), codebase, INPUT_CLOSING)


def output_text(from_version: Column, to_version: Column, diff: Column) -> Column:
    return lines(output_title(from_version, to_version), "", diff)


def output_title(from_version: Column, to_version: Column) -> Column:
    return F.concat(F.lit("# Changes from "), from_version, F.lit(" to "), to_version)


# --- texts in parts -------------------------------------------------------------


def sized(pieces: DataFrame, keys: list[str], order: list[str], text: str = "piece") -> DataFrame:
    """(keys, order, bytes, chars) of the pieces, written: their texts are read once for it."""
    return written(pieces.select(
        *keys, *order, F.octet_length(text).cast("long").alias("bytes"), F.length(text).cast("long").alias("chars")), "piece_sizes")


def slotted(sizes: DataFrame, keys: list[str], order: list[str], part_bytes: int, separator: str = "\n") -> DataFrame:
    """The pieces with their place in the text (byte_at, char_at) and the range of ``part_bytes`` they start in (slot), from sizes alone."""
    spaced = sizes.withColumns({"bytes": F.col("bytes") + len(separator.encode()), "chars": F.col("chars") + len(separator)})
    placed = with_order(spaced, keys, order, sum_before={"byte_at": "bytes", "char_at": "chars"})
    return placed.withColumn("slot", F.floor(F.col("byte_at") / part_bytes))


def part_index(placed: DataFrame, keys: list[str], order: list[str], separator: str = "\n") -> DataFrame:
    """Where each text made of :func:`slotted` pieces is cut: one row a part, written.

    (keys, slot, part_no from 0, parts, byte_start, char_start, text_bytes, text_chars, first): a part takes the pieces of one slot,
    so it is bounded by the range plus one piece, however long the text is; ``first`` is the
    order of its first piece, the starts are the places of the part in the whole text, whose size the next two are. Every key
    with pieces has at least one part.
    """
    gap, gap_bytes = len(separator), len(separator.encode())
    slots = placed.groupBy(*keys, "slot").agg(
        F.min(F.struct(*order)).alias("first"), F.min("byte_at").alias("byte_at"), F.min("char_at").alias("char_at"),
        F.max(F.col("byte_at") + F.col("bytes")).alias("byte_end"), F.max(F.col("char_at") + F.col("chars")).alias("char_end"))
    key = Window.partitionBy(*keys)
    later = F.col("slot") > 0
    return written(slots.select(
        *keys, "slot", (F.row_number().over(key.orderBy("slot")) - 1).cast("int").alias("part_no"), F.count(F.lit(1)).over(key).cast("int").alias("parts"),
        (F.col("byte_at") - F.when(later, gap_bytes).otherwise(0)).alias("byte_start"), (F.col("char_at") - F.when(later, gap).otherwise(0)).alias("char_start"),
        (F.max("byte_end").over(key) - gap_bytes).alias("text_bytes"), (F.max("char_end").over(key) - gap).alias("text_chars"), "first"), "part_index")


def with_part(pieces: DataFrame, placed: DataFrame, index: DataFrame, keys: list[str], order: list[str], also: tuple[str, ...] = ()) -> DataFrame:
    """Add ``part_no`` and the columns ``also`` of the index to the pieces.

    Where the cuts are few, in place: the first pieces of a key's parts go to its rows, which find theirs in two steps. Many cuts
    meet the pieces by their order, through the ``placed`` sizes of the pieces.
    """
    columns = ["part_no", *also]
    if size_of(index.select(*keys, "first", *columns))[0] > BROADCAST_BYTES:
        # Pieces equal in their order go to the last of their parts, as they do in place.
        parts = placed.join(index.select(*keys, "slot", *columns), [*keys, "slot"]).groupBy(*keys, *order).agg(F.max(F.struct(*columns)).alias("part"))
        parts = parts.select(*[F.col(c).alias(f"_{c}") for c in (*keys, *order)], "part.*")
        same = [F.col(c) == F.col(f"_{c}") for c in keys] + [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order]
        return pieces.join(parts, same).select(*pieces.columns, *columns)
    cuts = index.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first", *columns))).alias("_all")).withColumn(
        "_width", F.ceil(F.sqrt(F.size("_all"))).cast("int"))
    cuts = written(cuts.select(*keys, F.transform(
        F.sequence(F.lit(1), F.size("_all"), F.col("_width")), lambda i: F.slice("_all", i, F.col("_width"))).alias("_groups")), "cuts")
    # A joined row is copied with its lists, so it gets the first cuts of the groups and then one group, never all cuts.
    heads = cuts.select(*keys, F.transform("_groups", lambda g: g[0]["first"]).alias("_heads"))
    groups = cuts.select(*keys, F.posexplode("_groups").alias("_group", "_cuts"))
    here = F.struct(*order)
    found = pieces.join(F.broadcast(heads), keys).withColumn("_group", F.size(F.filter("_heads", lambda h: h <= here)) - 1).drop("_heads")
    found = found.join(F.broadcast(groups), [*keys, "_group"], "left")
    part = F.get("_cuts", F.size(F.filter("_cuts", lambda f: f["first"] <= here)) - 1)
    return found.withColumn("_part", part).select(*pieces.columns, *[F.col(f"_part.{c}").alias(c) for c in columns])


def text_parts(
    pieces: DataFrame, keys: list[str], order: list[str], part_bytes: int = Settings().max_cell_bytes, separator: str = "\n",
) -> DataFrame:
    """The text of each key, its ``piece`` values in order with ``separator`` between them, as numbered parts.

    (keys, part_no, parts, byte_start, char_start, text): the same way at every size. A text that fits ``part_bytes`` is one
    part; putting the parts of a key one after the other always gives the whole text. The pieces are evaluated twice.
    """
    placed = written(slotted(sized(pieces, keys, order), keys, order, part_bytes, separator), "placed")
    return _texts(pieces, placed, part_index(placed, keys, order, separator), keys, order, separator)


def _texts(pieces: DataFrame, placed: DataFrame, index: DataFrame, keys: list[str], order: list[str], separator: str = "\n") -> DataFrame:
    also = ("parts", "byte_start", "char_start")
    pieces = with_part(pieces, placed, index, keys, order, also).select(*keys, "part_no", *also, *order, "piece")
    bodies = put_together(pieces, [*keys, "part_no", *also], order, ["body"], separator)
    return bodies.select(*keys, "part_no", *also, leading(F.col("part_no"), F.col("body"), separator).alias("text"))


def part_bodies(placed: DataFrame, keys: list[str], order: list[str], separator: str = "\n", text: str = "piece") -> DataFrame:
    """(keys, part_no, body): the pieces of each part in order, ``separator`` between them; pieces that are NULL are left out."""
    return put_together(placed.select(*keys, "part_no", *order, F.col(text).alias("piece")), [*keys, "part_no"], order, ["body"], separator)


def put_together(pieces: DataFrame, keys: list[str], order: list[str], names: list[str], separator: str = "\n") -> DataFrame:
    """(keys, names): the ``piece`` values of each key in order, as one text; with several ``names``, a text for each value of ``side``.

    The rows of a partition are sorted, which spills, and streamed: a task holds one text and the batch it stands in, never all
    texts of its keys. The longest key goes to one task, so keys are parts of bounded size.
    """
    schema = T.StructType([*[pieces.schema[c] for c in keys], *[T.StructField(n, T.StringType()) for n in names]])
    side = ["side"] if len(names) > 1 else []
    rows = pieces.repartition(*keys).sortWithinPartitions(*keys, *side, *order).select(*keys, *side, "piece")
    between, width = separator.encode(), len(keys)

    def texts(batches):
        import numpy as np
        import pyarrow as pa

        def utf8(column):
            """Offsets and bytes of a text column, as they lie in the batch."""
            big = pa.types.is_large_string(column.type)
            at = np.frombuffer(column.buffers()[1], np.int64 if big else np.int32, len(column) + 1, column.offset * (8 if big else 4))
            return at.tolist(), memoryview(column.buffers()[2] or b"")

        def batch(done):
            columns = [pa.array([d[0][i] for d in done], types[i]) for i in range(width)]
            for i in range(len(names)):
                lengths = [0 if d[1][i] is None else len(d[1][i]) for d in done]
                bits = pa.array([d[1][i] is not None for d in done])
                body = b"".join([d[1][i] for d in done if d[1][i] is not None]) if len(done) > 1 else done[0][1][i] or b""
                offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                columns.append(pa.StringArray.from_buffers(len(done), offsets, pa.py_buffer(body), bits.buffers()[1]))
            return pa.RecordBatch.from_arrays(columns, [*keys, *names])

        current, held, done, size = None, [[] for _ in names], [], 0
        for rows_ in (b for b in batches if b.num_rows):
            types = [rows_.schema.field(i).type for i in range(width)]
            at, data = utf8(rows_.column(rows_.num_columns - 1))
            there = rows_.column(rows_.num_columns - 1).is_valid().to_pylist()
            sides = rows_.column(width).to_pylist() if side else [0] * len(there)
            for i, key in enumerate(zip(*[rows_.column(c).to_pylist() for c in range(width)])):
                if key != current:
                    if current is not None:
                        done.append((current, [between.join(h) if h else None for h in held]))
                        size += sum(len(x or b"") for x in done[-1][1])
                        if size >= 1 << 22 or len(done) >= 4096:
                            yield batch(done)
                            done, size = [], 0
                    current, held = key, [[] for _ in names]
                if there[i]:
                    held[sides[i]].append(data[at[i]:at[i + 1]])
        if current is not None:
            done.append((current, [between.join(h) if h else None for h in held]))
            yield batch(done)

    return rows.mapInArrow(texts, schema)


def leading(part_no: Column, body: Column, separator: str = "\n") -> Column:
    """The text of a part: all but the first begin with the separator."""
    return F.when(part_no > 0, F.concat(F.lit(separator), body)).otherwise(body)


def _headed(header: DataFrame, sections: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Pieces of texts that start with a header row (keys, piece)."""
    return header.select(*keys, F.lit(0).alias("place"), F.lit("").alias(order), "piece").unionByName(
        sections.select(*keys, F.lit(1).alias("place"), order, "piece"))


def snapshot_texts(snapshot: DataFrame, include_header: bool = True, max_bytes: int = Settings().max_cell_bytes) -> DataFrame:
    """(repo, version, num_files, total_size, part_no, parts, byte_start, char_start, text) of every snapshot."""
    key, order = ["repo", "version"], ["place", "path"]
    sections = snapshot.select(*key, F.lit(1).alias("place"), "path", "size", file_section(F.col("path"), F.col("content")).alias("piece"))
    # One pass over the contents measures the sections and adds up the files, a second one renders.
    measured = written(sections.select(
        *key, *order, "size", F.octet_length("piece").cast("long").alias("bytes"), F.length("piece").cast("long").alias("chars")), "piece_sizes")
    totals = written(measured.groupBy(*key).agg(F.count(F.lit(1)).alias("num_files"), F.sum("size").alias("total_size")), "totals")
    sizes, pieces = measured.drop("size"), sections.drop("size")
    if include_header:
        header = snapshot_header(F.col("repo"), F.col("version"), F.col("num_files"), F.col("total_size"))
        headers = totals.select(*key, F.lit(0).alias("place"), F.lit("").alias("path"), header.alias("piece"))
        sizes, pieces = sizes.unionByName(sized(headers, key, order)), pieces.unionByName(headers)
    placed = written(slotted(sizes, key, order, max_bytes), "placed")
    return totals.join(_texts(pieces, placed, part_index(placed, key, order), key, order), key)


def diff_texts(diffs: DataFrame, include_header: bool = True, max_bytes: int = Settings().max_cell_bytes) -> DataFrame:
    """(pair, part_no, parts, byte_start, char_start, text) of every version diff."""
    pieces, order = diff_sections(diffs), ["file_path"]
    if include_header:
        header = version_diffs(diffs).select(*PAIR, diff_header_of(DIFF_TOTALS).alias("piece"))
        pieces, order = _headed(header, pieces, PAIR, "file_path"), ["place", "file_path"]
    return text_parts(pieces, PAIR, order, max_bytes)


def unified_text(diffs: DataFrame, max_bytes: int = Settings().max_cell_bytes) -> DataFrame:
    """Plain unified diff of each pair in parts: the file diffs in path order, one after the other."""
    pieces = diffs.select(*PAIR, "file_path", F.col("diff_content").alias("piece"))
    return text_parts(pieces, PAIR, ["file_path"], max_bytes).withColumnRenamed("text", "unified_diff")


# --- trees and summaries ---------------------------------------------------------


def tree_lines(paths: DataFrame) -> DataFrame:
    """Lines of the file tree of each (repo, version) with their sort key.

    Every path prefix is a node; a node is last when no sibling follows. The line
    of a node is built from the last-flags of its ancestors.
    """
    snapshot = ["repo", "version"]
    parts = F.split("path", "/")
    nodes = (
        paths.select(*snapshot, F.explode(F.transform(
            F.sequence(F.lit(1), F.size(parts)), lambda n: F.slice(parts, 1, n))).alias("node"))
        .distinct()
        .withColumn("depth", F.size("node"))
        .withColumn("parent", F.array_join(F.slice("node", 1, F.col("depth") - 1), "/"))
    )
    last_child = nodes.groupBy(*snapshot, "parent").agg(F.max(F.element_at("node", -1)).alias("last_name"))
    # Each node looks up the last child of every ancestor folder, its own parent included.
    steps = nodes.select(
        *snapshot, "node", "depth", F.posexplode("node").alias("at", "name"),
    ).withColumn("parent", F.array_join(F.slice("node", F.lit(1), F.col("at")), "/"))
    # Every node of a snapshot asks for the root folder, so that key is split.
    flagged = salted_join(steps, last_child, [*snapshot, "parent"], F.array_join("node", "/")).withColumn(
        "is_last", F.col("name") == F.col("last_name"))
    own = F.col("at") == F.col("depth") - 1
    prefix = F.when(own, F.when(F.col("is_last"), "└── ").otherwise("├── ")).otherwise(
        F.when(F.col("is_last"), "    ").otherwise("│   "))
    return (
        flagged.withColumn("prefix", prefix)
        .groupBy(*snapshot, "node")
        .agg(joined("prefix", "at", "").alias("prefix"))
        .withColumn("line", F.concat("prefix", F.element_at("node", -1)))
        .select(*snapshot, "node", "line")
    )


def file_trees(paths: DataFrame, max_bytes: int = Settings().max_cell_bytes) -> DataFrame:
    """(repo, version, part_no, parts, byte_start, char_start, tree): the rendered tree of each snapshot, in parts."""
    key = ["repo", "version"]
    title = lines(F.concat(F.lit("# File Tree for "), F.col("repo"), F.lit("@"), F.col("version")), "")
    header = paths.select(*key).distinct().select(
        *key, F.lit(0).alias("place"), F.array().cast("array<string>").alias("node"), title.alias("piece"))
    rows = tree_lines(paths).select(*key, F.lit(1).alias("place"), "node", F.col("line").alias("piece"))
    return text_parts(header.unionByName(rows), key, ["place", "node"], max_bytes).withColumnRenamed("text", "tree")
