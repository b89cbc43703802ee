"""Examples built as releases arrive, with Structured Streaming.

Releases are paired in keyed state: each repository keeps its releases in order in Spark's state store, a quarter of a year in
each entry, so a micro-batch reads and writes the entries its releases fall into and no others. Pairs across entries follow from
the first and last release of each, which are written beside the events. A release that comes late splits the pair it falls into;
the pair it ends is listed as stale. Every micro-batch overwrites its own ``batch_id=`` folders, so a replayed batch
replaces its earlier output.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from codelineage.operators.diff import PAIR
from codelineage.operators.examples import DEFAULT_SYSTEM_PROMPT, example_meta, with_sizes
from codelineage.operators.releases import release_pairs, stable_releases
from codelineage.operators.stats import dataset_stats
from codelineage.plans.dataset import Dataset, build_pairs
from codelineage.settings import Settings
from codelineage.sources.sinks import save_examples_chat_jsonl, save_examples_jsonl
from codelineage.storage import written

# Workers get the state function by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RELEASE = ["at", "release_id", "tag_name", "commit_sha"]
STATE = "at array<bigint>, release_id array<bigint>, tag_name array<string>, commit_sha array<string>, trimmed boolean"
EVENTS = ("repo string, slice bigint, kind string, from_version string, to_version string, from_sha string, to_sha string, "
          "from_at bigint, from_id bigint, to_at bigint, to_id bigint")
PAIRED = [*PAIR, "from_sha", "to_sha"]
# Microseconds of publication that one entry of the state holds of a repository.
SLICE = 91 * 24 * 3600 * 10**6


def pairing(keep: int | None):
    """State function: events of one repository and slice for the releases that a micro-batch brings, in any order.

    pair   two neighbours in the order of publication that are new as a pair
    stale  a pair given before that a late release has split
    edge   the first (as from_version) and last (as to_version) release of the slice, where they are new
    late   with ``keep``: a release older than all that are kept (as to_version)
    """
    def run(key: tuple, batches, state: GroupState):
        known, trimmed = [], False
        if state.exists:
            *columns, trimmed = state.get
            known = list(zip(*columns, strict=True))
        seen, given, events = {r[:2] for r in known}, [], []

        def event(kind, a, b):
            events.append((*key, kind, a[2], b[2], a[3], b[3], *a[:2], *b[:2]))

        for batch in batches:
            given += [(int(r[0]), int(r[1]), *r[2:]) for r in batch[RELEASE].itertuples(index=False, name=None)]
        new = {}
        for release in sorted(given, key=lambda r: [(c is not None, c) for c in r]):
            if release[:2] in seen:
                continue
            if trimmed and release[:2] < known[0][:2]:
                event("late", [None] * 4, release)
                continue
            new.setdefault(release[:2], release)
        # Both lists are in order, so that putting them together takes time in proportion to their length.
        merged = sorted([*known, *new.values()], key=lambda r: r[:2])
        before = previous = None
        for release in merged:
            is_new = release[:2] in new
            if previous and (is_new or previous[:2] in new):
                event("pair", previous, release)
            if not is_new:
                if before and before is not previous:
                    event("stale", before, release)
                before = release
            previous = release
        if new and keep is None and (not known or merged[0] != known[0] or merged[-1] != known[-1]):
            event("edge", merged[0], merged[-1])
        if keep is not None and len(merged) > keep:
            merged, trimmed = merged[-keep:], True
        if new and merged:
            state.update((*[list(c) for c in zip(*merged, strict=True)], trimmed))
        # As objects, so that no number passes through a float beside a missing one.
        yield pd.DataFrame(events, columns=[c.split()[0] for c in EVENTS.split(", ")], dtype=object)

    return run


def release_events(releases: DataFrame, keep: int | None = None) -> DataFrame:
    """The events of a stream of releases, see :func:`pairing`. With ``keep``, a repository is one entry of the state."""
    slice_ = F.floor(F.col("at") / SLICE) if keep is None else F.lit(0).cast("long")
    rows = stable_releases(releases).select(
        "repo", F.unix_micros("published_at").alias("at"), "release_id", "tag_name", "commit_sha")
    return rows.withColumn("slice", slice_).groupBy("repo", "slice").applyInPandasWithState(
        pairing(keep), EVENTS, STATE, "update", GroupStateTimeout.NoTimeout)


def _across(edges: DataFrame, batch_id: int) -> DataFrame:
    """Pairs and stale pairs, as events, between neighbouring slices of the repositories that ``batch_id`` has edges of.

    ``edges`` are those of all batches up to this one. Neighbours before it and after it are compared; a repository has
    no more rows here than quarters.
    """
    first, last = (F.struct(*[f"{side}_{c}" for c in ("at", "id", "version", "sha")]) for side in ("from", "to"))
    touched = edges.filter(F.col("batch_id") == batch_id).select(F.col("repo").alias("_repo")).distinct()
    earlier = F.col("batch_id") < batch_id
    slices = edges.join(touched, F.col("repo").eqNullSafe(F.col("_repo")), "left_semi").groupBy("repo", "slice").agg(
        F.max(last).alias("a"), F.min(first).alias("first"),
        F.max(F.when(earlier, last)).alias("old_a"), F.min(F.when(earlier, first)).alias("old_first"))
    down = Window.partitionBy("repo").orderBy(F.desc("slice"))
    met = slices.select(
        "repo", "slice", "a", F.lag("first").over(down).alias("b"), "old_a",
        F.last("old_first", ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, -1)).alias("old_b"))
    same = F.col("a").eqNullSafe(F.col("old_a")) & F.col("b").eqNullSafe(F.col("old_b"))

    def events(kind, a, b):
        return met.filter(~same & F.col(a).isNotNull() & F.col(b).isNotNull()).select(
            "repo", F.lit(kind).alias("kind"), F.col(f"{a}.to_version").alias("from_version"), F.col(f"{b}.from_version").alias("to_version"),
            F.col(f"{a}.to_sha").alias("from_sha"), F.col(f"{b}.from_sha").alias("to_sha"))

    return events("pair", "a", "b").unionByName(events("stale", "old_a", "old_b"))


def _advance(events: DataFrame, batch_id: int, folder: str) -> DataFrame:
    """Write what one micro-batch gave (computed once), return its new pairs that it did not end itself."""
    spark, part = events.sparkSession, f"batch_id={batch_id}"
    events.write.mode("overwrite").parquet(f"{folder}/events/{part}")
    rows = spark.read.schema(EVENTS).parquet(f"{folder}/events/{part}")
    rows.filter("kind = 'edge'").drop("kind").write.mode("overwrite").parquet(f"{folder}/edges/{part}")
    edges = spark.read.schema(rows.drop("kind").withColumn("batch_id", F.lit(0).cast("long")).schema).parquet(f"{folder}/edges")
    changes = rows.filter("kind IN ('pair', 'stale')").select("repo", "kind", *PAIRED[1:]).unionByName(
        _across(edges.filter(F.col("batch_id") <= batch_id), batch_id))
    changes = written(changes, "pair_changes")
    late = rows.filter("kind = 'late'").select("repo", F.col("to_version").alias("tag_name"), F.col("to_sha").alias("commit_sha"))
    for name, table in (("pairs", changes.filter("kind = 'pair'").select(*PAIRED)), ("stale", changes.filter("kind = 'stale'").select(*PAIR)), ("late_releases", late)):
        table.write.mode("overwrite").parquet(f"{folder}/{name}/{part}")
    return changes.filter("kind = 'pair'").select(*PAIRED)


def _run(releases: DataFrame, folder: str, keep: int | None, each_batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        release_events(releases, keep).writeStream.outputMode("update").foreachBatch(each_batch)
        .option("checkpointLocation", f"{folder}/_progress")
        .trigger(availableNow=True)
        .start()
    )


def start_pairing(releases: DataFrame, folder: str, keep: int | None = None) -> StreamingQuery:
    """Pair the releases of a stream as they arrive, in any order; results for :func:`current_pairs`.

    All releases stay in the state, unless ``keep`` asks for a number of them for each repository: then one that is older than all of
    them is listed under ``folder/late_releases`` and left to :func:`catch_up`.
    """
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        _advance(batch, batch_id, folder)

    return _run(releases, folder, keep, each_batch)


def current_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs of all releases streamed so far."""
    pairs = spark.read.parquet(f"{folder}/pairs").select(*PAIRED)
    return pairs.join(spark.read.parquet(f"{folder}/stale"), PAIR, "left_anti")


def start_examples(
    releases: DataFrame,
    all_releases: Callable[[], DataFrame],
    files: Callable[[], DataFrame],
    folder: str,
    created_at: str,
    settings: Settings = Settings(),
    known_packages: DataFrame | None = None,
    system_prompt: str | None = DEFAULT_SYSTEM_PROMPT,
    keep: int | None = None,
) -> StreamingQuery:
    """Append the examples of new pairs to dataset, chat and example_meta folders.

    Examples of pairs that a late release has split are listed under ``stale``; :func:`current` leaves them out. ``all_releases`` and ``files`` are asked once per batch, so that tables that
    grow while the stream runs are read as they are then.
    """
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        pairs = _advance(batch, batch_id, folder)
        if pairs.isEmpty():
            return
        built = build_pairs(pairs, all_releases(), files(), created_at, settings, known_packages)
        _save(built, folder, batch_id, system_prompt)

    return _run(releases, folder, keep, each_batch)


def _save(built: Dataset, folder: str, batch_id: int, system_prompt: str | None) -> None:
    examples = written(with_sizes(built.examples), "examples")
    part = f"batch_id={batch_id}"
    save_examples_jsonl(examples, f"{folder}/dataset.jsonl/{part}", mode="overwrite")
    save_examples_chat_jsonl(examples, f"{folder}/dataset_chat.jsonl/{part}", system_prompt, mode="overwrite")
    example_meta(examples).write.mode("overwrite").parquet(f"{folder}/example_meta/{part}")
    built.rejects.write.mode("overwrite").parquet(f"{folder}/rejects/{part}")


def catch_up(
    releases: DataFrame, files: DataFrame, folder: str, created_at: str, settings: Settings = Settings(),
    known_packages: DataFrame | None = None, system_prompt: str | None = DEFAULT_SYSTEM_PROMPT,
) -> None:
    """Bring the output to what one batch over all ``releases`` and ``files`` gives.

    Pairs without an example, because a release came after all that were kept or its files came late, are built into a
    batch of a negative number; examples whose pair a late release has split are listed in
    ``stale`` and left out by :func:`current`. Run it while no stream writes to the folder.
    """
    spark = releases.sparkSession
    done = spark.read.parquet(f"{folder}/example_meta").withColumnRenamed("repo_name", "repo")
    wanted = written(release_pairs(releases).drop("pair_no"), "wanted")
    missing = written(wanted.join(done, PAIR, "left_anti"), "missing")
    stale = written(done.join(wanted, PAIR, "left_anti").select(*PAIR).distinct(), "stale")
    number = min(0, done.agg(F.min("batch_id")).first()[0] or 0) - 1
    _save(build_pairs(missing, releases, files, created_at, settings, known_packages), folder, number, system_prompt)
    stale.write.mode("overwrite").parquet(f"{folder}/stale/batch_id={number}")


def current(rows: DataFrame, folder: str) -> DataFrame:
    """The rows of an output table (by repo_name and versions) that no later release has made stale."""
    stale = rows.sparkSession.read.parquet(f"{folder}/stale").drop("batch_id").withColumnRenamed("repo", "repo_name")
    return rows.join(stale, ["repo_name", *PAIR[1:]], "left_anti")


def running_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics over everything streamed so far, from the light rows only."""
    return dataset_stats(spark.read.parquet(f"{folder}/example_meta"))
