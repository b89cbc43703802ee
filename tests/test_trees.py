import random

import pytest
from pyspark.sql import functions as F

from codelineage.operators import diff, joins, trees
from helpers import files

SCHEMA = "repo string, from_version string, to_version string"


def changes(df):
    return sorted((r.repo, r.from_version, r.path, r.change_type, r.old_sha, r.new_sha) for r in df.collect())


def random_snapshots(rng):
    """Three releases of two repositories: nested folders, odd slashes, a path that turns from file to folder."""
    names = ["a", "b", "c d", "", "é", "x.py"]
    rows = []
    for repo in ("o/r", "p/q"):
        held = {"/".join(rng.choices(names, k=rng.randint(1, 6))): str(rng.randint(0, 9)) for _ in range(60)}
        for version in ("v1", "v2", "v3"):
            rows += [(repo, version, p, c) for p, c in held.items()]
            for p in rng.sample(sorted(held), 8):
                if rng.random() < 0.5:
                    held[p] = str(rng.randint(10, 99))
                else:
                    held[p + "/" + rng.choice(names)] = held.pop(p)
    return rows


@pytest.mark.parametrize("seed,levels,large", [(1, 32, False), (2, 2, False), (3, 32, True)])
def test_trees_give_the_changes_of_all_paths(spark, monkeypatch, seed, levels, large):
    monkeypatch.setattr(trees, "LEVELS", levels)
    if large:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    rows = random_snapshots(random.Random(seed))
    table = files(spark, rows)
    pairs = spark.createDataFrame([(r, a, b) for r in ("o/r", "p/q", "no/ne") for a, b in (("v1", "v2"), ("v2", "v3"), ("v1", "v9"))], SCHEMA)
    got = trees.tree_changes(pairs, trees.folder_trees(table))
    assert changes(got) == changes(diff.path_changes(pairs, table)) and got.count() > 100
    assert got.columns == [*trees.PAIR, "path", "old_sha", "new_sha", "change_type"]


def test_one_changed_file_touches_only_its_path(spark, monkeypatch):
    paths = [f"f{i}/g{j}/h{k}.py" for i in range(8) for j in range(8) for k in range(8)]
    rows = [("r", v, p, "2" if v == "v2" and p == "f3/g4/h5.py" else "1") for v in ("v1", "v2") for p in paths]
    seen, compared = [], trees.compared

    def counting(open_, entries):
        met = compared(open_, entries)
        seen.append(met.count())
        return met

    monkeypatch.setattr(trees, "compared", counting)
    pairs = spark.createDataFrame([("r", "v1", "v2"), ("r", "v1", "v1")], SCHEMA)
    got = trees.tree_changes(pairs, trees.folder_trees(files(spark, rows)))
    assert [(r.path, r.change_type) for r in got.collect()] == [("f3/g4/h5.py", "modified")]
    assert seen == [2, 8, 8, 8]  # both roots, then the folders on the path alone


def test_trees_are_kept_and_used_by_the_diff(spark, tmp_path):
    rows = [("r", "v1", "d/x", "same\n"), ("r", "v1", "k", "1"), ("r", "v2", "e/x", "same\n"), ("r", "v2", "k", "2")]
    table = files(spark, rows)
    for version in ("v1", "v2"):
        trees.save_trees(trees.folder_trees(table.filter(F.col("version") == version)), str(tmp_path / "trees"))
    kept = trees.read_trees(spark, str(tmp_path / "trees"))
    pairs = spark.createDataFrame([("r", "v1", "v2")], SCHEMA)
    plain, by_tree = diff.file_diffs(pairs, table), diff.file_diffs(pairs, table, trees=kept)
    assert sorted(by_tree.collect()) == sorted(plain.collect()) and by_tree.count() == 2


def test_repeated_rows_nulls_and_nothing(spark):
    table = files(spark, [("r", "v1", "a/b", "1"), ("r", "v1", "a/b", "2"), ("r", "v2", "a/b", "1"), ("r", "v2", "a/b", "2"), ("r", "v2", None, "3")])
    pairs = spark.createDataFrame([("r", "v1", "v2"), ("r", "v1", "v2")], SCHEMA)
    assert trees.tree_changes(pairs, trees.folder_trees(table)).count() == 0
    nothing = trees.folder_trees(table.limit(0))
    assert nothing.count() == 0 and trees.tree_changes(pairs, nothing).count() == 0
    assert trees.tree_changes(pairs.limit(0), trees.folder_trees(table)).count() == 0
