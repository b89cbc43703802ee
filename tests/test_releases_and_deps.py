import pytest
from pyspark.sql import functions as F

from codelineage import dims
from codelineage.functions.text import human_size
from codelineage.operators import deps, releases as ops
from helpers import by, files, releases

LIST = [("o/r", "v1.0", "2024-01-01", 1), ("o/r", "v1.10", "2024-01-03", 4), ("o/r", "V1.1", "2024-01-02", 3), ("o/r", "v1.0.1", "2024-01-02", 2),
        ("o/r", "v2-rc", "2024-01-04", 5, True), ("o/r", "v2", "2024-01-05", 6)]
CHAIN = ["v1.0", "v1.0.1", "V1.1", "v1.10", "v2"]


def pairs_of(spark, min_version=None, max_versions=None, **options):
    config = spark.createDataFrame([("o/r", min_version, max_versions)], "name string, min_version string, max_versions int")
    rows = ops.release_pairs(releases(spark, LIST), config, **options).orderBy("pair_no").collect()
    return [(r.from_version, r.to_version) for r in rows]


def chain(tags):
    return list(zip(tags, tags[1:]))


@pytest.mark.parametrize("minimum,maximum,want", [
    (None, None, chain(CHAIN)), (None, 0, chain(CHAIN)), (None, 2, chain(CHAIN)[:2]), ("1.1", None, chain(CHAIN[2:])),
    ("v1.10", 1, chain(CHAIN[3:])), ("9", None, chain(CHAIN)), ("", None, chain(CHAIN)), ("2", None, [])])
def test_pairs(spark, minimum, maximum, want):
    assert pairs_of(spark, minimum, maximum) == want


def test_prereleases_can_be_kept_and_single_releases_have_no_pair(spark):
    assert ("v1.10", "v2-rc") in pairs_of(spark, skip_prereleases=False)
    assert ops.release_pairs(releases(spark, [("a/b", "v1", "2024-01-01", 1)])).count() == 0
    assert ops.release_pairs(releases(spark, [("a/b", "v1", "2024-01-01", 1, True), ("a/b", "v2", "2024-01-02", 2, True)])).count() == 0


def test_tags(spark):
    refs = spark.createDataFrame([("r", "light", "commit", "c1"), ("r", "annotated", "tag", "t1"), ("r", "broken", "tag", "t2")],
                                 "repo string, tag_name string, ref_type string, ref_sha string")
    objects = spark.createDataFrame([("r", "t1", "c2")], "repo string, tag_sha string, commit_sha string")
    assert {t: r.commit_sha for t, r in by(ops.tag_commits(refs, objects), "tag_name").items()} == {"light": "c1", "annotated": "c2", "broken": None}


PYPROJECT = """
[project]
dependencies = ["torch>=2 # gpu", "numpy[x]==1", "./local", "Requests"]
[tool.poetry.dependencies]
python = "^3.9"
ray = "^2"
dask = {version = "1.2", extras = ["y"]}
numpy = "*"
"""
SETUP = "setup(install_requires=[\n 'scipy', \"pandas<3\", 'ray[tune]', 'lost'],\n extras_require={})"
REQUIREMENTS = "# c\n-r base.txt\n\nTORCH==1\r\nflax >= 0.1 ; python_version > '3'\ngit+https://x/y\nhttps://x/z.whl\nruamel.yaml\n  jax  \n"


def manifest_rows(version="v1", **others):
    base = {"pyproject.toml": PYPROJECT, "setup.py": SETUP, "requirements.txt": REQUIREMENTS, "docs/requirements-extra.txt": "sphinx\n",
            "tests/requirements.txt": "pytest\n", "requirements-DEV.txt": "black\n", "docs/setup.py": "install_requires=['no']"}
    return [("o/r", version, p, c) for p, c in {**base, **others}.items()]


def test_manifests(spark):
    got = deps.dependencies(files(spark, manifest_rows()), dims.known_packages(spark)).orderBy(*deps.PLACE).collect()
    assert [(r.name, r.version_spec, r.github_repo) for r in got] == [
        ("torch", ">=2", "pytorch/pytorch"), ("numpy", "==1", "numpy/numpy"), ("Requests", None, None), ("ray", "^2", "ray-project/ray"),
        ("dask", "1.2", "dask/dask"), ("scipy", None, "scipy/scipy"), ("pandas", "<3", "pandas-dev/pandas"),
        ("flax", ">= 0.1 ; python_version > '3'", "google/flax"), ("ruamel", ".yaml", None), ("jax", None, "google/jax"), ("sphinx", None, None)]


def test_broken_manifests_are_reported_and_do_not_fail_others(spark):
    broken = {"pyproject.toml": "= nope", "setup.py": b"\xff", "requirements.txt": "torch\n"}
    listed = '[tool.poetry.dependencies]\nray = ["1"]\n'
    rows = files(spark, manifest_rows("v2", **broken) + [("o/s", "v1", "pyproject.toml", listed)])
    names = {r.name for r in deps.dependencies(rows, dims.known_packages(spark)).collect()}
    assert names == {"torch", "sphinx"}
    assert {(r.repo, r.path) for r in deps.manifest_errors(rows).collect()} == {("o/r", "pyproject.toml"), ("o/r", "setup.py"), ("o/s", "pyproject.toml")}


def test_summary(spark):
    rows = files(spark, [("o/r", "v1", "requirements.txt", "torch>=1\nsix\n")])
    got = deps.dependency_summaries(deps.dependencies(rows, dims.known_packages(spark))).first().summary
    assert got == "# Dependencies\n\n✓ torch: >=1\n   GitHub: pytorch/pytorch\n? six: any"


@pytest.mark.parametrize("count,by_priority", [(10, False), (11, True), (30, True)])
def test_the_ten_most_important_dependencies(spark, count, by_priority):
    names = list(dims.KNOWN_PACKAGES)[:count][::-1]
    rows = files(spark, [("o/r", "v1", "requirements.txt", "\n".join(names))])
    got = deps.selected(deps.dependencies(rows, dims.known_packages(spark)), 10).orderBy("dep_rank").collect()
    want = names[::-1][:10] if by_priority else names
    assert [r.name for r in got] == want and [r.dep_rank for r in got] == list(range(1, 11))


def test_without_a_limit_all_dependencies_by_mention(spark):
    names = list(dims.KNOWN_PACKAGES)[:30][::-1]
    rows = files(spark, [("o/r", "v1", "requirements.txt", "\n".join(names))])
    got = deps.selected(deps.dependencies(rows, dims.known_packages(spark))).orderBy("dep_rank").collect()
    assert [(r.name, r.dep_rank) for r in got] == [(n, i) for i, n in enumerate(names, 1)]


def test_aliases_of_one_repository(spark):
    rows = deps.dependencies(files(spark, [("o/r", "v1", "requirements.txt", "pytorch\ntorch\njax")]), dims.known_packages(spark))
    assert [r.github_repo for r in deps.selected(rows).orderBy("dep_rank").collect()] == ["pytorch/pytorch", "pytorch/pytorch", "google/jax"]
    assert [r.name for r in deps.selected(rows, dedupe_repo=True).orderBy("dep_rank").collect()] == ["pytorch", "jax"]


def test_sizes(spark):
    rows = spark.createDataFrame([(999.0,), (1000.0,), (1125000.0,), (1e9,), (0.4,)], "n double")
    got = [r[0] for r in rows.select(human_size(F.col("n"))).collect()]
    assert got == ["999 bytes", "1.00 KB", "1.12 MB", "1.00 GB", "0 bytes"]
