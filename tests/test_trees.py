"""Comparison of manifests by the digests of their folders."""

import random

import pytest

from lanehouse.operators.joins import manifest_verify
from lanehouse.plans import trees


def files(rng, folders=60):
    names = ["", *("/".join(f"d{rng.randrange(3)}" for _ in range(rng.randrange(1, 6))) for _ in range(folders))]
    return {f"{name}/f{k}".lstrip("/"): f"{rng.random():.9f}" for name in sorted(set(names)) for k in range(rng.randrange(1, 8))}


def frame(spark, listed):
    return spark.createDataFrame([(p, d, "x") for p, d in listed.items()], "path string, md5 string, folder string")


@pytest.mark.parametrize("changes", [0, 1, 5, 100])
def test_verdicts_are_those_of_all_files(spark, tmp_path, changes):
    rng = random.Random(changes)
    want = files(rng)
    have = dict(want)
    for path in rng.sample(sorted(want), min(changes, len(want))):
        kind = rng.randrange(4)
        if kind:
            have.pop(path)
        if kind == 1:
            have[path] = "other"
        elif kind == 2:
            # a file that has moved within its folder, and one in a folder of its own
            have[path + ".new"] = want[path]
            have[path + "/deep/er"] = None
    expected, actual = str(tmp_path / "a"), str(tmp_path / "b")
    trees.write_tree(frame(spark, want), expected)
    trees.write_tree(frame(spark, have).repartition(3), actual)
    got = trees.compare_trees(spark, expected, actual)
    plain = manifest_verify(frame(spark, want), frame(spark, have)).where("verdict <> 'OK'")
    assert sorted(map(tuple, got.verdicts.collect())) == sorted(map(tuple, plain.collect()))
    changed = {p.rpartition("/")[0] for p in {*want, *have} if want.get(p, 0) != have.get(p, 0)}
    assert {r.folder for r in got.folders.collect()} == changed
    # of the files, only the parts of these folders are read: few where few folders differ
    read = spark.read.parquet(f"{expected}/files")
    assert len(got.parts) <= len(changed)
    if len(changed) <= 5:
        assert read.where(read.part.isin(got.parts)).count() <= len(want) * 0.1 * len(changed)


def test_digests_of_folders(spark):
    rows = [("a/x", "1"), ("a/b/y", "2"), ("a/b/y", "2"), ("z", None)]
    digests = trees.folder_digests(spark.createDataFrame(rows, "path string, md5 string"))
    got = {r.folder: r for r in digests.collect()}
    assert {k: (r.parent, r.depth, r.files) for k, r in got.items()} == {
        "": (None, 0, 4), "a": ("", 1, 3), "a/b": ("a", 2, 2),
    }
    # a folder's sum is its own files' and its subfolders'
    for k in ("0", "1"):
        assert got[""]["all" + k] == got[""]["own" + k] + got["a"]["all" + k]
        assert got["a"]["all" + k] == got["a"]["own" + k] + got["a/b"]["all" + k]
    turned = trees.folder_digests(spark.createDataFrame(rows[::-1], "path string, md5 string").repartition(3))
    assert sorted(map(repr, turned.collect())) == sorted(map(repr, got.values()))


def test_empty_manifests(spark, tmp_path):
    none, one = spark.createDataFrame([], "path string, md5 string"), frame(spark, {"a/b": "1"})
    for name, rows in {"none": none, "one": one}.items():
        trees.write_tree(rows, f"{tmp_path}/{name}")

    def verdicts(a, b):
        return [tuple(r) for r in trees.compare_trees(spark, f"{tmp_path}/{a}", f"{tmp_path}/{b}").verdicts.collect()]

    assert verdicts("none", "none") == [] == verdicts("one", "one")
    assert verdicts("none", "one") == [("a/b", "EXTRA")] and verdicts("one", "none") == [("a/b", "MISSING")]
