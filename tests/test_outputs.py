from collections import Counter
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.operators import manifests, sampling
from fieldloom.sources import folders

FRAMES = ", ".join(f"{c} string" for c in ("url", "filename", "alias", "continent", "country", "state", "city", "day_night", "vehicle", "video_id"))


def named(spark, rows, taken=None):
    frame = spark.createDataFrame(list(enumerate(rows)), "i int, n string")
    there = None if taken is None else spark.createDataFrame([(t,) for t in taken], "name string")
    return [r.local_name for r in sorted(manifests.without_collisions(frame, "n", ["i"], taken=there).collect(), key=lambda r: r.i)]


def test_names_fill_the_gaps_between_taken_ones(spark):
    assert named(spark, ["a.png"] * 3, ["a.png", "a_1.png", "a_3.png"]) == ["a_2.png", "a_4.png", "a_5.png"]
    assert named(spark, ["a.png"] * 3, ["a_1.png", "b.png"]) == ["a.png", "a_2.png", "a_3.png"]
    assert named(spark, ["a.png", "a.png", "a_1.png", "b.png", "a.png"]) == ["a.png", "a_2.png", "a_1.png", "b.png", "a_3.png"]
    assert named(spark, [".x", ".x", "a_01.png", "a.png", "a.png", None, "a_1", "a"], []) == [".x", ".x_1", "a_01.png", "a.png", "a_1.png", None, "a_1", "a"]
    assert named(spark, [], ["a"]) == []


NAMES = st.sampled_from(["a.png", "a_1.png", "a_2.png", "a_1_1.png", "a_3.png", "b", "b_2", "b_1_2"])


@given(st.lists(NAMES, max_size=12), st.lists(NAMES, max_size=6))
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
def test_names_one_after_the_other(spark, rows, taken):
    got = named(spark, rows, taken)
    assert len(set(got)) == len(got) and not set(got) & set(taken)
    free = {}
    for name, made in zip(rows, got):  # each takes the first that is neither taken nor another row's own name
        stem, dot = (name[: -len(".png")], ".png") if name.endswith(".png") else (name, "")
        n = free.get(name, 0)
        while (n == 0 and name in taken) or (n > 0 and (c := f"{stem}_{n}{dot}") and (c in taken or c in rows)):
            n += 1
        assert made == (name if n == 0 else f"{stem}_{n}{dot}")
        free[name] = n + 1


def test_manifests_never_overwrite(spark, tmp_path):
    rows = spark.createDataFrame([tuple(f'{c} "{i}", ü' for c in manifests.COLUMNS) for i in range(3)], ", ".join(f"{c} string" for c in manifests.COLUMNS))
    path = str(tmp_path / "out" / "selected.csv")
    made = [manifests.write_manifest(rows.limit(n), path) for n in (3, 2, 1)]
    assert [Path(m).name for m in made] == ["selected.csv", "selected_1.csv", "selected_2.csv"]
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == ["selected.csv", "selected_1.csv", "selected_2.csv"]
    for m, n in zip(made, (3, 2, 1)):
        back = spark.read.option("header", True).option("escape", '"').csv(m)
        assert back.columns == list(manifests.COLUMNS) and back.count() == n and {r.alias for r in back.collect()} <= {r.alias for r in rows.collect()}


def test_cleanup_takes_its_own_files_only(spark, tmp_path):
    at = tmp_path / "out"
    for name in ("notes.tmp", "a.PNG", "b.jpg.tmp", "c.csv", "keep.txt", "deep/er/d.webp", "deep/er/x.mp4", "gone/in/e.jpeg", "with space/é#%41.png"):
        (at / name).parent.mkdir(parents=True, exist_ok=True)
        (at / name).write_text("x")
    got = folders.clean_output(spark, str(at), folders.remove_local, folders.remove_empty_local).collect()
    assert Counter(r.outcome for r in got) == {"deleted": 6}
    assert sorted(str(p.relative_to(at)) for p in at.rglob("*")) == ["deep", "deep/er", "deep/er/x.mp4", "keep.txt", "notes.tmp"]

    def stubborn(path):
        raise OSError(path)

    (at / "c.csv").write_text("x")
    assert [r.outcome for r in folders.clean_output(spark, str(at), stubborn).collect()] == ["failed"] and (at / "c.csv").exists()
    assert folders.clean_output(spark, str(tmp_path / "none"), stubborn).count() == 0
    for bad in ("/", ".", str(Path.home())):
        with pytest.raises(ValueError):
            folders.clean_output(spark, bad, stubborn)


def ranked_fill(inventory, taken, remaining, seed, per_folder):
    """The fill pass over the whole inventory."""
    left = sampling.cap_per_folder(inventory.join(taken.select("url"), "url", "left_anti"), per_folder, seed)
    return left.orderBy(sampling.draw(seed, "fill", *sampling.LEVELS), *sampling.walk_order(seed)).limit(max(0, remaining))


def test_fill_pass_ranks_the_folders_it_needs(spark):
    rows = [(f"u/{c}/{v}/{i}", f"{i}", "a", "E", f"C{c % 3}", "s", f"c{c}", "Day" if v % 2 else "Night", "Car", f"v{v}") for c in range(8) for v in range(c % 4 + 1) for i in range(1 + (c * v) % 8)]
    rows += rows[:3] * 4  # addresses on several rows
    inventory = spark.createDataFrame(rows, FRAMES).cache()
    folders_found = sampling.folder_counts(inventory)
    taken = inventory.where("cast(filename as int) % 3 = 0").cache()
    for remaining, per_folder in ((1, 5), (9, 2), (20, 5), (1000, 3)):
        got = sampling.fill_pass(inventory, folders_found, taken, remaining, "4", per_folder)
        want = ranked_fill(inventory, taken, remaining, "4", per_folder)
        assert sorted(r.url for r in got.collect()) == sorted(r.url for r in want.collect())
    few = sampling.fill_folders(folders_found, taken, 3, "4", 5).count()
    assert 0 < few <= 3 < folders_found.count()
    assert sampling.fill_pass(inventory, folders_found, inventory, 5, "4").where(F.lit(True)).count() == 0
