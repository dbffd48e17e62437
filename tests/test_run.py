import os
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldloom.plans.run import Outside, Sources, available_videos, run_extraction
from fieldloom.operators.links import alias_roots
from fieldloom.sources import adapters, frames_out
from fieldloom.sources.inventory import video_index
from fieldloom.sources.settings import Settings

MAPPING = "row_num long, continent string, country string, state string, locality string, videos string, time_of_day string, start_time string, end_time string, vehicle_type string"
ROWS = [
    (2, "Asia", "India", "DL", "New Delhi", "[va,vb.mp4]", "[[0],[1]]", "[[0,30],[5]]", "[[20,10],[5]]", "[[2],[14]]"),
    (3, "Europe", "Germany", "", "Bonn", "vc", "", "[[0,10]]", "[[20,35]]", "[[0]]"),
    (4, "Europe", "Italy", "", "Rome", "[]", "[]", "[]", "[]", "[]"),
    (5, "Europe", "Spain", "", "Vigo", "[va,gone,../up]", "[[0,1],[0],[0]]", "[[0,50],[0],[0]]", "[[10,60],[10],[10]]", "[[0,1],[1],[1]]"),
    (6, "Europe", "Spain", "", "Lugo", "[bad]", "[[0,1]]", "[[0,100]]", "[[10,110]]", "[[0]]"),
]


class World:
    """A server and a store in a folder that all tasks see; what is asked for is written down there."""

    def __init__(self, root: Path) -> None:
        self.root, self.files = str(root), adapters.LocalStore(str(root))

    def note(self, kind: str, what: str) -> None:
        fd = os.open(f"{self.root}/log", os.O_WRONLY | os.O_APPEND | os.O_CREAT)
        os.write(fd, f"{kind} {what}\n".encode())
        os.close(fd)

    def notes(self) -> Counter:
        return Counter(Path(f"{self.root}/log").read_text().splitlines()) if os.path.exists(f"{self.root}/log") else Counter()

    def fetch(self, url: str):
        self.note("fetch", url)
        if "/a1/files/vb" in url:
            raise OSError(url)
        if url.endswith(("/a2/files/vb.mp4", "/a1/files/x/VC.mp4", "/a1/files/bad.mp4")):
            return iter([b"ab", b"cd"])
        return None

    def decode(self, path: str, frames: list[int]):
        self.note("decode", os.path.basename(path))
        if os.path.exists(f"{self.root}/broken"):
            raise RuntimeError("power cut")
        for f in frames:
            if "bad" in path and f == 2500:
                raise OSError("torn")
            yield f, f"{os.path.basename(path)}:{f}".encode()

    def probe(self, path: str):
        return (640, 480, 25.0)

    def outside(self) -> Outside:
        return Outside(self.fetch, self.decode, self.probe, self.files, self.files.move, self.files.remove)

    def shown(self) -> set[str]:
        return {str(p.relative_to(self.root)) for p in Path(self.root, "data").rglob("*.png") if ".staged" not in p.parts} if os.path.isdir(f"{self.root}/data") else set()

    def below(self, folder: str) -> set[str]:
        at = Path(self.root, folder)
        return {str(p.relative_to(at)) for p in at.rglob("*") if p.is_file()} if at.is_dir() else set()


def inputs(spark, world, existing=()):
    edges = spark.createDataFrame([("http://h/v/a1/browse", "http://h/v/a1/browse/x", None), ("http://h/v/a1/browse/x", "http://h/v/a1/files/x/VC.mp4", None)], "parent string, child string, label string")
    sources = Sources(["a1", "a2"], edges, alias_roots(spark, ["a1", "a2"], "http://h"))
    world.files("videos/va.mp4", b"here")
    files = spark.createDataFrame([("videos/va.mp4", "va.mp4")], "path string, file_name string")
    return spark.createDataFrame(ROWS, MAPPING), spark.createDataFrame([(p,) for p in existing], "path string"), files, Settings(base_url="http://h/"), world.outside(), sources


def table(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


def test_a_whole_run(spark, tmp_path):
    world = World(tmp_path / "w")
    (tmp_path / "w").mkdir()
    run = run_extraction(*inputs(spark, world), store=str(tmp_path / "s"), waves=2)
    assert table(run.videos, "video_key", "planned", "new", "path", "was_downloaded", "outcome") == sorted([
        ("../up", 2, 0, None, False, None), ("bad", 4, 2, "videos/bad.mp4", True, "deleted"), ("gone", 2, 0, None, False, None),
        ("va", 7, 7, "videos/va.mp4", False, None), ("vb", 1, 1, "videos/vb.mp4", True, "deleted"), ("vc", 4, 4, "videos/vc.mp4", True, "deleted"),
    ], key=repr)
    # a group's frames are there as a whole or not at all: of `bad` the second range breaks off
    assert table(run.groups.where("video_key = 'bad'"), "day_night", "planned", "new") == [("Day", 2, 2), ("Night", 2, 0)]
    shown = world.shown()
    assert len(shown) == 14 and not any("Night/Car/bad" in p for p in shown) and not world.below("data/.staged") and world.below("videos") == {"va.mp4"}
    one = next(p for p in shown if p.endswith("va_50.png"))
    assert Path(world.root, one).read_bytes() == b"va.mp4:1250"
    assert world.notes()["fetch http://h/v/a1/files/x/VC.mp4"] == 1 and not any("va.mp4" in n for n in world.notes() if n.startswith("fetch"))
    assert {r.key for r in run.index.collect()} == {"va.mp4", "va"}
    wrong = Counter(r.reason for r in run.problems.collect())
    assert wrong["no videos"] == 1 and wrong["end before start"] == 1 and wrong["missing times of day"] == 1
    # all is there: nothing is fetched or decoded but for what failed
    before = world.notes()
    again = run_extraction(*inputs(spark, world, shown), store=str(tmp_path / "s2"))
    assert table(again.videos, "video_key", "new") == [("../up", 0), ("bad", 0), ("gone", 0)]
    assert {n.split("/")[-1] for n in (world.notes() - before)} == {"bad.mp4", "decode bad.mp4", "gone.mp4"}


def test_a_run_that_was_stopped_goes_on(spark, tmp_path):
    world = World(tmp_path / "w")
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "broken").touch()
    with pytest.raises(Exception, match="power cut"):
        run_extraction(*inputs(spark, world), store=str(tmp_path / "s"))
    fetched = {n: c for n, c in world.notes().items() if n.startswith("fetch")}
    assert not world.shown() and world.below("videos") == {"va.mp4", "vb.mp4", "vc.mp4", "bad.mp4"}
    (tmp_path / "w" / "broken").unlink()
    # files that this run has fetched are found in the folder by now; they are still its own, to be deleted
    mapping, existing, files, *rest = inputs(spark, world)
    more = files.unionByName(spark.createDataFrame([("videos/vb.mp4", "vb.mp4")], "path string, file_name string"))
    run = run_extraction(mapping, existing, more, *rest, store=str(tmp_path / "s"))
    assert {n: c for n, c in world.notes().items() if n.startswith("fetch")} == fetched
    assert len(world.shown()) == 14 and world.below("videos") == {"va.mp4"} and run.videos.where("outcome = 'deleted'").count() == 3
    # after the end a further call only reads what is stored
    before = world.notes()
    assert run_extraction(mapping, existing, files, *rest, store=str(tmp_path / "s")).videos.agg(F.sum("new")).first()[0] == 14 and world.notes() == before


def test_frames_appear_as_a_group(spark, tmp_path):
    """A torn video, a repeated attempt, a move that is repeated: no part of a group is seen."""
    store = adapters.LocalStore(str(tmp_path))
    plan = spark.createDataFrame([("v", i, f"out/g{i % 2}/{i}.png", i % 2) for i in range(6)] + [("w", 0, "out/g2/0.png", 2)], "video_path string, frame int, path string, g int")

    def decode(path, frames):
        for f in frames:
            if f == 5:
                raise OSError("torn")
            yield f, b"x" * f

    for attempt in range(2):
        frames_out.stage(plan, decode, store).collect()
    staged = frames_out.stage(plan, decode, store)
    staged.write.parquet(str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    assert not (tmp_path / "out").exists() and {r.path for r in staged.where("at is null").collect()} == {"out/g1/5.png"}
    committed = frames_out.complete_groups(plan, staged, ["g"])
    assert sorted(r.path for r in committed.collect()) == ["out/g0/0.png", "out/g0/2.png", "out/g0/4.png", "out/g2/0.png"]
    for attempt in range(2):
        promoted = frames_out.promote(committed, store.move).collect()
        assert all(r.stored for r in promoted) and sorted(p.name for p in (tmp_path / "out").rglob("*.png")) == ["0.png", "0.png", "2.png", "4.png"]
    gone = frames_out.remove_staged(staged, frames_out.promote(committed, store.move), store.remove).collect()
    assert len(gone) == 2 and {r.outcome for r in gone} == {"deleted"}


def test_contents_that_break_off_leave_nothing(tmp_path):
    store = adapters.LocalStore(str(tmp_path))

    def torn():
        yield b"half"
        raise OSError("reset")

    with pytest.raises(OSError):
        store("a/v.mp4", torn())
    assert list((tmp_path / "a").iterdir()) == []
    store("a/v.mp4", iter([b"1", b"2"]))
    assert (tmp_path / "a" / "v.mp4").read_bytes() == b"12" and store.remove("a/v.mp4") and not store.remove("a/v.mp4")
    once = adapters.Remembering(lambda u: u.encode(), most=2)
    assert [once(u) for u in "abca"] == [b"a", b"b", b"c", b"a"] and list(once.had) == ["c", "a"]


def test_videos_are_looked_for_by_name_and_stem(spark, tmp_path):
    (tmp_path / "w").mkdir()
    world = World(tmp_path / "w")
    index = video_index(spark.createDataFrame([("k/VB.MP4", "VB.MP4")], "path string, file_name string"))
    wanted = spark.createDataFrame([("vb", "vb"), ("vb", "vb.mp4"), ("bad", "bad"), ("no", "no")], "video_key string, video string")
    got = available_videos(wanted, index, Sources(["a1"]), world.outside(), Settings(base_url="http://h", videos="vids"))
    assert table(got, "video_key", "path", "was_downloaded") == [("bad", "vids/bad.mp4", True), ("no", None, False), ("vb", "k/VB.MP4", False)]
    assert available_videos(wanted.limit(0), index, Sources(["a1"]), world.outside(), Settings()).count() == 0
