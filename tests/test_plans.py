import hashlib
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldloom.operators import links, manifests, sampling
from fieldloom.operators.filters import location_rows
from fieldloom.plans.extraction import decode_plan, plan_extraction
from fieldloom.plans.sample import sample_manifest, save_sample
from fieldloom.sources import adapters, folders, frames_out, logs
from fieldloom.sources.inventory import add_video, remove_video, scan_files, video_index
from fieldloom.sources.mapping import numbered, read_mapping, require_columns
from fieldloom.sources.settings import Settings, complete, read_settings
from fieldloom.streaming.mapping_stream import stream_mapping, write_frames

CSV = '''﻿continent,country,state,locality,videos,time_of_day,start_time,end_time,vehicle_type
Asia,India,DL,New Delhi,"[va,vb.mp4]","[[0],[1]]","[[0,30],[5]]","[[20,10],[5]]","[[2],[14]]"
Europe,Germany,,München,vc,,"[[0,10]]","[[20,35]]","[[0]]"
Europe,Netherlands,[],"Eind:hoven",[],[],[],[],[]
Europe,Netherlands,None,Tilburg,"[va]","[[0,1]]","[[0,50,90]]","[[10,60]]","[[0,,1]]"
'''


@pytest.fixture
def mapping(spark, tmp_path):
    (tmp_path / "mapping.csv").write_text(CSV, encoding="utf-8")
    return read_mapping(spark, str(tmp_path / "mapping.csv"))


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_mapping_to_frames_and_rerun(spark, mapping):
    index = video_index(spark.createDataFrame([("/v/va.mp4", "va.mp4")], "path string, file_name string"))
    plan = plan_extraction(mapping, empty(spark, "path string"), index, Settings())
    got = {(r.row_num, r.video, r.day_night, r.vehicle): [] for r in plan.frames.collect()}
    for r in plan.frames.collect():
        got[r.row_num, r.video, r.day_night, r.vehicle].append(r.t)
    assert {k: sorted(v) for k, v in got.items()} == {
        (2, "va", "Day", "Truck"): [0, 10, 20], (2, "vb.mp4", "Night", "Unknown_14"): [5], (3, "vc", "Unknown", "Car"): [0, 10, 20, 30],
        (5, "va", "Day", "Car"): [0, 10], (5, "va", "Night", "Bus"): [50, 60],
    }
    assert "data/Asia/India/DL/New Delhi/Night/Unknown_14/vb/vb_5.png" in {r.path for r in plan.frames.collect()}
    assert {r.state for r in plan.frames.where("row_num = 3").collect()} == {None} and {r.path.split("/")[3] for r in plan.frames.where("row_num = 3").collect()} == {"unknown"}
    uses = {(r.row_num, r.video_key): (r.remaining, r.deletable) for r in plan.uses.collect()}
    assert uses == {(2, "va"): (1, False), (5, "va"): (0, False), (2, "vb"): (0, True), (3, "vc"): (0, True)}
    done = plan_extraction(mapping, plan.frames.select("path"), index, Settings())
    assert done.todo.count() == 0
    partial = plan.frames.select("path").where("path not like '%va_10.png'")
    again = plan_extraction(mapping, partial, index, Settings())
    assert {(r.row_num, r.t) for r in again.todo.collect()} == {(2, 0), (2, 10), (2, 20), (5, 0), (5, 10)}
    fps = spark.createDataFrame([("/v/va.mp4", 29.97)], "path string, fps double")
    todo = decode_plan(plan.todo, index, fps)
    files = adapters.MemoryFiles({})
    out = frames_out.stage(todo, lambda path, frames: {f: b"png" for f in frames if f < 1000}, files.store).collect()
    assert len(out) == 7 and sum(r.at is not None for r in out) == 5 and {r.reason for r in out} == {None, "not decoded"}


def test_mapping_checks(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("continent,country\nx,y\n")
    with pytest.raises(ValueError, match="Missing required column in CSV: state"):
        read_mapping(spark, str(tmp_path / "bad.csv"))
    with pytest.raises(ValueError):
        require_columns(empty(spark, "a int"))


def test_settings(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"base_url": "http://h/", "DAY_NIGHTS": ["Day"], "num_images": 5}))
    assert read_settings(str(tmp_path / "c.json")) == Settings(base_url="http://h/", day_nights=("Day",), num_images=5)
    for bad in ({"num_images": 0}, {"base_url": " "}, {"interval_seconds": 0}):
        with pytest.raises(ValueError):
            Settings(**bad)
    assert complete({"a": 1}, {"b": 2}) and not complete({}, {"b": 2})
    (tmp_path / "d.json").write_text(json.dumps(dict.fromkeys("abc", 1)))
    assert read_settings(str(tmp_path / "c.json"), str(tmp_path / "d.json")).num_images == 5
    (tmp_path / "d.json").write_text(json.dumps(dict.fromkeys("abcd", 1)))
    (tmp_path / "e.json").write_text("{")
    (tmp_path / "f.json").write_text("[]")
    for path, default, said in (("c", "d", "fewer"), ("c", "e", "e.json"), ("e", "d", "e.json"), ("f", "d", "no object"), ("none", "d", "none.json")):
        with pytest.raises(ValueError, match=said):
            read_settings(str(tmp_path / f"{path}.json"), str(tmp_path / f"{default}.json"))


def test_location_tree():
    assert location_rows("ALL") == location_rows({}) == location_rows(None) == [(None,) * 4]
    tree = {"Asia": {"India": {"DL": ["New Delhi", "New Delhi"], "KA": "all"}, "Japan": None}, "Europe": {"Germany": {"unknown": "A, B"}}}
    assert location_rows(tree) == [("Asia", "India", "DL", "New Delhi"), ("Asia", "India", "KA", None), ("Asia", "Japan", None, None), ("Europe", "Germany", "unknown", "A"), ("Europe", "Germany", "unknown", "B")]
    with pytest.raises(ValueError, match="Asia"):
        location_rows({"Asia": ["India"]})


def test_sample_and_manifest(spark, tmp_path):
    rows = [(f"http://h/{c}/{v}/{i}.png", f"{i}.png", "a", "E", c, "s", f"city{c}", "Day" if i % 2 else "Night", "Car", f"v{v}") for c in "XYZ" for v in range(4) for i in range(6)]
    inventory = spark.createDataFrame(rows, "url string, filename string, alias string, continent string, country string, state string, city string, day_night string, vehicle string, video_id string")
    settings = Settings(num_images=30, day_nights=("day",), vehicles=("CAR",), seed="3")
    got = sample_manifest(inventory, settings)
    found = got.collect()
    assert got.columns == list(manifests.COLUMNS) and len(found) == len({r.source_url for r in found}) == len({r.local_path for r in found}) == 30
    assert {r.day_night for r in found} == {"Day"}
    assert {r.source_url for r in found} == {r.source_url for r in sample_manifest(inventory.repartition(5), settings).collect()}
    few = sample_manifest(inventory, Settings(num_images=6, seed="3")).collect()
    assert sorted(r.country for r in few) == list("XXYYZZ")
    with pytest.raises(FileNotFoundError):
        sample_manifest(inventory, Settings(vehicles=("Tram",)))
    manifests.write_manifest(got, str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).count() == 30
    assert len(sample_manifest(inventory, Settings(num_images=5, balanced=False)).collect()) == 5


def test_collisions(spark):
    rows = [(i, n) for i, n in enumerate(["a.png", "a.png", "a_1.png", "b.png", "a.png"])]
    got = manifests.without_collisions(spark.createDataFrame(rows, "i int, n string"), "n", ["i"]).collect()
    names = [r.local_name for r in sorted(got, key=lambda r: r.i)]
    assert names[0] == "a.png" and names[3] == "b.png" and len(set(names)) == 5


def test_files_and_links(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for n in ("A.MP4", "b.mp4", "c.txt"):
        (tmp_path / "d" / n).write_text("x")
    index = video_index(scan_files(spark, str(tmp_path)))
    assert {r.key for r in index.collect()} == {"a.mp4", "a", "b.mp4", "b"}
    more = add_video(index, spark.createDataFrame([("/n/b.mp4", "b.mp4")], "path string, file_name string"))
    assert {r.key: r.path for r in more.collect()}["b"] == "/n/b.mp4" and more.count() == 4
    assert remove_video(more, spark.createDataFrame([("/n/b.mp4",)], "path string")).count() == 2
    page = '<a href="/v/a/browse/x/y">Y</a><a href="/v/a/browse">back</a><a href="../z">..</a><a href="/v/a/files/x/v%20w.mp4"><b>v</b></a><a href="/v/a/browse/x/y">Y</a><a>none'
    found = links.browse_links(links.anchors(spark.createDataFrame([("http://h/v/a/browse/x", page)], "url string, html string"))).collect()
    assert {(r.name, r.kind) for r in found} == {("y", "folder"), ("v w.mp4", "file")} and len(found) == 2
    loop = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "a"), ("b", "r")], "parent string, child string")
    assert {(r.node, r.depth) for r in links.reachable(loop, spark.createDataFrame([("r",)], "node string")).collect()} == {("r", 0), ("a", 1), ("b", 2)}


def test_adapters_and_guards(spark, tmp_path):
    files = adapters.MemoryFiles({"u1": b"x"})
    got = adapters.download(spark.createDataFrame([("u1", "p1"), ("u2", "p2")], "source_url string, local_path string"), files.fetch, files.store).collect()
    assert {(r.url, r.stored) for r in got} == {("u1", True), ("u2", False)}
    tried = spark.createDataFrame([("v", "u2", 0), ("v", "u1", 1), ("w", "u3", 0)], "name string, url string, priority int")
    assert [(r.name, r.url) for r in adapters.first_available(tried, files.fetch).collect()] == [("v", "u1")]
    for bad in ("..", ".", "a/b", " "):
        with pytest.raises(ValueError):
            folders.safe_parts("x", bad)
    for bad in ("/", "."):
        with pytest.raises(ValueError):
            folders.clean_output(spark, bad, folders.remove_local)


def test_videos_are_kept_probed_and_deleted(spark):
    asked = []

    def fetch(url):
        asked.append(url)
        return b"x" if url.endswith("b/") or url.endswith("c") else None

    once = adapters.Remembering(fetch)
    assert [once("u/b/"), once("u/b/"), once("u/d"), once("u/d")] == [b"x", b"x", None, None] and asked == ["u/b/", "u/d", "u/d"]
    assert adapters.folder_page(fetch, "u/b") == ("u/b/", b"x") and adapters.folder_page(fetch, "u/c/") == ("u/c", b"x") and adapters.folder_page(fetch, "u/d") is None
    files = adapters.MemoryFiles({"/v/a": b"1"})
    assert files.remove("/v/a") and not files.remove("/v/a")


def test_sample_is_saved_if_asked(spark, tmp_path):
    rows = [(f"http://h/{i}.png", f"{i}.png", "a", "E", "X", "s", "city", "Day", "Car", f"v{i}") for i in range(9)]
    inventory = spark.createDataFrame(rows, "url string, filename string, alias string, continent string, country string, state string, city string, day_night string, vehicle string, video_id string")
    assert save_sample(inventory, Settings(num_images=5, save_manifest=False), str(tmp_path / "no")).count() == 5 and not (tmp_path / "no").exists()
    got = save_sample(inventory, Settings(num_images=5), str(tmp_path / "yes"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, spark.read.option("header", True).csv(str(tmp_path / "yes")).collect()))


def test_numbered_over_partitions(spark):
    rows = spark.createDataFrame([(i,) for i in range(23)], "i int").repartition(5).sortWithinPartitions("i")
    got = numbered(rows).collect()
    assert [r.row_num for r in got] == list(range(2, 25))


def test_equal_rows_of_a_stream_stay_apart_and_headers_count(spark, tmp_path):
    line = 'E,G,s,l,"[va]","[[0]]","[[0]]","[[10]]","[[0]]"\n'
    head = "continent,country,state,locality,videos,time_of_day,start_time,end_time,vehicle_type\n"
    for name, text in (("a", head + line + line), ("b", head.replace("continent,country", "country,continent") + line)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "m.csv").write_text(text)
    write_frames(stream_mapping(spark, str(tmp_path / "a")), str(tmp_path / "out"), str(tmp_path / "ck"), "data", 10).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    with pytest.raises(Exception, match="header|CSV"):
        write_frames(stream_mapping(spark, str(tmp_path / "b")), str(tmp_path / "out2"), str(tmp_path / "ck2"), "data", 10).awaitTermination(120)


def test_stream_of_mapping_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.csv").write_text(CSV.lstrip("﻿"), encoding="utf-8")
    rows = stream_mapping(spark, str(tmp_path / "in"))
    write_frames(rows, str(tmp_path / "out"), str(tmp_path / "ck"), "data", 10).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12
    assert spark.read.parquet(str(tmp_path / "out")).select(F.min("t")).first()[0] == 0


def test_local_store_names_and_logs(tmp_path, caplog):
    store = adapters.LocalStore(str(tmp_path))
    store("a/b.png", b"1")
    store("a/b.png", b"2")
    assert (tmp_path / "a" / "b.png").read_bytes() == b"2" and [p.name for p in (tmp_path / "a").iterdir()] == ["b.png"]
    with pytest.raises(ValueError):
        store("../x.png", b"")
    logs.logger("fieldloom.test", "INFO", str(tmp_path / "log")).info("%s", "{braces} and 100%")
    assert "{braces} and 100%" in (tmp_path / "log").read_text()
    for bad in ("loud", 99):
        with pytest.raises(ValueError):
            logs.level_of(bad)


def test_reachable_at_any_depth(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(66)], "parent string, child string").coalesce(1)
    got = {r.node: r.depth for r in links.reachable(chain, spark.createDataFrame([("n0",)], "node string")).collect()}
    assert got == {f"n{i}": i for i in range(67)}


def test_first_pass_by_brute_force(spark):
    """The folders' counts choose as the whole inventory would."""
    frames = [(f"u/{c}/{v}/{i}", f"{i}", "a", "E", f"C{c % 3}", "s", f"c{c}", "Day" if v % 2 else "Night", "Car", f"v{v}") for c in range(9) for v in range(c % 4 + 1) for i in range(1 + (c * v) % 3)]
    inventory = spark.createDataFrame(frames, "url string, filename string, alias string, continent string, country string, state string, city string, day_night string, vehicle string, video_id string")
    draw = lambda *parts: hashlib.md5("|".join(("5", *parts)).encode()).hexdigest()
    city = lambda f: f[3:7]
    order = {tuple(r[:4]): r.city_order for r in sampling.country_round_robin(inventory, "5").collect()}
    walk = lambda f: (draw("day", *city(f), f[7]), draw("vehicle", *city(f), f[7], f[8]), draw("video", *f[3:10]), draw("image", f[0]), f[0])
    for target, per_folder in ((7, 1), (12, 2), (40, 1), (3, 2)):
        quota = max(1, -(-target // min(9, target)))
        want, taken = set(), 0
        for c in sorted(order, key=order.get):
            if taken >= target:
                break
            capped = []
            for folder in {f[3:10] for f in frames if city(f) == c}:
                capped += sorted((f for f in frames if f[3:10] == folder), key=lambda f: (draw("image", f[0]), f[0]))[:per_folder]
            picked = sorted(capped, key=walk)[:quota]
            want |= {f[0] for f in picked}
            taken += len(picked)
        every = sampling.folder_counts(inventory)
        got = sampling.first_pass(inventory, sampling.first_folders(every, 5000, "5"), sampling.country_round_robin(every, "5"), target, "5", per_folder)
        assert {r.url for r in got.collect()} == want
    few = sampling.first_folders(sampling.folder_counts(inventory), 2, "5").collect()
    assert max(Counter(r.city for r in few).values()) == 2
