"""What the larger tables showed: names tried in turn, stretches over batches, ranges trimmed."""

from pyspark.sql import functions as F

from fieldloom.functions import brackets
from fieldloom.operators.frames import fresh_ranges, frame_times
from fieldloom.sources import adapters, frames_out


def test_no_group_is_a_pandas_call_of_its_own(spark):
    tried = spark.createDataFrame([("a", 0, "x0"), ("a", 1, "ok1"), ("a", 2, "ok2"), ("b", 0, "x"), ("c", 1, "ok")], "name string, priority int, url string")
    had = adapters.first_available(tried, lambda url: b"v" if url.startswith("ok") else None)
    staged = frames_out.stage(spark.createDataFrame([("v", i, f"p/{i}") for i in range(30)], "video_path string, frame int, path string"), lambda path, frames: {f: b"f" for f in frames if f < 29}, lambda path, content: None)
    for frame in (had, staged):
        assert "FlatMapGroups" not in frame._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, had.collect())) == [("a", "ok1"), ("c", "ok")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = staged.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len({r["at"].split("/")[1] for r in rows if r["at"]}) == 1 and [r.path for r in rows if r["at"] is None] == ["p/29"]


def test_ranges_are_trimmed_and_their_times_told_once(spark):
    ranges = [("a", 0, 35), ("a", 10, 25), ("a", 5, 40), ("a", 20, 60), ("a", -30, -11), ("b", 7, 3), ("b", 3, 3)]
    rows = spark.createDataFrame(ranges, "k string, s long, e long")
    assert fresh_ranges(rows, ["k"], "s", "e", 10).count() == 5
    got = sorted(map(tuple, frame_times(rows, ["k"], "s", "e", 10).collect()))
    assert got == sorted({(k, t) for k, s, e in ranges for t in range(s, e + 1, 10)})
    assert "Aggregate" not in frame_times(rows, ["k"], "s", "e", 10)._jdf.queryExecution().executedPlan().toString()


def test_plain_cells_need_no_python(spark):
    cells = ["[[0,1],[],[abc]]", "[]", "[[]]", "[[a][b]]", "[[01]]", "[a,b]", "[[a,,b]]", "[[a],]", "[[1],[2]", None]
    rows = spark.createDataFrame([(c,) for c in cells], "c string").select("c", brackets.bracket_table(F.col("c")).alias("t"), brackets.bracket_list(F.col("c")).alias("l"), F.col("c").rlike(brackets._PLAIN_TABLE).alias("plain")).collect()
    assert [(r.t, r.l) for r in rows] == [(brackets.table_of(c), brackets._leaves(brackets.parse(c))) for c in cells]
    assert [r.c for r in rows if r.plain] == cells[:3]


def test_chains_are_deeper_than_the_nations(spark):
    from fieldloom.queries import QUERIES

    assert QUERIES["crawl_deep"](spark, "/root/testdata/sf0.001").agg(F.max("depth")).first()[0] == 70


def _inventory(spark, n=60):
    rows = [(f"u{i}", f"f{i}", "A" if i % 3 else "B", f"C{i % 4}", "s", f"city{i % 7}", "Day", "Car", f"v{i % 20}") for i in range(n)]
    return spark.createDataFrame(rows, "url string, filename string, continent string, country string, state string, city string, day_night string, vehicle string, video_id string")


def test_samples_neither_move_the_inventory_nor_number_it_in_one_task(spark):
    from fieldloom.operators import filters, sampling

    frames = _inventory(spark)
    folders = frames.groupBy(*sampling.FOLDER).agg(F.collect_list(F.struct("url", "filename")).alias("frames"))
    for most in (1, 2):
        listed = sampling.cap_listed(folders, most, "7")
        assert "Window" not in listed._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.url for r in listed.collect()) == sorted(r.url for r in sampling.cap_per_folder(frames, most, "7").collect())
    orders = sampling.country_round_robin(frames, "7")
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition, ENSURE" not in plan.split("HashAggregate")[0] and sorted(r.city_order for r in orders.collect()) == list(range(1, orders.count() + 1))
    told = filters.matching(frames, filters.location_filters(spark, {"A": {"C1": "all"}, "B": "all"}))
    assert "Exchange hashpartitioning(continent" not in told._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.url for r in told.collect()) == sorted(r.url for r in frames.where("continent = 'B' or country = 'C1'").collect())


def test_pages_stay_where_they_are_and_are_looked_up_once(spark, monkeypatch):
    import re

    from fieldloom.operators.links import fetched
    from fieldloom.plans import browse

    rows = [("h://a/b", "1", 4), ("h://a/b/", "2", 4), ("h://a/c", "3", 4), ("h://a/d/", "4", 4), ("h://a/e/", None, 4), ("h://a/e", "5", 4), ("h://a/f//", "6", 4), ("h://g", "7", 3)]
    pages = spark.createDataFrame(rows, "url string, html string, depth int")
    wanted = spark.createDataFrame([(u,) for u in ("h://a/b", "h://a/c/", "h://a/d", "h://a/e//", "h://a/f", "h://a/no")], "url string")
    joins = lambda frame: re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join (.*)", frame._jdf.queryExecution().executedPlan().toString())
    assert len(joins(fetched(wanted, pages))) == 1
    moved = browse.stored_pages(pages)(wanted)
    assert any("LeftSemi" in j for j in joins(moved))
    for most in (browse.MOST_HASHES, 0):
        monkeypatch.setattr(browse, "MOST_HASHES", most)
        for table in (pages, pages.drop("depth")):
            assert sorted(map(tuple, browse.stored_pages(table)(wanted).collect())) == [("h://a/b/", "2"), ("h://a/c", "3"), ("h://a/d/", "4"), ("h://a/e", "5")]


def test_more_items_are_dealt_to_more_tasks(spark, monkeypatch):
    import re

    from fieldloom import fixtures
    from fieldloom.queries import QUERIES

    sf, names = "/root/testdata/sf0.001", ("frame_plan_by_location", "missing_vehicle_report", "image_links", "file_names_from_url", "random_topk_md5", "collision_suffix", "free_names", "frame_times_dedup")
    rows = lambda name: sorted(map(tuple, QUERIES[name](spark, sf).collect()))
    few = {name: rows(name) for name in names}
    monkeypatch.setattr(fixtures, "ITEMS", 500)
    n = -(-fixtures.table(spark, sf, "lineitem").count() // 500)
    plan = lambda name: QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for name in names:
        assert rows(name) == few[name]
        dealt = re.findall(r"Exchange hashpartitioning\(l_orderkey#\d+L?, (\d+)\)", plan(name))
        assert dealt and set(dealt) == {str(n)}
    assert f", {2 * n})" in plan("collision_suffix") and f", {2 * n})" in plan("free_names")


def test_a_run_moves_and_stores_folders_not_frames(spark, tmp_path):
    from fieldloom.plans.run import Outside, Sources, run_extraction
    from fieldloom.sources.settings import Settings

    kinds = "row_num long, continent string, country string, state string, locality string, videos string, time_of_day string, start_time string, end_time string, vehicle_type string"
    rows = [(2, "Asia", "India", "DL", "Agra", "[long,torn,short]", "[[0],[0],[0,1]]", "[[0],[0],[0,5]]", "[[60000],[60000],[20,30]]", "[[0],[0],[0]]")]
    files = spark.createDataFrame([(f"/v/{n}.mp4", f"{n}.mp4") for n in ("long", "torn", "short")], "path string, file_name string")

    def decode(path, frames):
        for f in frames:
            if "torn" in path and f > 1_000_000:
                raise OSError("torn")
            yield f, b"f"

    outside = Outside(lambda url: None, decode, lambda path: (640, 480, 25.0), lambda path, content: None, lambda source, path: not path.endswith("_5.png"), lambda path: True)
    run = run_extraction(spark.createDataFrame(rows, kinds), spark.createDataFrame([], "path string"), files, Settings(), outside, Sources(["a1"]), store=str(tmp_path / "s"))
    assert sorted(map(tuple, run.groups.select("video_key", "day_night", "planned", "new").collect())) == [("long", "Day", 6001, 6001), ("short", "Day", 3, 3), ("short", "Night", 3, 2), ("torn", "Day", 6001, 0)]
    # 12,008 frames: four folders, of long ones a part for each of 16 stretches
    table = lambda name: spark.read.parquet(str(tmp_path / "s" / name))
    assert [table(n).count() for n in ("todo", "wave-0-staged", "wave-0-promoted")] == [4, 34, 18]
    # what is not in its place goes: of the torn video what had been put, of the other what could not be moved
    gone = {r.folder.rsplit("/", 1)[1]: r.n for r in table("wave-0-left").groupBy("folder").agg(F.sum("n").alias("n")).collect()}
    assert gone == {"torn": table("wave-0-staged").where("folder like '%torn'").agg(F.sum(F.col("planned") - F.col("missing"))).first()[0], "short": 3}


def test_folders_have_the_frames_of_their_ranges(spark):
    from fieldloom.operators import frames, segments

    cells = [("[0,1]", "[0,30,5]", "[20,10,45]", "[2]"), ("[0]", "[-30,0,7]", "[15,40,7]", "[]"), ("", "[a,10,10,10]", "[5,20,x,90]", "[0,14]"), ("[1,1,0]", "[50,0,25,5]", "[90,60,35]", "[3]"), ("[dusk]", "[]", "[]", "[0]")]
    rows = [(i + 2, "As/ia", "India", "", "Agra", f"[{'v' if i % 2 else 'x_1.mp4'}]", f"[{d}]", f"[{s}]", f"[{e}]", f"[{v}]") for i, (d, s, e, v) in enumerate(cells)]
    videos = segments.videos_of(spark.createDataFrame(rows, "row_num long, continent string, country string, state string, locality string, videos string, time_of_day string, start_time string, end_time string, vehicle_type string"))
    group, folders = ["row_num", "pos", "day_night", "vehicle"], segments.mapping_folders(videos, "data", 10, False)
    plain, told = segments.mapping_frames(segments.ranges_of(videos, False), "data", 10), segments.folder_frames(folders, 10)
    rows_of = lambda frame: sorted(map(tuple, frame.collect()))
    assert told.columns == plain.columns and rows_of(told) == rows_of(plain) and told.count() > 20
    assert "Exchange" not in folders._jdf.queryExecution().executedPlan().toString()
    odd = spark.createDataFrame([("data/x_0.png",), ("x.png",), ("",), (None,), ("data/v/v_00.png",)], "path string")
    there = plain.where("t % 3 > 0").select("path").unionByName(plain.where("t % 4 = 0").select("path")).unionByName(plain.select(F.concat("path", F.lit("\n"))).toDF("path")).unionByName(odd)
    counted = frames.counted_folders(folders, there, 10)
    assert rows_of(counted.select(*group, "total", "existing")) == rows_of(frames.existing_counts(plain, there, group, ["path"]).select(*group, "total", "existing"))
    assert rows_of(segments.folder_frames(frames.pending(counted), 10)) == rows_of(frames.pending_frames(plain, there, group, ["path"]))
