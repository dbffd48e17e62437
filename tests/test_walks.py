from pyspark.sql import functions as F

from fieldloom.operators import links
from fieldloom.plans.lookup import video_sources, walked_files
from fieldloom.sources.settings import Settings

EDGES = "parent string, child string, label string"


def roots(spark):
    return links.alias_roots(spark, ["a1", "a2"], "http://h/")


def test_a_full_walk_leaves_the_next_one_its_pages(spark):
    """The first alias has more pages than the cap; the second's file is found all the same."""
    r1, r2 = "http://h/v/a1/browse", "http://h/v/a2/browse"
    rows = [(r1, f"{r1}/p{i:02}", None) for i in range(30)] + [(r2, f"{r2}/q", None), (f"{r2}/q", "http://h/v/a2/files/f.mp4", None), (f"{r1}/p29", "http://h/v/a1/files/g.mp4", None)]
    edges = spark.createDataFrame(rows, EDGES)
    got = links.walk(edges.where("child not like '%/files/%'"), roots(spark), 5).collect()
    assert sorted((r.rank, r.node) for r in got) == [(0, r1)] + [(0, f"{r1}/p{i:02}") for i in range(4)] + [(1, r2), (1, f"{r2}/q")]
    wanted = spark.createDataFrame([("F.mp4",), ("g.mp4",)], "name string")
    found = links.locate(walked_files(edges, roots(spark), Settings(crawl_pages=5)), wanted).collect()
    assert [(r.name, r.url) for r in found] == [("F.mp4", "http://h/v/a2/files/f.mp4")]


def test_the_first_alias_has_a_file_wherever_it_lies(spark):
    r1, r2 = "http://h/v/a1/browse", "http://h/v/a2/browse"
    rows = [(r1, f"{r1}/x", None), (f"{r1}/x", f"{r1}/x/y", None), (f"{r1}/x/y", "http://h/v/a1/files/x/f.mp4", None), (r2, "http://h/v/a2/files/f.mp4", None), (r2, "http://h/v/a2/files/z", " F.MP4\t")]
    edges = spark.createDataFrame(rows, EDGES)
    wanted = spark.createDataFrame([("f.mp4",)], "name string")
    assert [r.url for r in links.locate(walked_files(edges, roots(spark), Settings()), wanted).collect()] == ["http://h/v/a1/files/x/f.mp4"]
    tried = video_sources(edges, roots(spark), wanted, Settings(base_url="http://h/"), ["a1", "a2"]).orderBy("priority").collect()
    assert [(r.priority, r.url) for r in tried] == [(0, "http://h/v/a1/files/f.mp4"), (1, "http://h/v/a2/files/f.mp4"), (2, "http://h/v/a1/files/x/f.mp4"), (3, "http://h/v/a2/files/f.mp4")]


def test_shared_pages_belong_to_the_first(spark):
    """Cycles, pages of one alias that another links to, roots that are pages of others, walks by brute force."""
    rows = [(f"n{a}", f"n{b}") for a in range(24) for b in ((a * 7 + 3) % 24, (a * 5 + 1) % 29) if (a * b) % 5]
    edges = spark.createDataFrame(rows, "parent string, child string")
    starts = [("n1", 0), ("n9", 1), ("n2", 1), ("n1", 2), ("n20", 2), ("n28", 3)]
    for cap in (None, 1, 3, 6):
        visited = {}
        for rank in range(4):
            level, mine, depth = sorted({n for n, r in starts if r == rank} - set(visited)), {}, 0
            while level and (cap is None or len(mine) < cap):
                for n in level[: None if cap is None else cap - len(mine)]:
                    mine[n] = (rank, depth)
                level = sorted({b for a, b in rows if a in level and a in mine} - set(mine) - set(visited))
                depth += 1
            visited |= {n: v for n, v in mine.items() if n not in visited}
        got = links.walk(edges, spark.createDataFrame(starts, "node string, rank int"), cap).collect()
        assert {r.node: (r.rank, r.depth) for r in got} == visited and len(got) == len(visited)
    nothing = links.walk(edges, spark.createDataFrame([], "node string, rank int"))
    assert nothing.count() == 0 and nothing.columns == ["node", "rank", "depth"]
    assert links.reachable(edges, spark.createDataFrame([("n1",)], "node string")).where(F.col("depth") == 0).count() == 1
