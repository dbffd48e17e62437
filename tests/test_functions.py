import string
import unicodedata
import urllib.parse
from os.path import splitext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.functions import brackets, countries, lists, text, urls


def values(spark, rows, column, schema="v string"):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[1] for r in frame.select("i", column.alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("cell", "value"),
    [
        (None, []), ("", []), ("  ", []), ("abc", "abc"), ("[]", []), ("[a,b]", ["a", "b"]), ("[[0],[1,2]]", [["0"], ["1", "2"]]), ("[0, 1.5, -3]", ["0", "1.5", "-3"]),
        ("[a,,b]", ["a", "", "b"]), ("[a,]", ["a"]), ("[,a]", ["", "a"]), ("[a", ["a"]), ("[a] tail", ["a"]), ("a,b", "a"), ("['x',\"y\"]", ["x", "y"]), ("['a,b']", ["'a", "b'"]),
        ("['12']", ["12"]), ("[007]", ["7"]), ("[1e3,+5,.5,5.]", ["1e3", "+5", ".5", "5."]), ("[[a] b]", [["a"], "b"]), ("[[]]", [[]]), ("['']", [""]), ("[1.50]", ["1.5"]),
    ],
)
def test_brackets(cell, value):
    assert brackets.parse(cell) == value


def test_bracket_columns(spark):
    cells = ["[[0],[1,2]]", "[a,[b,[c]]]", "x", None, "[[1],]", "[[1]]"]
    assert values(spark, cells, brackets.bracket_table(F.col("v"))) == [[["0"], ["1", "2"]], [["a"], ["b", "c"]], [["x"]], [], [["1"]], [["1"]]]
    assert values(spark, cells, brackets.bracket_list(F.col("v"))) == [["0", "1", "2"], ["a", "b", "c"], ["x"], [], ["1"], ["1"]]
    assert values(spark, cells, brackets.well_formed_table(F.col("v"))) == [[["0"], ["1", "2"]], None, None, None, None, [["1"]]]


def python_clean(v, missing):
    import re

    if v is None or v.strip() in missing:
        return "unknown"
    return re.sub(r"\s+", " ", re.sub(r'[<>:"/\\|?*]+', "_", v.strip())).strip() or "unknown"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(' \t\n\x1c\x85\xa0 　<>:"/\\|?*ab'), st.characters(codec="utf-8", exclude_characters="\x00")), max_size=12), min_size=1, max_size=40))
def test_clean_name(spark, rows):
    rows = [*rows, None, "", "[]", " nan ", "a / b", "{}"]
    assert values(spark, rows, text.clean_name(F.col("v"))) == [python_clean(v, text.MISSING_NAME) for v in rows]
    assert values(spark, rows, text.clean_name(F.col("v"), text.MISSING_FILTER_NAME)) == [python_clean(v, text.MISSING_FILTER_NAME) for v in rows]


def test_labels(spark):
    rows = ["0", "0.9", "-0.5", "2", "dusk", None, "nan", "", "1d", "1_0", "inf", "1e0"]
    assert values(spark, rows, text.time_label(F.col("v"))) == ["Day", "Day", "Day", "Unknown_2", "dusk", "Unknown", "unknown", "Unknown", "1d", "Unknown_10", "inf", "Night"]
    assert values(spark, ["13", "14", "2"], text.vehicle_label(F.col("v"))) == ["Pedestrian", "Unknown_14", "Truck"]
    assert values(spark, [["0", "2"], [], None, ["1"]], text.vehicle_list_label(F.col("v")), "v array<string>") == ["Car__Truck", "Unknown", "Unknown", "Bus"]
    assert values(spark, ["daytime", "1", "2", "ALL", "x:y"], text.day_filter(F.col("v"))) == ["Day", "Night", "2", None, "x_y"]
    assert values(spark, ["cAR", "1.9", None], text.vehicle_filter(F.col("v"))) == ["Car", "Bus", None]
    assert values(spark, ["a/b.c.mp4", "all", ".x"], text.video_filter(F.col("v"))) == ["a_b.c", None, ".x"]
    assert values(spark, ["Straße", "A B"], text.match_key(F.col("v"))) == ["strasse", "a b"]


def test_paths(spark):
    rows = ["a.b", "a", ".a", "..a.b", "x/.b", "x.y/z", "a.tar.gz", "a.", "x/..c.d", "", "/", "a/b.c/d.e"]
    assert values(spark, rows, text.stem(F.col("v"))) == [splitext(r)[0] for r in rows]
    assert values(spark, [" A.MP4 ", None, " ", "a.b.mp4"], text.video_key(F.col("v"))) == ["a", "", "", "a.b"]
    assert values(spark, [0.5, 1.5, 2.5, 2.4], text.frame_index(F.col("v"), F.lit(1.0)), "v double") == [0, 2, 2, 2]


def test_urls(spark):
    rows = [string.printable.replace("\x00", ""), "ä ö/~*+", "x"]
    assert values(spark, rows, urls.quote(F.col("v"))) == [urllib.parse.quote(r, safe="") for r in rows]
    coded = ["a+b%20c", "%zz", "100%", "%C3%BC", "x%zz%20"]
    assert values(spark, coded, urls.unquote(F.col("v"))) == [urllib.parse.unquote(r) for r in coded]
    page = "http://h/v/a/browse/x/"
    rows = ["/v/a", "y", "http://o/z", "//o/z", "?q", "#f", "./y"]
    rows += ["../y", "../../../../../z", "a/./b/../c", "..", ".", "../x/?q=../a", ""]
    assert values(spark, rows, urls.join(F.lit(page), F.col("v"))) == [urllib.parse.urljoin(page, r) for r in rows]
    assert values(spark, ["http://h/a%2Fb.PNG?x", "/x.txt", "/y.webp#z"], urls.is_image(F.col("v"))) == [True, False, True]
    assert values(spark, ["  ", "Name", None], urls.anchor_name(F.col("v"), F.lit("/a/b%20c/"))) == ["b c", "Name", "b c"]


def test_lists(spark):
    f = F.array_join(F.transform(lists.align(F.col("v"), F.lit(3)), lambda x: F.coalesce(x, F.lit("N"))), ",")
    assert values(spark, [[], ["4"], ["1", "2", "3"], ["1", "2", "3", "9"], ["1", "2"]], f, "v array<string>") == ["N,N,N", "4,4,4", "1,2,3", "1,2,3", "1,2,2"]
    assert values(spark, [["1"]], F.size(lists.align(F.col("v"), F.lit(0))), "v array<string>") == [0]
    assert values(spark, ["Day, Night", "[]", " ", "x"], lists.as_filter_list(F.col("v"))) == [["Day", "Night"], [], [], ["x"]]
    assert values(spark, [["Car", "all"], ["unknown"], ["cAR", "0", "Bus"]], lists.wanted(F.col("v"), text.vehicle_filter), "v array<string>") == [[], [], ["Car", "Bus"]]
    with pytest.raises(Exception, match="not a time"):
        values(spark, [["abc"]], lists.seconds(F.col("v")), "v array<string>")
    assert values(spark, [["1.9", "", None, "x"]], lists.seconds(F.col("v"), strict=False), "v array<string>") == [[1, None]]
    assert values(spark, [5], lists.times_of(F.col("v"), F.lit(4).cast("bigint"), 10), "v bigint") == [[]]


def test_countries(spark):
    assert values(spark, ["Russia", "Kosovo", "x"], countries.correct_country(F.col("v"))) == ["Russian Federation", "Kosovo", "x"]


def test_folded_letters(spark):
    letters = [c for c in map(chr, range(32, 0x2000)) if c.isalpha() and not 0x13A0 <= ord(c) < 0x1400]  # not Cherokee
    got = values(spark, letters, text.folded(F.col("v")))
    assert [c for c, g in zip(letters, got) if unicodedata.normalize("NFC", g) != unicodedata.normalize("NFC", c.casefold())] == []


def test_names_of_nothing(spark):
    from pyspark.sql import functions as F

    from fieldloom.functions import text, urls

    rows = [(None, None, "/a/x%zzy"), ("{}", "a/b.c.mp4", "http://h/v/"), (" ", " x.MP4 ", "http://h/a/b%20c/")]
    got = spark.createDataFrame(rows, "v string, w string, u string").select(text.match_key(F.col("v")).alias("k"), text.video_filter(F.col("w")).alias("f"), urls.anchor_name(F.lit(None).cast("string"), F.col("u")).alias("a")).collect()
    assert [tuple(r) for r in got] == [("unknown", None, "x%zzy"), ("unknown", "a_b.c", "v"), ("unknown", "x", "b c")]
