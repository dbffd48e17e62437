import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldloom.llm import fim


def depth_holds(rope):
    if rope.left is None:
        return rope.height == 0
    return abs(rope.left.height - rope.right.height) <= 1 and rope.height == 1 + max(rope.left.height, rope.right.height) and depth_holds(rope.left) and depth_holds(rope.right)


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 400)), max_size=30), st.randoms(use_true_random=False))
@settings(max_examples=60, deadline=None)
def test_ropes_split_and_join(sizes, draw):
    """Any order of joins and splits gives the texts that slices give, in balanced trees."""
    small = fim.Units()
    text, rope = "", fim.Rope()
    for k, n in sizes:
        more = "".join(draw.choices("aé日😀\n", k=n))
        text, rope = (text + more, fim.join(rope, small.rope(more))) if k % 2 else (more + text, fim.join(small.rope(more), rope))
        assert depth_holds(rope) and rope.units == rope.chars == len(text)
        at = draw.randint(-1, len(text) + 1)
        a, b = small.split(rope, at)
        at = min(max(at, 0), len(text))
        assert (str(a), str(b)) == (text[:at], text[at:]) and depth_holds(a) and depth_holds(b)
        text, rope = text[at:] + text[:at], fim.join(b, a)
    assert str(rope) == text


def test_large_ropes_are_cut_anywhere():
    draw = random.Random(1)
    text = "".join(draw.choices("ab😀é \n", k=5 * fim.LEAF + 17))
    for units in (fim.Units(), fim.Units(r"\S+"), fim.Units(r"[^\n]*\n")):
        starts = list(range(len(text))) if units.find is None else units.starts(text)
        rope = units.rope(text)
        assert depth_holds(rope) and rope.units == len(starts) and str(rope) == text
        for rank in (0, 1, len(starts) // 2, len(starts) - 1, len(starts), *(draw.randrange(len(starts)) for _ in range(20))):
            a, b = units.split(rope, rank)
            at = starts[rank] if rank < len(starts) else len(text)
            assert (str(a), str(b), a.units, a.chars) == (text[:at], text[at:], rank, at)


def brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:i], text[i:j], text[j:]
    if h4 % 100 < 20:
        return n, "spm", i, j - i, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", i, j - i, f"<P>{p}<S>{s}<M>{m}"


TEXTS = ["", None, "x", "é日😀", "a <S> b", "<P", "<<>S>M>", "ab\n" * 9000, "😀" * 7000, "<P<S<M" * 3]


def test_documents_by_brute_force(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], "mine", 7) for i in range(150)] + [(None, "abc", "mine", 7)] * 2 + [(3, "é日😀", "mine", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, __fim_key int")
    got = fim.transform(docs, restored="back").collect()
    assert sorted((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got if r.doc_id is not None and r.text is not None) == sorted((d, t, *brute(d, t)) for d, t, *_ in rows if d is not None and t is not None)
    assert all(r.back == (r.text or "") and r["__fim_key"] == 7 for r in got) and len(got) == len(rows)
    assert {r.output for r in got if r.doc_id is None} == {brute(None, "abc")[4]}
    assert {"plain", "psm", "spm"} == {r.form for r in got}
    again = fim.restore_texts(fim.transform(docs).select("text", "output", "form")).collect()
    assert all(r.restored == (r.text or "") for r in again)
    assert fim.transform(docs.limit(0)).count() == 0


def test_other_units_and_sentinels(spark):
    docs = spark.createDataFrame([(i, "one two\nthree  four five\n" * (i % 5)) for i in range(60)], "doc_id long, text string")
    marks = ("<|pre|>", "<|suf|>", "<|mid|>")
    for pattern in (r"\S+", r"[^\n]*\n"):
        got = fim.transform(docs, units=pattern, sentinels=marks, seed="9").collect()
        for r in got:
            assert fim.restore(r.output, r.form, marks) == r.text
            starts = fim.Units(pattern).starts(r.text)
            assert r.n == len(starts)
            if r.form != "plain":
                assert {r.prefix_chars, r.prefix_chars + r.middle_chars} <= {*starts, len(r.text)}
    for bad in (("<P>", "<P>x", "<M>"), ("ab", "bc", "<M>"), ("", "<S>", "<M>"), ("aba", "x", "y")):
        with pytest.raises(ValueError):
            fim.transform(docs, sentinels=bad)
