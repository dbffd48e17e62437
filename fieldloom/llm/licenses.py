"""License scans by ordered signature rules.

Some 300 patterns (`license_rules`) stand for licenses' names, notices, identifiers and characteristic sentences. A keyword prefilter gates them: a slice of
texts is searched once for each first keyword, and a text is only matched against rules of which it holds all keywords. Matches are
detections: intervals of words with a rule. They are resolved by priority: of equal intervals the rule of the higher priority stays, then the one that stands first; a
detection within another of the same or a higher priority goes; then one that overlaps with what stays of a higher priority goes too.
Detections of base rules are places to be counted; nothing suppresses them, and they suppress nothing.

Texts are read as words: A-Z in lower case, everything in ASCII but letters and digits parts words. Matches begin and end with words.

Defined cases: null counts as empty and has no detections; its score is 0. Texts of any length are scanned whole. Equal rows give equal
results; ties between rules go as above, so results do not depend on how rows are dealt. Columns named as a new one are replaced, others
may have any name. An empty table stays empty.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable
from functools import cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import license_rules
from .common import PLAIN, with_columns

#: A detection: words first (from 0) to last, and whether it stays.
FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("label", T.StringType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("sure", T.DoubleType()), T.StructField("stays", T.BooleanType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("sure", pa.float64()), ("stays", pa.bool_())]))


class Rule(NamedTuple):
    kind: str
    label: str
    keywords: tuple[str, ...]
    pattern: str


def read_rules(lines: str) -> list[Rule]:
    """Rules as `license_rules` writes them."""
    rules = []
    for line in filter(None, map(str.strip, lines.splitlines())):
        head, pattern = line.split(" : ", 1)
        kind, label, keywords = head.split(" ", 2)
        words = tuple(k.replace("_", " ") for k in keywords.split(","))
        if kind not in license_rules.KINDS or " " in words[0].strip():
            raise ValueError(f"not a rule: {line}")
        rules.append(Rule(kind, label, words, pattern))
    return rules


RULES = tuple(r for text in license_rules.TEXT for r in read_rules(text))


class Detection(NamedTuple):
    rule: int
    first: int
    end: int  # after the last word


def resolve(detections: list[Detection], rules: tuple[Rule, ...]) -> set[Detection]:
    """Those that stay."""
    kinds = license_rules.KINDS
    order = sorted((d for d in detections if rules[d.rule].kind != "base"), key=lambda d: (-kinds[rules[d.rule].kind][0], d.first, -d.end, d.rule))
    stay: set[Detection] = set()
    above: list[tuple[int, int]] = []  # intervals of higher priorities, by start
    kept: list[tuple[int, int]] = []  # what stays of them, without overlaps
    at = 0
    while at < len(order):
        level = kinds[rules[order[at].rule].kind][0]
        mine = [d for d in order[at:] if kinds[rules[d.rule].kind][0] == level]
        at += len(mine)
        starts, reach = [a for a, _ in above], list(accumulate((b for _, b in above), max))
        kept_starts = [a for a, _ in kept]
        far, left = -1, []
        for d in mine:  # by start, longer ones first: within another if one before it reaches as far
            i = bisect_right(starts, d.first)
            inside = d.end <= far or (i and reach[i - 1] >= d.end)
            far = max(far, d.end)
            j = bisect_right(kept_starts, d.end - 1)
            if not inside and not (j and kept[j - 1][1] > d.first):
                left.append(d)
        stay.update(left)
        above = sorted([*above, *((d.first, d.end) for d in mine)])
        kept = _union([*kept, *((d.first, d.end) for d in left)])
    return stay


def _union(intervals: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(intervals):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


class Scanner:
    """Rules ready to be matched, and the prefilter before them."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        self.patterns = [re.compile(f" (?:{r.pattern})(?= )".encode()) for r in rules]
        self.later = [[k.encode() for k in r.keywords[1:]] for r in rules]
        self.gates: dict[bytes, list[int]] = {}
        for i, r in enumerate(rules):
            self.gates.setdefault(r.keywords[0].encode(), []).append(i)

    def gated(self, big: bytes, begins: np.ndarray) -> dict[int, list[int]]:
        """Of each text the rules whose first keyword it holds; texts begin after one space."""
        found: dict[int, list[int]] = {}
        for gate, rules in self.gates.items():
            at = big.find(gate)
            while at >= 0:
                t = int(np.searchsorted(begins, at + 1, "right")) - 1  # a keyword may begin with the space before the text
                found.setdefault(t, []).extend(rules)
                at = big.find(gate, int(begins[t + 1]) - 1) if t + 1 < len(begins) else -1
        return found

    def match(self, words: bytes, rules: Iterable[int]) -> list[Detection]:
        """All detections in a text of words with one space before, between and behind them."""
        out: list[Detection] = []
        spaces = None
        for r in sorted(rules):
            if all(k in words for k in self.later[r]):
                for m in self.patterns[r].finditer(words):
                    if spaces is None:
                        spaces = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
                    first, end = np.searchsorted(spaces, m.span())
                    out.append(Detection(r, int(first), int(end)))
        return out

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[dict]]]:
        """Number of words and detections of each text."""
        plain = [t.translate(PLAIN) for t in texts]
        big = b" ".join([b"", *plain, b""])
        begins = np.cumsum([1, *(len(t) + 1 for t in plain)])[:-1]
        is_space = np.frombuffer(big, np.uint8) == 32
        word_begins = np.flatnonzero(is_space[:-1] & ~is_space[1:]) + 1
        n_words = np.diff(np.searchsorted(word_begins, np.append(begins, len(big))))
        found: list[list[dict]] = [[] for _ in texts]
        for t, rules in self.gated(big, begins).items():
            detections = self.match(b" ".join([b"", *plain[t].split(), b""]), rules)
            stay = resolve(detections, self.rules)
            for d in sorted(detections, key=lambda d: (d.first, d.end, d.rule)):
                r = self.rules[d.rule]
                found[t].append({"kind": r.kind, "label": r.label, "first": d.first, "last": d.end - 1, "sure": license_rules.KINDS[r.kind][1], "stays": r.kind == "base" or d in stay})
        return n_words, found


@cache
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def scan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, keep: list[str] | None = None) -> DataFrame:
    """Adds n_words and found, all detections with those that are suppressed, by place."""

    def make():
        ready = scanner(rules)

        def each(part: pa.RecordBatch) -> dict[str, pa.Array]:
            n_words, found = ready.scan([t or b"" for t in part.column(text).cast(pa.binary()).to_pylist()])
            return {"n_words": pa.array(n_words, pa.int64()), "found": pa.array(found, _ARROW)}

        return each

    return with_columns(docs, text, [("n_words", T.LongType()), ("found", FOUND)], make, keep, holds=("licenses", scanner.cache_clear))


def base_places() -> Column:
    """The first words of all base detections."""
    return F.transform(F.filter("found", lambda d: d["kind"] == "base"), lambda d: d["first"])


def labels(only_base: bool = False) -> Column:
    """The distinct labels of detections that stay, sorted."""
    mine = F.filter("found", (lambda d: d["kind"] == "base") if only_base else (lambda d: d["stays"]))
    return F.array_sort(F.array_distinct(F.transform(mine, lambda d: d["label"])))


def score() -> Column:
    """How sure the surest detection is that stays; 0 without any."""
    return F.coalesce(F.array_max(F.transform(F.filter("found", lambda d: d["stays"]), lambda d: d["sure"])), F.lit(0.0))
