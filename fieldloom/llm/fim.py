"""Fill-in-the-middle: a text's prefix, middle and suffix, marked and put in another order, on ropes.

A rope is a balanced tree over leaves of text. Every node knows how many units and how many code points lie below it, so a text is split at two unit
ranks along two paths from the root, and the parts are joined again in their new order with sentinels between them; no leaf but the two that are cut
is touched. The way back splits the output's rope at the sentinels' places.

Units are code points, or what a pattern tells: each match and what follows it up to the next is one, the first with what precedes it.

The ranks, whether a text stays plain, and the order follow from the id alone: h1 to h4 are the first four groups of 8 digits of the hex
sha256 of `seed:id`. The prefix ends after the smaller of h1 mod (n + 1) and h2 mod (n + 1) units, the middle after the larger.

Defined cases: null counts as empty; an empty text, or one that holds a sentinel, stays plain. A text of any length is transformed whole.
A null id counts as an empty one; equal rows give equal results. Columns named as a new one are replaced, others may have any name. An empty
table stays empty.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import with_columns

P, S, M = SENTINELS = ("<P>", "<S>", "<M>")
PLAIN_FORM, PSM, SPM = "plain", "psm", "spm"
#: Of 100 texts so many are transformed; of 100 transformed ones so many have their suffix first.
RATE, SUFFIX_FIRST = 90, 20
#: Code points of a leaf that holds code points as units; units of one that holds others.
LEAF, LEAF_UNITS = 2048, 256


class Rope:
    """A leaf with its text, or a node with two ropes below it. Ropes are never changed."""

    __slots__ = ("left", "right", "text", "units", "chars", "height")

    def __init__(self, text: str = "", units: int = 0, left: Rope | None = None, right: Rope | None = None) -> None:
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.units, self.chars, self.height = units, len(text), 0
        else:
            self.units, self.chars, self.height = left.units + right.units, left.chars + right.chars, 1 + max(left.height, right.height)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            at = todo.pop()
            if at.left is None:
                out.append(at.text)
            else:
                todo += (at.right, at.left)
        return "".join(out)


def join(a: Rope, b: Rope) -> Rope:
    """Both, one after the other, in a tree whose sides differ by one level at most. Goes down only as far as their heights differ."""
    if not a.chars:
        return b
    if not b.chars:
        return a
    if a.height > b.height + 1:
        return _level(a.left, join(a.right, b))
    if b.height > a.height + 1:
        return _level(join(a, b.left), b.right)
    return Rope(left=a, right=b)


def _level(a: Rope, b: Rope) -> Rope:
    """A node over two ropes of which one may be two levels higher."""
    if a.height > b.height + 1:
        if a.left.height >= a.right.height:
            return Rope(left=a.left, right=Rope(left=a.right, right=b))
        return Rope(left=Rope(left=a.left, right=a.right.left), right=Rope(left=a.right.right, right=b))
    if b.height > a.height + 1:
        if b.right.height >= b.left.height:
            return Rope(left=Rope(left=a, right=b.left), right=b.right)
        return Rope(left=Rope(left=a, right=b.left.left), right=Rope(left=b.left.right, right=b.right))
    return Rope(left=a, right=b)


class Units:
    """How texts are cut into units: code points, or by a pattern."""

    def __init__(self, pattern: str | None = None) -> None:
        self.find = re.compile(pattern).finditer if pattern else None

    def starts(self, text: str) -> list[int]:
        """Where units begin."""
        found = [m.start() for m in self.find(text)] or ([0] if text else [])
        return [0, *found[1:]] if found else []

    def rope(self, text: str) -> Rope:
        if self.find is None:
            leaves = [Rope(t, len(t)) for t in (text[i : i + LEAF] for i in range(0, len(text), LEAF))]
        else:
            starts = self.starts(text)
            cuts = [*starts[::LEAF_UNITS], len(text)]
            leaves = [Rope(text[a:b], min(LEAF_UNITS, len(starts) - i * LEAF_UNITS)) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        while len(leaves) > 1:  # pairs of neighbours, level by level
            odd = leaves[len(leaves) & ~1 :]
            leaves = [Rope(left=a, right=b) for a, b in zip(leaves[::2], leaves[1::2])]
            if odd:
                leaves[-1:] = [join(leaves[-1], odd[0])]
        return leaves[0] if leaves else Rope()

    def split(self, rope: Rope, rank: int) -> tuple[Rope, Rope]:
        """What lies before the unit of this rank, and the rest."""
        if rank <= 0:
            return Rope(), rope
        if rank >= rope.units:
            return rope, Rope()
        if rope.left is None:
            at = rank if self.find is None else self.starts(rope.text)[rank]
            return Rope(rope.text[:at], rank), Rope(rope.text[at:], rope.units - rank)
        if rank < rope.left.units:
            a, b = self.split(rope.left, rank)
            return a, join(b, rope.right)
        a, b = self.split(rope.right, rank - rope.left.units)
        return join(rope.left, a), b


CODE_POINTS = Units()


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """They must be told apart wherever they stand: none is part of another, and none ends as one begins."""
    for a in sentinels:
        for b in sentinels:
            if not a or (a is not b and a in b) or any(a.endswith(b[:k]) for k in range(1, len(b))):
                raise ValueError(f"sentinels overlap: {a!r}, {b!r}")


def draws(key: str) -> tuple[int, int, int, int]:
    h = hashlib.sha256(key.encode()).hexdigest()
    return tuple(int(h[8 * i : 8 * i + 8], 16) for i in range(4))


def rearrange(text: str, key: str, units: Units = CODE_POINTS, sentinels: tuple[str, str, str] = SENTINELS) -> tuple[Rope, int, str, int | None, int | None]:
    """The output as a rope, the number of units, the form, and the code points of prefix and middle (None if plain)."""
    whole = units.rope(text)
    n = whole.units
    h1, h2, h3, h4 = draws(key)
    if not text or h3 % 100 >= RATE or any(s in text for s in sentinels):
        return whole, n, PLAIN_FORM, None, None
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    head, suffix = units.split(whole, j)
    prefix, middle = units.split(head, i)
    p, s, m = (Rope(x, 0) for x in sentinels)
    form, parts = (SPM, (s, suffix, p, prefix, m, middle)) if h4 % 100 < SUFFIX_FIRST else (PSM, (p, prefix, s, suffix, m, middle))
    out = Rope()
    for part in parts:
        out = join(out, part)
    return out, n, form, prefix.chars, middle.chars


def restore(output: str, form: str, sentinels: tuple[str, str, str] = SENTINELS) -> str:
    """The text that an output was made of: its rope is split before and after each sentinel."""
    if form == PLAIN_FORM:
        return output
    p, s, m = sentinels
    order = (s, p, m) if form == SPM else (p, s, m)
    rope, pieces = CODE_POINTS.rope(output), {}
    for name in reversed(order):
        rope, tail = CODE_POINTS.split(rope, output.rindex(name, 0, rope.chars))
        pieces[name] = CODE_POINTS.split(tail, len(name))[1]
    return str(join(join(pieces[p], pieces[m]), pieces[s]))


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = "1", units: str | None = None, sentinels: tuple[str, str, str] = SENTINELS, keep: list[str] | None = None, restored: str | None = None) -> DataFrame:
    """Adds n, form, prefix_chars, middle_chars and output; with `restored`, also the text made of the output again, under this name."""
    check_sentinels(sentinels)
    fields = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.StringType())]
    fields += [(restored, T.StringType())] if restored else []
    key = "__fim_key"
    while key in docs.columns:
        key += "_"
    kept = [c for c in (docs.columns if keep is None else keep) if c not in {n for n, _ in fields}]

    def make():
        cut_by = Units(units)

        def each(part: pa.RecordBatch) -> dict[str, pa.Array]:
            made = [rearrange(t or "", k, cut_by, sentinels) for t, k in zip(part.column(text).to_pylist(), part.column(key).to_pylist())]
            outputs = [str(r[0]) for r in made]
            columns = {name: pa.array([r[i] for r in made], kind) for i, name, kind in ((1, "n", pa.int64()), (2, "form", pa.string()), (3, "prefix_chars", pa.int64()), (4, "middle_chars", pa.int64()))}
            columns["output"] = pa.array(outputs, pa.string())
            if restored:
                columns[restored] = pa.array([restore(o, r[2], sentinels) for o, r in zip(outputs, made)], pa.string())
            return columns

        return each

    keyed = docs.withColumn(key, F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    return with_columns(keyed, text, fields, make, keep=[*kept, key]).drop(key)


def restore_texts(rows: DataFrame, output: str = "output", form: str = "form", out: str = "restored", sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Adds the text that each output was made of."""

    def make():
        return lambda part: {out: pa.array([None if o is None else restore(o, f or PLAIN_FORM, sentinels) for o, f in zip(part.column(output).to_pylist(), part.column(form).to_pylist())], pa.string())}

    return with_columns(rows, output, [(out, T.StringType())], make)
