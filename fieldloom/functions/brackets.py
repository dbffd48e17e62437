"""Reader of bracketed cells such as `[[0],[1,2]]`.

It forgives much: lists may stay open, text after the outer list is ignored, items may lack a comma after an inner list. Leaves keep
one text for each value: whole and decimal numbers in their shortest form, other tokens as they are without their quotes.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SCALAR = re.compile(r"[^,\]]*")
_WHOLE, _DECIMAL = re.compile(r"-?\d+"), re.compile(r"-?\d+\.\d+")


def leaf(token: str) -> str:
    token = token.strip()
    if len(token) > 1 and token[0] in "'\"" and token[-1] == token[0]:
        token = token[1:-1]
    if _WHOLE.fullmatch(token):
        return str(int(token))
    return str(float(token)) if _DECIMAL.fullmatch(token) else token


def parse(text: str | None) -> list | str:
    """A leaf, or lists of leaves and lists. One pass with a stack of the lists that are open."""
    body = (text or "").strip()
    if not body.startswith("["):
        return leaf(_SCALAR.match(body)[0]) if body else []
    outer: list = []
    stack, at, full = [outer], 1, False  # full: an item has just ended
    while stack and at < len(body):
        c = body[at]
        if c.isspace():
            at += 1
        elif c == "]":
            stack.pop()
            at, full = at + 1, True
        elif c == "," and full:
            at, full = at + 1, False
        elif c == "[":
            inner: list = []
            stack[-1].append(inner)
            stack.append(inner)
            at, full = at + 1, False
        else:
            token = _SCALAR.match(body, at)
            stack[-1].append(leaf(token[0]))
            at, full = token.end(), True
    return outer


def _leaves(value: list | str) -> list[str]:
    out, stack = [], [value]
    while stack:
        x = stack.pop()
        stack.extend(reversed(x)) if isinstance(x, list) else out.append(x)
    return out


def table_of(text: str | None) -> list[list[str]]:
    """A cell as a list of lists: the outer positions, and all leaves of each."""
    value = parse(text)
    return [_leaves(x) for x in (value if isinstance(value, list) else [value])]


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _tables(c: pd.Series) -> pd.Series:
    return c.map(table_of)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _flat(c: pd.Series) -> pd.Series:
    return c.map(lambda t: _leaves(parse(t)))


# Tokens that stand for themselves: whole numbers in their shortest form, and names of plain letters. Possessive, so that long cells need no stack.
_TOKEN = r"(?:0|-?[1-9][0-9]*+|[A-Za-z_][A-Za-z0-9_.\-]*+)(?=[,\]])"
_INNER = rf"\[(?:{_TOKEN}(?:,(?=[^\]]))?+)*+\]"
_PLAIN_TABLE = rf"\A\[(?:{_INNER}(?:,(?=\[)|(?=\])))*+\]\z"
_PLAIN_LIST = rf"\A\[(?:{_TOKEN}(?:,(?=[^\]]))?+)*+\]\z"


def _items(inside: Column) -> Column:
    return F.when(inside == "", F.array().cast("array<string>")).otherwise(F.split(inside, ","))


def _inside(c: Column, n: int) -> Column:
    return F.substr(c, F.lit(n + 1), F.length(c) - 2 * n)


def bracket_table(c: Column) -> Column:
    """Exact reading: plain cells in the JVM, others in batches of Python. See `well_formed_table` for cells that need no forgiving."""
    plain = F.coalesce(c.rlike(_PLAIN_TABLE), F.lit(False))
    split = F.when(c == "[]", F.array().cast("array<array<string>>")).otherwise(F.transform(F.split(_inside(c, 2), r"\],\["), _items))
    return F.when(plain, split).otherwise(_tables(F.when(~plain, c)))


def bracket_list(c: Column) -> Column:
    plain = F.coalesce(c.rlike(_PLAIN_LIST), F.lit(False))
    return F.when(plain, _items(_inside(c, 1))).otherwise(_flat(F.when(~plain, c)))


def well_formed_table(c: Column) -> Column:
    """`[[a,b],[c]]` without quotes or gaps, read by the JSON reader in the JVM; null for anything else."""
    quoted = F.regexp_replace(c, r"([^\[\],]+)", '"$1"')
    fine = c.rlike(r"\A\[(\[[^\[\],\"'\\\s]+(,[^\[\],\"'\\\s]+)*\](,(?!\])|(?=\])))*\]\z")
    return F.when(fine, F.from_json(quoted, "array<array<string>>"))
