"""List-valued cells as array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_wildcard, strip, whole_number


def as_list(c: Column) -> Column:
    """A scalar as a list of one, nothing as an empty list."""
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array(c))


def as_filter_list(c: Column) -> Column:
    """A comma-separated text as the list of its parts; blank or `[]` is empty."""
    parts = F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")
    return F.when(c.isNull() | strip(c).isin("", "[]"), F.array().cast("array<string>")).otherwise(parts)


def first_scalar(nested: Column) -> Column:
    return F.get(F.get(nested, F.lit(0)), F.lit(0))


def pick(values: Column, position: Column) -> Column:
    """The value at a position, null beyond the list."""
    return F.get(values, position)


def flat_values(nested: Column) -> Column:
    """All leaves in order, without blanks; positions close up."""
    return F.filter(F.flatten(nested), lambda x: x.isNotNull() & (x != ""))


def seconds(values: Column, strict: bool = True) -> Column:
    """Whole seconds of the texts that are not blank. A bad one fails the query, or is null if not `strict`."""

    def one(x: Column) -> Column:
        number = whole_number(x)
        bad = F.raise_error(F.concat(F.lit("not a time in seconds: "), x)).cast("bigint")
        return F.when(number.isNotNull(), number).otherwise(bad) if strict else number

    return F.transform(F.filter(values, lambda x: x.isNotNull() & (x != "")), one)


def align(values: Column, n: Column) -> Column:
    """n values: nulls for none, the last one repeated if there are fewer, cut if there are more."""
    filled = F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: F.get(values, F.least(i, F.size(values) - 1)))
    return F.when(n > 0, filled).otherwise(F.slice(values, 1, 0))


def paired(starts: Column, ends: Column) -> Column:
    """Pairs of starts and ends as far as both go."""
    n = F.least(F.size(starts), F.size(ends))
    return F.transform(F.slice(starts, 1, n), lambda s, i: F.struct(s.alias("start"), F.get(ends, i).alias("end")))


def times_of(start: Column, end: Column, step: int) -> Column:
    """start, start + step, ... up to and with `end`; none if the range is empty."""
    if step <= 0:
        raise ValueError("the interval must be positive")
    return F.when(end >= start, F.sequence(start, end, F.lit(step).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))


def wanted(values: Column, normal: Callable[[Column], Column]) -> Column:
    """The distinct values of a filter; empty (that is, everything) if one is a wildcard. `unknown` is no value to ask for."""
    cleaned = F.array_distinct(F.filter(F.transform(values, normal), lambda x: x.isNotNull() & (x != "unknown")))
    return F.when(F.size(F.filter(values, is_wildcard)) > 0, F.slice(cleaned, 1, 0)).otherwise(cleaned)


def search_map(table: Column, needle: Column, nested: bool = False) -> Column:
    """The first key whose value (or one of whose values) holds the needle or lies in it."""
    near = lambda v: F.contains(v, needle) | F.contains(needle, v)
    hit = F.filter(F.map_entries(table), lambda e: F.exists(e["value"], near) if nested else near(e["value"]))
    return F.get(hit, F.lit(0))["key"]
