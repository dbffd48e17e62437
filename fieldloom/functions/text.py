"""Cleaning of names and labels, as column expressions.

Patterns use the white space that Python's str.strip() and str.split() know, which is more than Java's. All functions give a value for
null, blank and any other text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import TIMES, VEHICLES, label_of

WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Texts that stand for a missing value, by use.
MISSING_NAME = ("", "[]", "None", "null", "nan")
MISSING_FILTER_NAME = (*MISSING_NAME, "{}")
MISSING_FIELD = (*MISSING_NAME, "unknown")
EMPTY_MARKERS = ("", ".", "/", "[]", "{}", "None", "null", "nan")

_WS_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_PLAIN = r"\A[A-Za-z0-9_#.\-]{1,200}\z"  # names of these letters only are clean as they are
_SHORT_NUMBER = r"\A-?[0-9]{1,15}\z"
_NUMBER = r"\A[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\z"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_WS_CHARS))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def clean_name(c: Column, missing: tuple[str, ...] = MISSING_NAME) -> Column:
    """A folder-safe name: `unknown` if missing, forbidden characters to `_`, white space runs to one space."""
    tidy = lambda s: strip(F.regexp_replace(F.regexp_replace(s, r'[<>:"/\\|?*]+', "_"), f"{WS}+", " "))
    named = lambda s: _once(tidy(s), lambda t: F.when(t == "", F.lit("unknown")).otherwise(t))
    any_name = _once(strip(c), lambda s: F.when(s.isNull() | s.isin(*missing), F.lit("unknown")).otherwise(named(s)))
    return F.when(c.rlike(_PLAIN) & ~c.isin(*missing), c).otherwise(any_name)


def is_missing(c: Column) -> Column:
    return c.isNull() | strip(c).isin(*MISSING_FIELD)


def is_empty_marker(c: Column) -> Column:
    return c.isNull() | strip(c).isin(*EMPTY_MARKERS)


def is_wildcard(c: Column) -> Column:
    """Whether a filter value asks for everything."""
    return is_empty_marker(c) | (F.lower(strip(c)) == "all")


def folded(c: Column) -> Column:
    """Without regard to case, letters such as ß and ς included: their small letters after their capitals. The dotless i has a capital of
    another letter and stays itself."""
    kept = F.replace(F.lower(c), F.lit("ı"), F.lit("\ue000"))
    return F.when(c.rlike(r"[^\x00-\x7f]"), F.translate(F.lower(F.translate(F.upper(kept), "\ue000", "ı")), "ς", "σ")).otherwise(F.lower(c))


def match_key(c: Column) -> Column:
    """What names are compared by."""
    return folded(clean_name(c, MISSING_FILTER_NAME))


def whole_number(c: Column) -> Column:
    """Text of a number, cut to an integer; null for anything else, infinite or not a number."""
    own = c.cast("string")
    text = strip(own)
    value = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    return F.when(own.rlike(_SHORT_NUMBER), own.try_cast("bigint")).when(text.rlike(_NUMBER), value.try_cast("bigint"))


def _code_label(c: Column, labels: dict[int, str]) -> Column:
    number = whole_number(c)
    by_code = F.coalesce(label_of(number, labels), F.concat(F.lit("Unknown_"), number.cast("string")))
    return F.when(c.isNull() | (c == ""), "Unknown").when(number.isNotNull(), by_code).otherwise(clean_name(c))


def time_label(c: Column) -> Column:
    """Label of a time-of-day code or text; unknown codes keep their number."""
    return _code_label(c.cast("string"), TIMES)


def vehicle_label(c: Column) -> Column:
    return _code_label(c.cast("string"), VEHICLES)


def vehicle_list_label(codes: Column) -> Column:
    """Label of several vehicles: the names joined; of none: Unknown."""
    names = F.array_join(F.transform(codes, vehicle_label), "__")
    return F.when(codes.isNull() | (F.size(codes) == 0), "Unknown").otherwise(names)


def day_filter(c: Column) -> Column:
    """A wanted time of day in the inventory's words; null asks for all."""
    low = F.lower(strip(c))
    known = F.when(low.isin("0", "day", "daytime"), "Day").when(low.isin("1", "night", "nighttime"), "Night")
    text = clean_name(c, MISSING_FILTER_NAME)
    number = whole_number(c)
    coded = F.when(number.isNotNull(), F.coalesce(label_of(number, TIMES), text))
    return F.when(~is_wildcard(c), F.coalesce(known, coded, text))


def vehicle_filter(c: Column) -> Column:
    """A wanted vehicle in the inventory's words: by name in any case, or by code; null asks for all."""
    by_name = F.create_map(*(F.lit(x) for v in VEHICLES.values() for x in (v.lower(), v)))
    text = clean_name(c, MISSING_FILTER_NAME)
    named = F.try_element_at(by_name, F.lower(strip(c)))
    return F.when(~is_wildcard(c), F.coalesce(named, label_of(whole_number(c), VEHICLES), text))


def stem(c: Column) -> Column:
    """A path without its extension; leading dots begin no extension."""
    return F.regexp_replace(c, r"^((?:.*/)?[^/]*[^./][^/]*)\.[^./]*$", "$1")


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def video_filter(c: Column) -> Column:
    return F.when(~is_wildcard(c), clean_name(stem(strip(c)), MISSING_FILTER_NAME))


def video_key(c: Column) -> Column:
    """What references to one video share: no case, no extension; blank is the empty text."""
    return F.coalesce(stem(F.lower(strip(c))), F.lit(""))


def frame_index(seconds: Column, fps: Column) -> Column:
    """The frame nearest to a time, ties to the even one."""
    return F.rint(seconds * fps).cast("bigint")


def frame_name(video: Column, seconds: Column) -> Column:
    return F.concat(clean_name(stem(basename(video))), F.lit("_"), seconds.cast("string"), F.lit(".png"))


def output_folder(root: Column | str, *parts: Column) -> Column:
    root = F.lit(root) if isinstance(root, str) else root
    return F.concat_ws("/", root, *(clean_name(p) for p in parts))


def resolution(width: Column, height: Column) -> Column:
    return F.when((width > 0) & (height > 0), F.format_string("%dx%d", width, height)).otherwise("unknown")
