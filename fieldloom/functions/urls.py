"""Addresses of browse pages and files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import IMAGE_EXTENSIONS
from .text import MISSING_FILTER_NAME, basename, clean_name, strip


def quote(c: Column) -> Column:
    """Percent-encoding of all but letters, digits and `-._~`."""
    return F.replace(F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def quote_path(parts: Column) -> Column:
    """A path of encoded segments; outer spaces and slashes and empty segments go."""
    clean = F.transform(parts, lambda p: F.regexp_replace(p, r"\A[ /]+|[ /]+\z", ""))
    return F.array_join(F.transform(F.filter(clean, lambda p: p != ""), quote), "/")


def unquote(c: Column) -> Column:
    """Decoded percent-escapes; `+` stays, and so do bad escapes. Only their percent sign is escaped, so the good ones beside them are decoded."""
    good = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(good), c)


def browse_url(base: Column | str, alias: Column | str, parts: Column, slash: bool = False) -> Column:
    base, alias = (F.lit(x) if isinstance(x, str) else x for x in (base, alias))
    path = quote_path(parts)
    url = F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/v/"), alias, F.lit("/browse"), F.when(path != "", F.concat(F.lit("/"), path)).otherwise(""))
    return F.concat(url, F.lit("/")) if slash else url


def path_of(url: Column) -> Column:
    """The path of an address, without query and fragment."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def _without_dots(path: Column) -> Column:
    """A path without `.` and `..` segments; nothing lies above the root."""
    up = lambda acc: F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))
    step = lambda acc, s: F.when(s == ".", acc).when(s == "..", up(acc)).otherwise(F.concat(acc, F.array(s)))
    parts = F.concat(F.split(path, "/"), F.when(path.rlike(r"(?:^|/)\.\.?$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))
    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")).otherwise(path)


def join(page: Column, href: Column) -> Column:
    """An address as seen from a page, by the rules of RFC 3986."""
    origin = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(path_of(page), "[^/]*$", "")
    own, rest = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    from_root = F.when(own.startswith("/"), own).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), own))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(page, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
        .when(href == "", page)
        .when(href.startswith("#"), F.concat(F.regexp_replace(page, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(origin, path_of(page), href))
        .otherwise(F.concat(origin, _without_dots(from_root), rest))
    )


def is_image(url: Column) -> Column:
    return F.lower(unquote(path_of(url))).rlike(rf"\.(?:{'|'.join(IMAGE_EXTENSIONS)})$")


def file_name(url: Column) -> Column:
    return clean_name(basename(unquote(path_of(url))), MISSING_FILTER_NAME)


def anchor_name(label: Column, url: Column) -> Column:
    """What a link is called: its text, else the end of its address."""
    return F.when(strip(F.coalesce(label, F.lit(""))) != "", strip(label)).otherwise(basename(unquote(F.regexp_replace(path_of(url), "/+$", ""))))


def is_folder_link(path: Column) -> Column:
    return path.startswith("/v/") & F.contains(path, F.lit("/browse"))


def is_file_link(path: Column) -> Column:
    return F.contains(path, F.lit("/files/"))
