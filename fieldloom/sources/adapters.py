"""What a run needs from outside: bytes of addresses, frames and sizes of videos, files to put and delete. All are given by the caller; tests use the fakes."""

from __future__ import annotations

import os
from collections import OrderedDict
from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import resolution
from .folders import safe_parts


class Fetcher(Protocol):
    def __call__(self, url: str) -> bytes | None:
        """The content of an address, None if it cannot be had."""


class Opener(Protocol):
    def __call__(self, url: str) -> bytes | Iterable[bytes] | None:
        """The content of an address, large ones in chunks; None if it cannot be had."""


class Decoder(Protocol):
    def __call__(self, path: str, frames: list[int]) -> dict[int, bytes] | Iterable[tuple[int, bytes]]:
        """PNG bytes of some frames of a video, given in rising order; one after the other where they are many."""


class Store(Protocol):
    def __call__(self, path: str, content: bytes | Iterable[bytes]) -> None:
        """Puts a file in its place at once, so that no part of it is ever seen."""


class Mover(Protocol):
    def __call__(self, source: str, path: str) -> bool:
        """Moves a file to its place, over what lies there. True as well if the source is gone and the file is in its place."""


class Prober(Protocol):
    def __call__(self, path: str) -> tuple[int, int, float] | None:
        """Width, height and frames per second of a video, None if it cannot be read."""


class Remover(Protocol):
    def __call__(self, path: str) -> bool:
        """Deletes a file; False if there is none."""


def download(frames: DataFrame, fetch: Fetcher, store: Store, url: str = "source_url", path: str = "local_path") -> DataFrame:
    """url, path and whether its bytes were stored, for each row. A failed one does not stop the others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for u, p in zip(pdf[url], pdf[path]):
                try:
                    content = fetch(u)
                    if content is not None:
                        store(p, content)
                    done.append(content is not None)
                except OSError:
                    done.append(False)
            yield pd.DataFrame({"url": pdf[url], "path": pdf[path], "stored": done})

    return frames.select(url, path).mapInPandas(run, "url string, path string, stored boolean")


class Remembering:
    """A fetcher that gives what it had lately again; what failed is tried anew. It holds `most` contents, those asked for last."""

    def __init__(self, fetch: Fetcher, most: int = 32) -> None:
        self.fetch, self.most, self.had = fetch, most, OrderedDict()

    def __call__(self, url: str) -> bytes | None:
        if url in self.had:
            self.had.move_to_end(url)
        elif (content := self.fetch(url)) is not None:
            self.had[url] = content
            if len(self.had) > self.most:
                self.had.popitem(last=False)
        return self.had.get(url)


def folder_page(fetch: Fetcher, url: str) -> tuple[str, bytes] | None:
    """(address, content) of a browse page: with a slash at its end, else without."""
    bare = url.rstrip("/")
    for form in (f"{bare}/", bare):
        try:
            if (content := fetch(form)) is not None:
                return form, content
        except OSError:
            pass
    return None


def fetch_pages(wanted: DataFrame, fetch: Fetcher, url: str = "url") -> DataFrame:
    """asked, url, html of the distinct browse pages that can be had; each address is asked for once, and no page is held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for u in pdf[url]:
                if got := folder_page(fetch, u):
                    yield pd.DataFrame({"asked": [u], "url": [got[0]], "html": [got[1].decode("utf-8", "replace")]})

    return wanted.select(url).distinct().mapInPandas(run, "asked string, url string, html string")


def first_available(candidates: DataFrame, fetch: Opener, name: str = "name", store: Store | None = None, path: Callable[[str], str] = str) -> DataFrame:
    """For each name the first address by priority that can be had; a failed one leads to the next, also where its content cannot be stored. With
    `store` its content is put at path(name) as it was fetched, so that nothing is fetched twice."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, found = object(), False  # a name's rows follow each other, also over the end of a batch
        for pdf in batches:
            had = []
            for own, url in zip(pdf[name], pdf["url"]):
                if own != asked:
                    asked, found = own, False
                if found:
                    continue
                try:
                    content = fetch(url)
                    if content is None:
                        continue
                    if store is not None:
                        store(path(own), content)
                except OSError:
                    continue
                found = True
                had.append((own, url))
            yield pd.DataFrame(had, columns=[name, "url"], dtype=object)

    rows = candidates.select(name, "url", "priority").repartition(name).sortWithinPartitions(name, "priority", "url")
    return rows.select(name, "url").mapInPandas(run, f"{name} string, url string")


def probe(videos: DataFrame, read: Prober, path: str = "path") -> DataFrame:
    """path, width, height, fps and resolution of each video; 0 and `unknown` where they cannot be read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for p in pdf[path]:
                try:
                    found.append((p, *(read(p) or (0, 0, 0.0))))
                except OSError:
                    found.append((p, 0, 0, 0.0))
            yield pd.DataFrame(found, columns=["path", "width", "height", "fps"])

    read_out = videos.select(path).distinct().mapInPandas(run, "path string, width int, height int, fps double")
    return read_out.withColumn("resolution", resolution(F.col("width"), F.col("height")))


def delete_videos(videos: DataFrame, remove: Remover, path: str = "path", downloaded: str = "was_downloaded") -> DataFrame:
    """path and outcome (deleted, missing or failed) of each distinct video that this run has fetched; others are never touched. Given the rows that
    `frames.deletable` allows, videos go at their last use; given all, it is the cleanup at the end of a run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for p in pdf["path"]:
                try:
                    done.append("deleted" if remove(p) else "missing")
                except OSError:
                    done.append("failed")
            yield pd.DataFrame({"path": pdf["path"], "outcome": done})

    mine = videos.where(F.col(downloaded) & F.col(path).isNotNull()).select(F.col(path).alias("path")).distinct()
    return mine.mapInPandas(run, "path string, outcome string")


class LocalStore:
    """Files below a folder that all tasks see. A file is written beside its place first, then moved there."""

    def __init__(self, root: str) -> None:
        self.root = root

    def place(self, path: str) -> str:
        return os.path.join(self.root, safe_parts(*path.strip("/").split("/")))

    def __call__(self, path: str, content: bytes | Iterable[bytes]) -> None:
        at = self.place(path)
        os.makedirs(os.path.dirname(at), exist_ok=True)
        beside = f"{at}.{os.getpid()}.tmp"
        try:
            with open(beside, "wb") as f:
                for chunk in (content,) if isinstance(content, bytes) else content:
                    f.write(chunk)
            os.replace(beside, at)
        finally:
            if os.path.exists(beside):  # the content broke off
                os.remove(beside)

    def move(self, source: str, path: str) -> bool:
        at = self.place(path)
        os.makedirs(os.path.dirname(at), exist_ok=True)
        try:
            os.replace(self.place(source), at)
        except FileNotFoundError:
            return os.path.exists(at)
        return True

    def remove(self, path: str) -> bool:
        return remove_file(self.place(path))


def remove_file(path: str) -> bool:
    """Deletes a file of the store that all tasks see."""
    try:
        os.remove(path)
        return True
    except FileNotFoundError:
        return False


class MemoryFiles:
    """Fakes of them for tests in one process."""

    def __init__(self, contents: dict[str, bytes]) -> None:
        self.contents = dict(contents)

    def fetch(self, url: str) -> bytes | None:
        return self.contents.get(url)

    def store(self, path: str, content: bytes | Iterable[bytes]) -> None:
        self.contents[path] = content if isinstance(content, bytes) else b"".join(content)

    def move(self, source: str, path: str) -> bool:
        if source in self.contents:
            self.contents[path] = self.contents.pop(source)
        return path in self.contents

    def remove(self, path: str) -> bool:
        return self.contents.pop(path, None) is not None
