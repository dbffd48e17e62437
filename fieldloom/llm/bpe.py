"""Exact BPE encoding by per-prefix dynamic programming, and decoding.

An automaton over the vocabulary gives, at each prefix of a word, the tokens that end there, longest first. One of them is the last
token of the prefix's encoding: the one that is compatible with the last token of the prefix before it. A pair is compatible if
undoing the merges of both, newest first, never shows a pair across the border that would have been merged earlier. The stored
last tokens are the back-pointers from which the ids are read. The time is linear in the word, with no merge loop.

Tokenizer files of the `tokenizers` library with a BPE model, an end-of-word suffix and byte-level words are read. Words are what
lies between white space, cut by the file's pattern. Unusual characters go through the file's own normalizer and pre-tokenizer.

Defined cases: null text is empty and has no ids; the special tokens' strings in a text are those tokens; whole texts of any length
are encoded; repeated rows get the same ids; null ids decode to the empty text. Columns of the input are kept unless named like an
output. An empty table gives an empty one.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import coded_words, with_columns

#: Entries that a worker keeps of words' ids and of pairs' tests; beyond that it starts anew.
KEPT_WORDS, KEPT_PAIRS = 150_000, 300_000
#: Below this, lower-casing and composing a text is what the library does, character by character.
PLAIN = 0x250


@lru_cache(1)
def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens in the order of their merges ("ranks"): single symbols first. A symbol is a byte, plus 256 at the end of a word."""

    def __init__(self, source: str) -> None:
        from tokenizers import Tokenizer

        spec = json.loads(source)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(not t or t != t.strip() or len(t.split()) > 1 for t in self.special):
            raise ValueError("special tokens with white space are not read")
        self.special_signs = "".join(sorted({t[0] for t in self.special}))
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        vocab, letters, self.library = model["vocab"], byte_letters(), Tokenizer.from_str(source)
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        size = max([*vocab.values(), *self.special.values()]) + 1
        names = [""] * size
        for name, i in [*vocab.items(), *self.special.items()]:
            names[i] = name
        self.names = pa.array(names)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = [a + b for a, b in merges]
        if len(set(made)) != len(made):
            raise ValueError("two merges make the same token; ranks are not unique")
        merged = set(made)
        base = sorted((i, name) for name, i in vocab.items() if name not in merged)
        order = [name for _, name in base] + made
        rank = {name: r for r, name in enumerate(order)}
        self.ids = [vocab[name] for name in order]
        self.left, self.right = list(range(len(order))), list(range(len(order)))
        self.joined: dict[int, int] = {}
        self.n = len(order)
        for (a, b), name in zip(merges, made):
            r = rank[name]
            self.left[r], self.right[r] = rank[a], rank[b]
            self.joined[rank[a] * self.n + rank[b]] = r
        self.length = [0] * self.n
        self._automaton(order, letters)
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}

    def _symbols(self, name: str, letters: dict[str, int]) -> list[int]:
        ends = bool(self.suffix) and name.endswith(self.suffix) and len(name) > len(self.suffix)
        out = [letters[c] for c in (name[: -len(self.suffix)] if ends else name)]
        if ends:
            out[-1] += 256
        return out

    def _automaton(self, order: list[str], letters: dict[str, int]) -> None:
        """States are prefixes of tokens; `ends[s]`: the tokens that are suffixes of s, longest first, with their lengths."""
        children: list[dict[int, int]] = [{}]
        own = array("i", [-1])
        for r, name in enumerate(order):
            state, symbols = 0, self._symbols(name, letters)
            self.length[r] = len(symbols)
            for c in symbols:
                after = children[state].get(c)
                if after is None:
                    after = children[state][c] = len(children)
                    children.append({})
                    own.append(-1)
                state = after
            own[state] = r
        back, self.ends, queue = [0] * len(children), [()] * len(children), list(children[0].items())
        parent = dict.fromkeys((s for _, s in queue), 0)
        for c, state in queue:  # breadth first; the list grows
            f = back[parent[state]]
            while f and c not in children[f]:
                f = back[f]
            target = children[f].get(c, 0)
            back[state] = target if target != state else 0
            mine = () if own[state] < 0 else ((own[state], self.length[own[state]]),)
            self.ends[state] = mine + self.ends[back[state]]
            for d, after in children[state].items():
                parent[after] = state
                queue.append((d, after))
        # one table for all states is far smaller than a table for each
        self.step = {s << 9 | c: after for s, to in enumerate(children) for c, after in to.items()}
        self.back = array("i", back)

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay next to each other: no pair that meets at their border on the way down is merged first."""
        left, right, joined, n = self.left, self.right, self.joined, self.n
        limit = n + 1  # what merges at the border must come before this to matter
        while True:
            made = joined.get(a * n + b)
            if made is not None and made < limit:
                return False
            a_down, b_down = right[a], left[b]
            if (a > b and a_down != a) or b_down == b:
                if a_down == a:
                    return True
                limit, a = a, a_down  # a was made after b: undo it
            else:
                limit, b = b + 1, b_down

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one word by the last token of each of its prefixes."""
        n, step, back, ends, pairs = len(word), self.step, self.back, self.ends, self.pairs
        symbols = list(word)
        if self.suffix:
            symbols[-1] += 256
        last, state, size = [0] * (n + 1), 0, self.n
        for i in range(1, n + 1):
            c = symbols[i - 1]
            after = step.get(state << 9 | c)
            while after is None and state:
                state = back[state]
                after = step.get(state << 9 | c)
            state = after or 0
            for token, length in ends[state]:
                if length == i:
                    last[i] = token
                    break
                key = last[i - length] * size + token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= KEPT_PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self.compatible(last[i - length], token)
                if fits:
                    last[i] = token
                    break
            else:
                raise ValueError("no token for a prefix")
        out, i = [], n
        while i:
            out.append(self.ids[last[i]])
            i -= self.length[last[i]]
        return out[::-1]

    def _plain(self, text: str) -> list[int]:
        if not text:
            return []
        if max(text) < chr(PLAIN):
            low = text.lower()
            parts = [p.encode() for p in ([low] if low.isalpha() else self.pattern.findall(low))]
        else:
            letters, library = byte_letters(), self.library
            parts = [bytes(letters[c] for c in p) for p, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))]
        return [i for p in parts for i in self.encode_word(p)]

    def encode_chunk(self, chunk: str) -> bytes:
        """Packed ids of what lies between white space."""
        found = self.words.get(chunk)
        if found is None:
            if any(c in chunk for c in self.special_signs) and self.special_pattern.search(chunk):
                ids, at = [], 0
                for m in self.special_pattern.finditer(chunk):
                    ids += [*self._plain(chunk[at : m.start()]), self.special[m[0]]]
                    at = m.end()
                ids += self._plain(chunk[at:])
            else:
                ids = self._plain(chunk)
            if len(self.words) >= KEPT_WORDS:
                self.words.clear()
            found = array("I", ids).tobytes()
            if len(chunk) < 100:
                self.words[chunk] = found
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's begin)."""
        chunks, codes, starts = coded_words(texts)
        packed = [self.encode_chunk(c) for c in chunks]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        flat, first = np.frombuffer(b"".join(packed), "<u4"), np.cumsum(sizes) - sizes
        size = sizes[codes] if len(codes) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        take = np.repeat(first[codes] - ends[:-1], size) + np.arange(ends[-1]) if len(codes) else np.zeros(0, np.int64)
        return flat[take], ends[starts]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The library's text of ids where the file names no decoder: the tokens with a space between."""
        names = self.names.take(pa.array(ids.astype(np.int32)))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), names), " ")


@lru_cache(1)
def vocabulary(source: str) -> Vocabulary:
    return Vocabulary(source)


def packed_column(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer((4 * starts).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, offsets, pa.py_buffer(ids.astype("<u4").tobytes())])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = pc.fill_null(column, b"")
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False) // 4
    return np.frombuffer(b"".join(column.to_pylist()), "<u4"), np.concatenate([[0], np.cumsum(sizes)])


def _shipped(df: DataFrame, path: str):
    """The driver reads the tokenizer file, whose size it bounds; executors need not have it."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    if len(source) > 64_000_000:
        raise ValueError("the tokenizer file is too large to send to each executor")
    return df.sparkSession.sparkContext.broadcast(source)


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, out: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds `out`: each text's ids, packed as little-endian unsigned 32-bit integers; and, if named, `decoded`: their text."""
    source = _shipped(docs, path)

    def make():
        vocab = vocabulary(source.value)

        def each(part: pa.RecordBatch) -> dict[str, pa.Array]:
            ids, starts = vocab.encode(part.column(text))
            made = {out: packed_column(ids, starts)}
            return made | ({decoded: vocab.decode(ids, starts)} if decoded else {})

        return each

    return with_columns(docs, text, [(out, T.BinaryType()), *([(decoded, T.StringType())] if decoded else [])], make, keep, holds=("bpe", vocabulary.cache_clear))


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None, out: str = "decoded") -> DataFrame:
    """Adds `out`: the text of packed ids."""
    source = _shipped(encoded, path)

    def make():
        vocab = vocabulary(source.value)
        return lambda part: {out: vocab.decode(*unpacked(part.column(ids)))}

    return with_columns(encoded, ids, [(out, T.StringType())], make, keep, holds=("bpe", vocabulary.cache_clear))
