"""Token counts: the exact number of tokens of every prefix of every text, by
dynamic programming, kept as a table that answers truncation and budget
questions without encoding a text again.

A byte-pair encoding is decided by neighbours: a row of tokens is the encoding
of its string exactly if each two neighbours are the encoding of theirs.  The
last token of a prefix is therefore the one token that ends there and fits the
last token of the prefix before it; its count is that prefix's count plus one.
One pass over a piece gives the counts of all its prefixes.  Whether two tokens
fit is read off the merges that could have joined them across the seam.

The pieces are the tokeniser's own: its normaliser and its classes of letters,
digits and marks are asked of the library, one character at a time, and cached.
A prefix that ends inside a piece counts that piece as if the text ended there,
so ``counts(text)[i]`` is what the library gives for ``text[:i]``, for every i.
Words between blanks are independent of each other; the table of a word is
computed once per worker and looked up for its other occurrences (the cache has
a bounded number of words).

``prefix_counts`` returns per document ``steps``: the differences between the
counts of neighbouring prefixes, one byte per character (four bytes each where a
difference needs them; the first byte tells the width).  ``tokens_at`` and
``longest_prefix`` answer from that column.  Counts need not grow with the
prefix (a word may have fewer tokens than its beginning), so the longest prefix
within a budget is the longest one whose own count is within it.

The vocabulary file must be a byte-level BPE with an ending for words, whose
pieces are runs of letters, single digits, runs of marks and the English endings
after an apostrophe (``word_bpe_49k.json``); another shape raises ``ValueError``.

Defined results: a null or empty text has no tokens and one prefix, the empty
one; null and repeated keys pass through; an empty table gives no row.  Extra
columns are not read.  Texts of any length are counted whole.
"""

from __future__ import annotations

import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_runs, written

CACHED_WORDS = 300_000
LONGEST_CACHED = 48  # characters of a word
COUNTED_AT_ONCE = 1 << 21  # characters
KNOWN_PAIRS = 1_000_000
NEVER = 1 << 60  # later than any merge

BLANK = " \t\n\x0b\x0c\r"
_PIECES = re.compile(r"[^\W\d_]+|\d|[ \t\n\x0b\x0c\r]+|(?:[^\w \t\n\x0b\x0c\r]|_)+")
_WORDS = re.compile(r"[ \t\n\x0b\x0c\r]+|[^ \t\n\x0b\x0c\r]+")
# fixed values: the endings that the vocabulary's pattern keeps with their apostrophe
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Merges:
    """Which tokens exist and which may stand side by side."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        self.rank = {pair: r for r, pair in enumerate(pairs)}
        self.parts = {a + b: (a, b) for a, b in pairs}
        if len(self.parts) != len(pairs):
            raise ValueError("a token of this vocabulary has more than one merge")
        self.known: dict[str | None, dict[str, bool]] = {}
        self.held = 0
        self.reachable: dict[str, bool] = {}
        symbols = [t for t in vocabulary if t in self.parts or len(t.removesuffix("</w>")) == 1]
        inner = {t for t in symbols if not t.endswith("</w>")}
        ending = {t.removesuffix("</w>"): t for t in symbols if t.endswith("</w>")}
        #: For whatever a token ends with: whether it is a token itself, and the token if the piece ends there.
        self.roles = {t[i:]: (t[i:] in inner, ending.get(t[i:])) for t in inner | ending.keys() for i in range(len(t))}

    def _seam_holds(self, left: str, left_gone: int, right: str, right_gone: int) -> bool:
        """No merge joins ``left`` and ``right`` across their seam before they are
        merged into something else themselves (at these ranks)."""
        seam, part, gone = [], right, right_gone
        while True:  # what stands right of the seam, and the rank that ends it
            seam.append((part, gone))
            if part not in self.parts:
                break
            gone, part = self.rank[self.parts[part]], self.parts[part][0]
        part, gone = left, left_gone
        while True:
            for other, other_gone in seam:
                r = self.rank.get((part, other))
                # of equal merges the left one comes first
                if r is not None and r < gone and r <= other_gone:
                    return False
            if part not in self.parts:
                return True
            gone, part = self.rank[self.parts[part]], self.parts[part][1]

    def whole(self, token: str) -> bool:
        """The token is the encoding of its own string."""
        if token not in self.parts:
            return True
        found = self.reachable.get(token)
        if found is None:
            a, b = self.parts[token]
            r = self.rank[a, b]
            found = self.reachable[token] = self.whole(a) and self.whole(b) and self._seam_holds(a, r, b, r)
        return found

    def fit(self, left: str | None, right: str) -> bool:
        """``left`` and then ``right`` (alone, if that is None) is the encoding of their string."""
        beside = self.known.get(left)
        if beside is None:
            if self.held > KNOWN_PAIRS:
                self.known, self.held = {}, 0
            beside = self.known[left] = {}
        found = beside.get(right)
        if found is None:
            self.held += 1
            found = beside[right] = self.whole(right) and (
                left is None or self._seam_holds(left, NEVER, right, NEVER))
        return found


class Piece:
    """A piece under construction: per prefix of its symbols the last token of
    that prefix when more follows, the number of tokens then, and the number if
    the piece ends there."""

    def __init__(self, merges: Merges, symbols: str = ""):
        self.merges, self.text, self.last, self.count, self.total = merges, "", [None], [0], [0]
        self.push(symbols)

    def push(self, symbols: str) -> None:
        merges, last, count = self.merges, self.last, self.count
        roles, fit = merges.roles.get, merges.fit
        text = self.text = self.text + symbols
        for end in range(len(last), len(text) + 1):
            here = total = 0
            for start in range(end - 1, -1, -1):
                t = text[start:end]
                role = roles(t)
                if role is None:  # no token ends with it
                    break
                inner, ending = role
                if inner and not here and fit(last[start], t):
                    here, token = count[start] + 1, t
                if ending and not total and fit(last[start], ending):
                    total = count[start] + 1
                if here and total:
                    break
            if not (here and total):
                raise ValueError(f"symbols without a token: {text[:end]!r}")
            last.append(token)
            count.append(here)
            self.total.append(total)

    def cut(self, size: int) -> None:
        self.text = self.text[:size]
        del self.last[size + 1:], self.count[size + 1:], self.total[size + 1:]


class Reader:
    """Characters of a normalised word, one after the other; ``tokens()`` is the
    count if the text ends after the last one."""

    def __init__(self, counter: "PrefixCounter"):
        self.counter, self.done, self.kind, self.piece, self.ending = counter, 0, "", None, ""

    def mark(self) -> tuple:
        return self.done, self.kind, self.piece, len(self.piece.text) if self.piece else 0, self.ending

    def back(self, mark: tuple) -> None:
        self.done, self.kind, self.piece, size, self.ending = mark
        if self.piece:
            self.piece.cut(size)

    def _close(self) -> None:
        if self.piece:
            self.done += self.piece.total[-1]
        self.kind, self.piece, self.ending = "", None, ""

    def _start(self, kind: str, symbols: str) -> None:
        self._close()
        self.kind, self.piece = kind, Piece(self.counter.merges, symbols)

    def read(self, char: str) -> None:
        kind, symbols = self.counter.char(char)
        if self.kind == "'":  # an apostrophe that begins a piece, and perhaps part of an ending
            tried = self.ending + char
            if tried in ENDINGS:
                self.done += self.counter.alone("'" + tried)
                self.kind, self.piece, self.ending = "", None, ""
                return
            if any(e.startswith(tried) for e in ENDINGS):
                self.ending = tried
                return
            if self.ending:  # no ending after all: the apostrophe stands alone, a word begins
                begun = self.ending
                self._close()
                self._start("L", begun)
            else:
                self.kind = "O"
        if kind == self.kind and kind in "LO":
            self.piece.push(symbols)
        elif kind == "S":
            self._close()
        elif kind == "N":
            self._start("N", symbols)
            self._close()
        else:
            self._start("'" if char == "'" else kind, symbols)

    def tokens(self) -> int:
        if not self.piece:
            return self.done
        return self.done + self.piece.total[-1] + (self.counter.alone(self.ending) if self.ending else 0)


def _joins(char: str) -> bool:
    """Whether normalisation may join the character to the one before it: a
    combining mark, a Hangul vowel or final, or a vowel sign that is a letter."""
    return (unicodedata.category(char)[0] == "M" or "ᅠ" <= char <= "ᇿ" or "ힰ" <= char <= "퟿"
            or "\U00016d63" <= char <= "\U00016d6a")


class PrefixCounter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        model, splits = held["model"], (held["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if (model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>" or model.get("dropout")
                or splits[0].get("pattern") != {"Regex": SPLIT_PATTERN} or splits[-1].get("type") != "ByteLevel"):
            raise ValueError(f"{path}: not a byte-level BPE with word endings over letters, digits and marks")
        self.merges = Merges(model["vocab"], model["merges"])
        self.specials = [t["content"] for t in held["added_tokens"]]
        self._special = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)")
        tokenizer = Tokenizer.from_file(path)
        self._normalised, self._pieces = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        self.chars: dict[str, tuple[str, str]] = {}
        self.norms: dict[str, str] = {}
        self.simple: set[str] = set(BLANK)
        self.odd: set[str] = {"'"}
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def char(self, char: str) -> tuple[str, str]:
        """Class of a normalised character (letter, digit, space, other) and its
        byte-level symbols, as the library has them."""
        found = self.chars.get(char)
        if found is None:
            own, after_letter, after_mark = (self._pieces(x) for x in (char, f"a{char}", f"!{char}"))
            kind = "S" if not own else "L" if len(after_letter) == 1 else "O" if len(after_mark) == 1 else "N"
            found = self.chars[char] = kind, "".join(p for p, _ in own)
        return found

    def normal(self, char: str) -> str:
        found = self.norms.get(char)
        if found is None:
            found = self.norms[char] = self._normalised(char)
        return found

    def plain(self, text: str) -> bool:
        """Every character stands for itself: none joins another, normalises to
        several or begins an ending, and Python's classes are the library's.  Such
        texts (but for special tokens) fall into pieces by ``_PIECES``."""
        chars = set(text)
        for c in chars.difference(self.simple, self.odd):
            kind = "L" if re.match(r"[^\W\d_]", c) else "N" if re.match(r"\d", c) else "O"
            own = self.normal(c)
            (self.simple if not _joins(c) and len(own) == 1 and own == c.lower() and self.char(own)[0] == kind
             else self.odd).add(c)
        return self.odd.isdisjoint(chars) and "<|" not in text

    def alone(self, letters: str) -> int:
        return Piece(self.merges, letters).total[-1]

    def _read(self, text: str, reader: Reader) -> Iterator[int]:
        """The count after each character of a text without special tokens."""
        at, n = 0, len(text)
        while at < n:
            end = at + 1
            while end < n and _joins(text[end]):
                end += 1
            before = reader.mark()
            shown = self.normal(text[at])
            for c in shown:
                reader.read(c)
            yield reader.tokens()
            for to in range(at + 2, end + 1):  # the base and some of its marks
                now = self._normalised(text[at:to])
                if not now.startswith(shown):
                    reader.back(before)
                    shown = ""
                for c in now[len(shown):]:
                    reader.read(c)
                shown = now
                yield reader.tokens()
            at = end

    def word(self, word: str) -> list[int]:
        """Counts of the prefixes of a word, the empty one left out."""
        counts, at, done = [], 0, 0
        for special in (*self._special.finditer(word), None):
            # a special token counts once it is whole; until then it is text like any other
            plain = word[at:special.end() - 1 if special else len(word)]
            reader = Reader(self)
            held = list(self._read(plain, reader))
            counts += [done + c for c in held]
            if special:
                own = special.start() - at
                done += (held[own - 1] if own else 0) + 1
                counts.append(done)
                at = special.end()
        return counts

    def steps(self, texts: list[str | None]) -> Iterator[bytes]:
        """Per text the differences of its counts, after a byte for their width."""
        for a, b in text_runs(texts, COUNTED_AT_ONCE):
            split, plain, words = [], set(), set()
            for t in texts[a:b]:
                t = t or ""
                if self.plain(t):
                    split.append((self.pieces, _PIECES.findall(t.lower())))
                    plain.update(split[-1][1])
                else:
                    split.append((self.words, _WORDS.findall(t)))
                    words.update(split[-1][1])
            if len(self.words) > CACHED_WORDS:
                self.words.clear()
            if len(self.pieces) > CACHED_WORDS:
                self.pieces.clear()
            words.difference_update(self.words)
            parted = {w: _PIECES.findall(w.lower()) for w in words if self.plain(w)}
            plain.update(*parted.values())
            self._learn(plain.difference(self.pieces))
            wide = {}
            for w in words:
                if w in parted:  # the steps of a piece are the same wherever it stands
                    self.words[w] = b"".join([self.pieces[p] for p in parted[w]])
                else:
                    found = np.diff(np.array([0, *self.word(w)], np.int64))
                    if np.abs(found).max(initial=0) > 127:
                        wide[w], found = found, found[:0]
                    self.words[w] = found.astype(np.int8).tobytes()
            for held, parts in split:
                if held is self.words and wide and not wide.keys().isdisjoint(parts):
                    yield b"\x04" + np.concatenate([wide[w] if w in wide else np.frombuffer(held[w], np.int8)
                                                    for w in parts]).astype("<i4").tobytes()
                else:
                    yield b"\x01" + b"".join([held[p] for p in parts])
            for held, new in ((self.words, words), (self.pieces, plain)):
                for w in new:
                    if len(w) > LONGEST_CACHED:
                        del held[w]

    def _learn(self, pieces: set[str]) -> None:
        """Steps of plain pieces and blanks; in alphabetical order a piece goes on
        from what it shares with the one before."""
        held, before = Piece(self.merges), ""
        for p in sorted(pieces):
            if p[0] in BLANK:
                self.pieces[p] = bytes(len(p))
                continue
            symbols, ends = p, None
            if not p.isascii():
                each = [self.char(c)[1] for c in p]
                symbols, ends = "".join(each), [0, *itertools.accumulate(map(len, each))]
            n, most = 0, min(len(symbols), len(before))
            while n < most and symbols[n] == before[n]:
                n += 1
            held.cut(n)
            held.push(symbols[n:])
            before = symbols
            total = [held.total[e] for e in ends] if ends else held.total
            steps = [b - a for a, b in itertools.pairwise(total)]
            if len(steps) > 127 and max(map(abs, steps)) > 127:
                raise OverflowError(f"neighbouring prefixes of a piece of {len(p)} characters differ by over 127 tokens")
            self.pieces[p] = bytes([s & 255 for s in steps])


def decoded(steps: bytes) -> np.ndarray:
    """The counts of all prefixes, the empty one first."""
    held = np.frombuffer(steps, np.int8 if steps[0] == 1 else "<i4", offset=1)
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(held, dtype=np.int64)])


_counters: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    """One per worker, so that its words serve all the worker's tasks."""
    if path not in _counters:
        _counters.clear()
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def prefix_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per document: the key, ``n_bytes`` (UTF-8), ``n_tokens`` and ``steps``."""
    path = path or default_vocabulary()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "n_bytes", F.octet_length("text").cast("long"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = batch.column("text").to_pylist()
                steps = list(counter.steps(texts))
                total = [int(np.frombuffer(s, np.int8 if s[0] == 1 else "<i4", offset=1).sum(dtype=np.int64)) for s in steps]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("n_bytes"), pa.array(total, pa.int64()), pa.array(steps, pa.binary())],
                    [key, "n_bytes", "n_tokens", "steps"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long, steps binary")


def stored(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``prefix_counts``, written once to the shared folder and read back."""
    return written(prefix_counts(docs, key, text, path), "prefix-counts")


def tokens_at(steps: Column, prefix: Column) -> Column:
    """Tokens of the prefix of so many characters (the whole text, if it has fewer;
    null for null)."""
    @F.pandas_udf("long")
    def at(steps: pd.Series, prefix: pd.Series) -> pd.Series:
        out = []
        for s, p in zip(steps, prefix, strict=True):
            if s is None or pd.isna(p):
                out.append(None)
            else:
                held = np.frombuffer(s, np.int8 if s[0] == 1 else "<i4", offset=1)
                out.append(int(held[:max(0, int(p))].sum(dtype=np.int64)))
        return pd.Series(out, dtype="Int64")
    return at(steps, prefix.cast("long"))


def longest_prefix(steps: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most so many tokens (null for null
    or a negative budget)."""
    @F.pandas_udf("long")
    def longest(steps: pd.Series, budget: pd.Series) -> pd.Series:
        return pd.Series([None if s is None or pd.isna(b) or b < 0 else int(np.flatnonzero(decoded(s) <= b)[-1])
                          for s, b in zip(steps, budget, strict=True)], dtype="Int64")
    return longest(steps, budget.cast("long"))


def truncated(docs: DataFrame, counts: DataFrame, budget: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their texts cut to at most ``budget`` tokens, from a
    table of ``prefix_counts`` with unique keys; nothing is encoded."""
    cut = counts.select(F.col(key).alias("_key"), longest_prefix(F.col("steps"), F.lit(budget)).alias("_cut"))
    out = docs.join(cut, F.col(key).eqNullSafe(F.col("_key")), "left")
    return out.withColumn(text, F.substring(F.col(text), F.lit(1), F.col("_cut").cast("int"))).drop("_key", "_cut")
