"""Packing: concatenate all documents and cut every ``LENGTH`` tokens.

Pass one tokenises each partition and writes its token ids with a running sum,
so every document knows the tokens before it in its partition.  The totals of
the partitions, one number each, become exclusive prefix sums: the global
offset of a partition.  Pass two adds the two and cuts at multiples of the
length: a document that crosses a boundary leaves one record per sequence it
touches.  Both passes stream; nothing is sorted or shuffled.  Pass one is a
written table, so a lost executor repeats tasks without moving any offset.

Every document ends with ``end_id``.  Token ids travel as little-endian
unsigned 32-bit numbers.  All sequences but the last are full.

``by_word``: the tokeniser drops white space, looks at nothing across it, and
parts letters and digits from the marks after them (true of the default
vocabulary); words and single marks are then looked up in a cache of bounded
size.  Otherwise whole texts are encoded.

Defined results: a null or empty text is the end id alone; null and repeated
keys pass through; an empty table gives no row.  Extra columns are not read.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, text_runs, written

LENGTH = 4096
END_ID = 2
CACHED_WORDS = 400_000
LONGEST_CACHED = 48  # bytes of a word
ENCODED_AT_ONCE = 1 << 20  # characters
JOINED = 256
MARKS = '!"#$%&()*+,-./:;=?@[]^_`{}~'  # the apostrophe may belong to what is before it
# a run of marks between an ASCII letter or digit and a blank or the end
_MARK = re.compile(rb"[%b](?<=[A-Za-z0-9].)[%b]*+(?=\s|\Z)" % ((re.escape(MARKS).encode(),) * 2))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Texts to the bytes of their ids."""

    def __init__(self, path: str, end_id: int, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = struct.pack("<I", end_id)
        self.by_word = by_word
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # the cache before, for words met again
        ends = [i for w, i in self.tokenizer.get_vocab().items() if w.endswith("</w>")]
        self.ends_piece = np.zeros(max(self.tokenizer.get_vocab().values(), default=0) + 1, bool)
        self.ends_piece[ends] = True

    def forget(self) -> None:
        """Drops the words met: idle workers keep no cache beside other stages."""
        self.cache, self.older = {}, {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e)}I", *e.ids) for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """A word of letters is one piece, and the last id of a piece says so: such
        words are encoded many at a time and told apart by it.  A word of letters
        and the marks after it is encoded in these two parts."""
        out, parted, letters, others = {}, {}, set(), set()
        for w in words:
            plain = w.decode()
            stem = plain.rstrip(MARKS)
            if len(w) > LONGEST_CACHED or not stem.isalpha():
                others.add(w)
                continue
            letters.add(stem.encode())
            if len(stem) < len(plain):
                parted[w] = stem.encode(), plain[len(stem):].encode()
                others.add(parted[w][1])
        letters = list(letters)
        for at in range(0, len(letters), JOINED):
            part = letters[at:at + JOINED]
            ids = np.frombuffer(self._encode([b" ".join(part).decode()])[0], "<u4")
            cut = np.flatnonzero(self.ends_piece[ids]) + 1
            if len(cut) != len(part):  # some word has more pieces than one
                others.update(part)
                continue
            raw, ends = ids.tobytes(), (cut * 4).tolist()
            out.update(zip(part, [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], strict=True))
        others = list(others)
        for at in range(0, len(others), JOINED):
            part = others[at:at + JOINED]
            out.update(zip(part, self._encode([w.decode() for w in part]), strict=True))
        out.update((w, out[stem] + out[marks]) for w, (stem, marks) in parted.items())
        return {w: out[w] for w in words}

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        for a, b in text_runs(texts, ENCODED_AT_ONCE):
            part = [t or "" for t in texts[a:b]]
            yield from ((ids + self.end for ids in self._encode(part)) if not self.by_word else self._by_word(part))

    def _by_word(self, texts: list[str]) -> Iterator[bytes]:
        split = []
        for t in texts:
            data = t.encode()
            # the tokeniser folds case; its own special strings (none without "<|") it does not
            data = data if b"<|" in data else data.lower()
            split.append(_MARK.sub(rb" \g<0>", data).split())  # at ASCII white space
        if len(self.cache) > CACHED_WORDS:
            self.older, self.cache = self.cache, {}
        cache, older = self.cache, self.older
        new = set().union(*split).difference(cache)
        if older:
            known = older.keys() & new  # looks up the fewer
            cache.update((w, older[w]) for w in known)
            new -= known
        cache.update(self._encode_words(list(new)))
        for words in split:
            yield b"".join(map(cache.__getitem__, words)) + self.end
        for w in new:
            if len(w) > LONGEST_CACHED:
                del cache[w]


_encoders: dict[tuple, Encoder] = {}


def _encoder(*args) -> Encoder:
    """One per worker, so that its tasks read the vocabulary once; a task's words go with it."""
    if args not in _encoders:
        _encoders.clear()
        _encoders[args] = Encoder(*args)
    return _encoders[args]


def tokenised(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
              end_id: int = END_ID, by_word: bool = True) -> DataFrame:
    """Pass one: per document its ids, its number of tokens, its partition and
    the tokens before it there."""
    path = path or default_tokenizer()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    small = pa.binary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(path, end_id, by_word), TaskContext.get().partitionId(), 0
        try:
            for batch in sliced(batches):
                ids = list(encoder(batch.column("text").to_pylist()))
                n = [len(x) // 4 for x in ids]
                sums = list(itertools.accumulate(n, initial=before))
                before = sums[-1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array([part] * len(ids), pa.int32()), pa.array(sums[:-1], pa.int64()),
                     pa.array(n, pa.int64()), pa.array([_narrow(x) for x in ids], small)],
                    ["key", "part", "before", "n", "ids"])
        finally:
            encoder.forget()

    kind = rows.schema["key"].dataType.simpleString()
    return written(rows.mapInArrow(encode, f"key {kind}, part int, before long, n long, ids binary"), "packing")


def _narrow(ids: bytes) -> bytes:
    """Ids as stored between the passes: 16 bits each if they fit, marked by a first byte."""
    a = np.frombuffer(ids, "<u4")
    return b"\x02" + a.astype("<u2").tobytes() if a.max() < 1 << 16 else b"\x04" + ids


def _widened(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if ids[0] == 2 else "<u4", offset=1).astype("<u4")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, path: str | None = None,
         end_id: int = END_ID, by_word: bool = True) -> DataFrame:
    """One row per piece: key, start and length in the document, ids (binary),
    doc_tokens, sequence_id and the offset there."""
    rows = tokenised(docs, key, text, path, end_id, by_word)
    totals = sorted((r[0], r[1]) for r in rows.groupBy("part").agg(F.sum("n")).collect())  # a number per partition
    sums = itertools.accumulate((n for _, n in totals), initial=0)
    offsets = rows.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(totals, sums, strict=False)],
                                                "part int, base long")
    placed = rows.join(F.broadcast(offsets), "part").select(
        "key", (F.col("base") + F.col("before")).alias("at"), "n", "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                owner, start, size, ids, sequence, offset = [], [], [], [], [], []
                for i, (at, n, held) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("at", "n", "ids")),
                                                      strict=True)):
                    held = _widened(held)
                    for w in range(at // length, (at + n - 1) // length + 1):
                        a, b = max(0, w * length - at), min(n, (w + 1) * length - at)
                        owner.append(i)
                        start.append(a)
                        size.append(b - a)
                        ids.append(held[a:b].tobytes())
                        sequence.append(w)
                        offset.append(at + a - w * length)
                take = pa.array(owner, pa.int64())
                longs = [pa.array(x, pa.int64()) for x in (start, size, sequence, offset)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(take), *longs[:2], pa.array(ids, pa.binary()),
                     batch.column("n").take(take), *longs[2:]],
                    [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = docs.schema[key].dataType.simpleString()
    return placed.mapInArrow(cut, f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, "
                                  "sequence_id long, offset long")
