"""Fill-in-the-middle: documents cut into prefix, middle and suffix at unit
boundaries and written in another order, by secondary sort.

Each text is cut into units (lines, each with its line feed).  Runs of whole
units become chunks of at most ``CHUNK`` bytes (a longer unit becomes several
chunks); sentinels are chunks of their own.  Chunks are keyed by document and
position in the output, dealt out by document and sorted within the partitions,
so a task reads every output from its beginning to its end and feeds it into an
incremental digest: no text is put together in memory.  On the way each chunk
gets the place it has in the restored text, which follows from the sentinels met
in the output alone.  The chunks of a document already lie in one partition; a
second sort within the partitions streams the restored text into its digest.

A document is a row.  Rows are told apart by a hash of key and text, the
partition they come from and a number among the equal rows there, so rows that
repeat are spread over the tasks, and a task that runs again deals them alike.

The cuts come from the SHA-256 of ``seed:key``: its first two 8-digit groups h1
and h2 modulo (units + 1) are the ends of prefix and middle, h3 % 100 under
``rate`` says whether the document is transformed, h4 % 100 under ``spm_rate``
whether the suffix goes first (``spm``) or the prefix (``psm``).

Defined results: a null or empty text, and a text that holds a sentinel, is left
as it is (form ``plain``, no character counts); a null key hashes as the empty
string; equal rows give equal rows; an empty table gives no row.  Extra columns
are not read.  Texts of any length are used whole.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 15  # bytes
SENT_AT_ONCE = 1 << 22  # bytes of chunks in a batch
SENTINELS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"plain": (), "psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
RESTORED = {b"<P>": 0, b"<M>": 1, b"<S>": 2}  # sections in the order of the text
HEADER = -1  # position of the row that describes a document
IDENTITY = ("hash", "part", "nth")


def unit_ends(data: bytes) -> np.ndarray:
    """Where each unit (line) of a text ends, in bytes."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    return ends if not data or data.endswith(b"\n") else np.append(ends, len(data))


def plan(name: str, data: bytes, ends: np.ndarray, seed: int, rate: int, spm_rate: int) -> tuple[str, int, int]:
    """Form, and the bytes at which prefix and middle end."""
    digits = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not data or any(s in data for s in SENTINELS.values()) or h3 % 100 >= rate:
        return "plain", 0, 0
    a, b = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    at = [0, *ends[[x - 1 for x in (a, b) if x]].tolist()]
    return ("spm" if h4 % 100 < spm_rate else "psm"), at[-2] if a else 0, at[-1] if b else 0


def chunks(data: bytes, ends: np.ndarray, lo: int, hi: int, size: int) -> Iterator[bytes]:
    """Bytes ``lo`` to ``hi`` as runs of whole units of at most ``size`` bytes, and
    the parts of longer units."""
    while lo < hi:
        to = min(hi, lo + size)
        if to < hi:
            k = int(np.searchsorted(ends, to, "right"))
            to = int(ends[k - 1]) if k and ends[k - 1] > lo else to
        yield data[lo:to]
        lo = to


_FIELDS = [("hash", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()), ("section", pa.int32()), ("pos", pa.int64()),
           ("body", pa.binary()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
           ("middle_chars", pa.int64()), ("output_sha256", pa.string())]
_DDL = ("hash long, part int, nth long, section int, pos long, body binary, n long, form string, prefix_chars long, "
        "middle_chars long, output_sha256 string")


def _batches(rows: Iterator[tuple], kind: pa.DataType, fields=None) -> Iterator[pa.RecordBatch]:
    """Rows (the key last) as record batches of a few MB."""
    fields = [*(fields or _FIELDS), ("key", kind)]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row[5] or b"") if len(fields) > 8 else 200
        if size > SENT_AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), fields, strict=True)],
                                             [n for n, _ in fields])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), fields, strict=True)],
                                         [n for n, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def output_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100,
                  spm_rate: int = 50, chunk: int = CHUNK) -> DataFrame:
    """The chunks of all outputs: ``hash``, ``part`` and ``nth`` tell the document,
    ``pos`` the place in its output, ``body`` the bytes.  Position -1 is a row with
    the document's units, form and character counts.  Dealt out by document and
    sorted by position within each partition."""
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"),
                       F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"),
                       F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("hash"), F.col(key).alias("key"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, kind = TaskContext.get().partitionId(), Counter(), None

        def pieces(batch: pa.RecordBatch) -> Iterator[tuple]:
            for data, name, code, own in _rows([batch]):
                seen[code] += 1
                ends = unit_ends(data)
                form, a, b = plan(name, data, ends, seed, rate, spm_rate)
                told = (None, None) if form == "plain" else (len(data[:a].decode()), len(data[a:b].decode()))
                yield code, part, seen[code], 0, HEADER, None, len(ends), form, *told, None, own
                places = {"prefix": (0, a), "middle": (a, b), "suffix": (b, len(data))}
                body = [p for s in ORDERS[form] for p in (SENTINELS[s], *chunks(data, ends, *places[s], chunk))]
                for pos, p in enumerate(body if form != "plain" else chunks(data, ends, 0, len(data), chunk)):
                    yield code, part, seen[code], 0, pos, p, None, None, None, None, None, None

        for batch in batches:
            kind = batch.schema.field("key").type
            for at in range(0, batch.num_rows, 200):
                yield from _batches(pieces(batch.slice(at, 200)), kind)

    kind = docs.schema[key].dataType.simpleString()
    made = rows.mapInArrow(cut, f"{_DDL}, key {kind}")
    return made.repartition(*IDENTITY).sortWithinPartitions(*IDENTITY, "pos")


def _read_outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each output, read in order, and the restored place of each chunk."""
    def rows(batch: pa.RecordBatch, state: dict) -> Iterator[tuple]:
        for row in _rows([batch]):
            code, part, nth, _, pos, body, *told, key = row
            if pos == HEADER:
                if state:
                    yield closing(state)
                state.update(of=(code, part, nth), told=told, key=key, sha=hashlib.sha256(), section=0, form=told[1])
                continue
            state["sha"].update(body)
            if state["form"] != "plain" and body in RESTORED:
                state["section"] = RESTORED[body]
            else:
                yield code, part, nth, state["section"], pos, body, None, None, None, None, None, None

    def closing(state: dict) -> tuple:
        return *state["of"], len(RESTORED), HEADER, None, *state["told"][:-1], state["sha"].hexdigest(), state["key"]

    state, kind = {}, None
    for batch in batches:
        kind = batch.schema.field("key").type
        yield from _batches(rows(batch, state), kind)
    if state:
        yield from _batches(iter([closing(state)]), kind)


def _read_restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each restored text, read in order; the description comes last."""
    fields = [*_FIELDS[6:], ("restored_sha256", pa.string())]
    sha = hashlib.sha256()

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        nonlocal sha
        for row in _rows([batch]):
            if row[4] != HEADER:
                sha.update(row[5])
            else:
                yield *row[6:11], sha.hexdigest(), row[11]
                sha = hashlib.sha256()

    for batch in batches:
        yield from _batches(rows(batch), batch.schema.field("key").type, fields)


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100,
              spm_rate: int = 50, chunk: int = CHUNK) -> DataFrame:
    """Per document: the key, units ``n``, ``form``, ``prefix_chars`` and
    ``middle_chars`` (null if plain), ``output_sha256`` and ``restored_sha256``."""
    kind = docs.schema[key].dataType.simpleString()
    read = output_pieces(docs, key, text, seed, rate, spm_rate, chunk).mapInArrow(_read_outputs, f"{_DDL}, key {kind}")
    told = read.sortWithinPartitions(*IDENTITY, "section", "pos").mapInArrow(
        _read_restored, f"n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
                        f"restored_sha256 string, key {kind}")
    return told.select(F.col("key").alias(key), "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                       "restored_sha256")


def outputs(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The outputs themselves: the key, ``form`` and ``output``, one row per document."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts() -> Iterator[tuple]:
            own, form, held = None, None, None
            for row in _rows(batches):
                if row[4] == HEADER:
                    if held is not None:
                        yield form, b"".join(held).decode(), own
                    own, form, held = row[11], row[7], []
                else:
                    held.append(row[5])
            if held is not None:
                yield form, b"".join(held).decode(), own
        for row in texts():
            yield pa.RecordBatch.from_arrays([pa.array([row[0]]), pa.array([row[1]]), pa.array([row[2]], arrow)],
                                             ["form", "output", "key"])

    from pyspark.sql.pandas.types import to_arrow_type
    arrow = to_arrow_type(docs.schema[key].dataType)
    kind = docs.schema[key].dataType.simpleString()
    made = output_pieces(docs, key, text, **options).mapInArrow(join, f"form string, output string, key {kind}")
    return made.select(F.col("key").alias(key), "form", "output")


def restored(output: str, form: str) -> str:
    """The text that an output was made from."""
    if form == "plain":
        return output
    first, middle = output.split("<M>")
    if form == "psm":
        prefix, suffix = first.removeprefix("<P>").split("<S>")
    else:
        suffix, prefix = first.removeprefix("<S>").split("<P>")
    return prefix + middle + suffix


def oracle_sql(seed: int = 7, rate: int = 100, spm_rate: int = 50) -> str:
    """DuckDB: whole texts by list functions."""
    group = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"
    return f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{seed}:' || CAST(doc_id AS VARCHAR)) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u FROM documents),
hashed AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, {group.format(1)} AS h1, {group.format(9)} AS h2, {group.format(17)} AS h3,
         {group.format(25)} AS h4 FROM cut),
placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {rate}
              THEN 'plain' WHEN h4 % 100 < {spm_rate} THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (
  SELECT *, coalesce(array_to_string(list_slice(u, 1, a), ''), '') AS p,
         coalesce(array_to_string(list_slice(u, a + 1, b), ''), '') AS m,
         coalesce(array_to_string(list_slice(u, b + 1, n), ''), '') AS s FROM placed)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts"""
