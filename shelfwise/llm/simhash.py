"""SimHash near-duplicates: fingerprints linked through BK-trees.

Fingerprint: A-Z folded to lower case, words ``[^\\x20\\x09-\\x0D]+``, every
shingle of ``words`` neighbouring words (repeats included, joined by one
space; a shorter text is one shingle), XXH64 with seed 42 of its UTF-8 bytes; a
bit is 1 if it is set in over half of the hashes.  No word: fingerprint zero.

Linking, exact for every pair within ``radius`` bits:

1.  Equal fingerprints collapse to one row first, so a group of copies of any
    size costs one row from there on.
2.  The 64 bits are cut into ``radius + 1`` blocks.  Two fingerprints within
    the radius agree on one block at least, so each (block, value) is a shard
    of the search and every close pair meets in some shard.
3.  A shard above ``SHARD_LIMIT`` fingerprints is dealt again by the bits that
    are left: its members agree on the block, so the same holds for those, cut
    into ``radius + 1`` blocks once more.  What is large even then (a dense
    ball of different fingerprints) is cut into parts of bounded size, and
    every two parts make a shard: no pair is missed.
4.  In each shard a BK-tree is built: the children of a node are keyed by
    their Hamming distance to it, and a search within the radius follows only
    the edges from d - radius to d + radius.  Trees of one partition grow and
    are searched level by level together; each shard tree is at hand only in
    the task that its own queries are dealt to, and its size is bounded.
5.  A shard returns a spanning forest, one link per member at most, never the
    pairs; connected components join the forests.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; repeated rows and ids share a component; the component id is
the smallest non-null id reachable (null if there is none); an empty table
gives no row.  Extra columns pass through ``near_duplicates``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, written
from .components import connected_components

WORDS = 4
RADIUS = 4
SEED = 42
SHARD_LIMIT = 2_048
LEVELS = 2  # times that a shard is dealt by blocks before it is cut into parts
FRONTIER = 1 << 18  # (query, node) pairs looked at together

_SPACE = re.compile(rb"[\x20\x09-\x0D]+")
_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, words: int = WORDS) -> int:
    found = [w for w in _SPACE.split((text or "").encode("utf-8", "replace").translate(_FOLD)) if w]
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
        return _majority(hashes[None, :].view(np.uint8), 1)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = (ends - np.array([len(w) + 1 for w in found])).tolist()
    ends = (ends - 1).tolist()
    view, digest = joined, xxhash.xxh64_intdigest
    n = len(found) - words + 1
    hashes = np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts[:n], ends[words - 1:], strict=True)),
                         np.uint64, n)
    return _majority(hashes.view(np.uint8).reshape(n, 8), n)


def _majority(rows: np.ndarray, n: int) -> int:
    """Bits set in over half of n little-endian 64-bit hashes."""
    rows = rows.reshape(n, 8)
    total = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(rows[at:at + (1 << 16)], axis=1, bitorder="little")
        pad = -len(bits) % 255
        if pad:
            bits = np.concatenate([bits, np.zeros((pad, 64), np.uint8)])
        total += bits.reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_column(words: int = WORDS):
    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            made = np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts))
            yield pd.Series(made.view(np.int64))

    return fingerprints


def _blocks(lo_bits: list[tuple[int, int]], parts: int) -> list[list[tuple[int, int]]]:
    """Cut the bits in the ranges [(first, count)] into ``parts`` nearly equal blocks of ranges."""
    bits = [b for first, n in lo_bits for b in range(first, first + n)]
    out = []
    for i in range(parts):
        own = bits[len(bits) * i // parts:len(bits) * (i + 1) // parts]
        ranges: list[tuple[int, int]] = []
        for b in own:
            if ranges and ranges[-1][0] + ranges[-1][1] == b:
                ranges[-1] = (ranges[-1][0], ranges[-1][1] + 1)
            else:
                ranges.append((b, 1))
        out.append(ranges)
    return out


def _mask(ranges: list[tuple[int, int]]) -> int:
    m = sum(((1 << n) - 1) << first for first, n in ranges)
    return m - (1 << 64) if m >> 63 else m


def _deal(left: list[tuple[int, int]], radius: int, path: str) -> list[tuple[str, int, list]]:
    """Per block of the bits left: the block's name, its mask, the bits then left."""
    blocks = _blocks(left, radius + 1)
    return [(f"{path}{i}", _mask(own), sorted(r for k, other in enumerate(blocks) if k != i for r in other))
            for i, own in enumerate(blocks)]


def links(fps: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """``fps(fp)``, distinct, to links ``(a, b)`` whose components are those of
    all pairs within the radius."""
    spark = fps.sparkSession
    todo = fps.select("fp", F.lit("").alias("path"), F.lit(0).cast("long").alias("agreed"))
    ready, lefts = [], {"": [(0, 64)]}
    for level in range(LEVELS):
        made = {path: _deal(left, radius, path) for path, left in lefts.items()}
        masks = spark.createDataFrame([(path, name, mask) for path, own in made.items() for name, mask, _ in own],
                                      "path string, block string, mask long")
        # a row per block name: (radius + 1) ** LEVELS at most
        dealt = written(todo.join(F.broadcast(masks), "path").select(
            "fp", F.col("block").alias("path"),
            F.col("agreed").bitwiseOR(F.col("fp").bitwiseAND(F.col("mask"))).alias("agreed")), "simhash-shards")
        large = written(dealt.groupBy("path", "agreed").agg(F.count("*").alias("n")).where(F.col("n") > limit),
                        "simhash-large")
        ready.append(dealt.join(large, ["path", "agreed"], "left_anti"))
        todo = dealt.join(large, ["path", "agreed"])
        if level < LEVELS - 1:
            todo = todo.drop("n")
            names = {r["path"] for r in large.select("path").distinct().collect()}  # block names
            lefts = {name: rest for own in made.values() for name, _, rest in own if name in names}
            if not lefts:
                break
    else:
        # still large: parts of at most ``limit`` members; every two parts make a shard
        parts = F.ceil(F.col("n") / limit).cast("int")
        tiles = (todo.withColumn("parts", parts)
                 .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("part <> other"))
        ready.append(tiles.select("fp", F.concat_ws("-", "path", F.least("part", "other"), F.greatest("part", "other"))
                                  .alias("path"), "agreed"))
    shards = reduce(DataFrame.unionByName, ready)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard, fp in _whole_shards(batches):
            a, b = forest(shard, fp, radius)
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    spread = (shards.withColumn("shard", F.xxhash64("path", "agreed"))
              .repartition("shard").sortWithinPartitions("shard", "path", "agreed", "fp"))
    return spread.select("path", "agreed", "fp").mapInPandas(search, "a long, b long").distinct()


def _whole_shards(batches: Iterator[pd.DataFrame], rows: int = 1 << 17):
    """Batches of sorted rows, cut where a shard ends: (shard number, fingerprints)."""
    held: list[pd.DataFrame] = []
    size = 0

    def numbered(pdf):
        new = (pdf["path"].ne(pdf["path"].shift()) | pdf["agreed"].ne(pdf["agreed"].shift())).to_numpy()
        return np.cumsum(new) - 1, pdf["fp"].to_numpy(np.int64).view(np.uint64)

    for pdf in batches:
        held.append(pdf)
        size += len(pdf)
        if size >= rows:
            all_rows = pd.concat(held, ignore_index=True)
            last = all_rows.iloc[-1]
            ends = ((all_rows["path"] == last["path"]) & (all_rows["agreed"] == last["agreed"])).to_numpy()
            cut = len(all_rows) - int(ends.sum())
            if cut:
                yield numbered(all_rows.iloc[:cut].reset_index(drop=True))
            held = [all_rows.iloc[cut:]]
            size = len(held[0])
    if size:
        yield numbered(pd.concat(held, ignore_index=True))


class BkForest:
    """One BK-tree per shard, as arrays: a node's fingerprint and its children
    by distance, kept as a sorted list of (node, distance) keys."""

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        self.fp = fp
        n = len(fp)
        parents, distances, children = [], [], []
        roots = np.flatnonzero(np.diff(shard, prepend=-1))
        self.root = np.repeat(roots, np.diff(np.append(roots, n)))  # of each member
        at = self.root.copy()  # the node that each member has come down to
        pending = np.flatnonzero(at != np.arange(n))
        while len(pending):
            d = np.bitwise_count(fp[pending] ^ fp[at[pending]]).astype(np.int64)
            edge = at[pending] * 65 + d
            _, first, group = np.unique(edge, return_index=True, return_inverse=True)
            child = pending[first]  # the first to come along an edge becomes the node at its end
            parents.append(at[child])
            distances.append(d[first])
            children.append(child)
            at[pending] = child[group]
            pending = pending[at[pending] != pending]
        none = np.zeros(0, np.int64)
        edge = np.concatenate(parents or [none]) * 65 + np.concatenate(distances or [none])
        order = np.argsort(edge)
        self.edge, self.child = edge[order], np.concatenate(children or [none])[order]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(member, node) pairs within the radius, node by node down the trees."""
        stack = [(queries, self.root[queries])]
        while stack:
            q, node = stack.pop()
            if len(q) > FRONTIER:
                stack.append((q[FRONTIER:], node[FRONTIER:]))
                q, node = q[:FRONTIER], node[:FRONTIER]
            d = np.bitwise_count(self.fp[q] ^ self.fp[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield q[near], node[near]
            first = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0), side="left")
            last = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), side="right")
            count = last - first
            if count.any():
                take = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
                stack.append((np.repeat(q, count), self.child[take]))


def forest(shard: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member of its component in the shard)."""
    tree = BkForest(shard, fp)
    label = np.arange(len(fp))
    block = 1 << 14
    for at in range(0, len(fp), block):
        for q, node in tree.within(np.arange(at, min(at + block, len(fp))), radius):
            _unite(label, q, node)
    label = _flat(label)
    low = np.full(len(fp), np.uint64((1 << 64) - 1))
    np.minimum.at(low, label, fp)
    some = low[label] != fp
    return fp[some], low[label][some]


def _flat(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if (up == label).all():
            return label
        label[:] = up


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the classes of a[i] and b[i]; a class is named by its smallest index."""
    while True:
        _flat(label)
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        x, y = x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))


def _grouped(docs: DataFrame, key: str, text: str, words: int, radius: int) -> DataFrame:
    """One row per input row: key, digest of the text, fp, component_id."""
    rows = written(docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("digest"),
                               fingerprint_column(words)(F.col(text)).alias("fp")), "simhash-fingerprints")
    lowest = written(rows.groupBy("fp").agg(F.min("key").alias("low")), "simhash-distinct")
    found = connected_components(written(links(lowest.select("fp"), radius), "simhash-links"))
    groups = (lowest.join(found, lowest.fp == found.node, "left")
              .select("fp", "low", F.coalesce("component", "fp").alias("component")))
    named = groups.groupBy("component").agg(F.min("low").alias("component_id"))
    by_fp = groups.join(named, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                    radius: int = RADIUS) -> DataFrame:
    """One row per input row: ``key``, ``fp`` (long) and ``component_id``."""
    return _grouped(docs, key, text, words, radius).select(F.col("key").alias(key), "fp", "component_id")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` whose key names their component: one document of each
    group stays.  Of repeated rows of that key one stays, and if its texts differ
    one that is in the group; rows with a null key, which nothing tells apart, all
    stay."""
    found = _grouped(docs, key, text, words, radius).where("key = component_id")
    mark, digest = free_name(docs, "_kept"), free_name(docs, "_digest")
    keep = found.groupBy("key").agg(F.min("digest").alias("digest")).select(F.col("key").alias(mark), F.col("digest").alias("d"))
    rows = docs.withColumn(digest, F.xxhash64(text))
    own = rows.join(keep, (rows[key] == keep[mark]) & (rows[digest] == keep["d"]), "left_semi")
    own = own.dropDuplicates([key, digest]).drop(digest)
    return own.union(docs.where(F.col(key).isNull()))
