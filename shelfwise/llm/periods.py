"""Periodic runs of words: maximal stretches that repeat with a period, found on
a grammar.

A run of period q is a stretch of words in which words q apart are equal, of at
least twice q and at least ``LEAST`` words, that no neighbouring word extends,
and q is the smallest period of the stretch.

Documents are taken in batches; words become numbers that differ between
documents.  First a sieve: a run holds no word that is there once, and at most one
joint of two words whose pair is there once (the middle of an exact square), so
stretches between such joints that are too short with both their neighbours
cannot hold one.  What is left is compressed by Re-Pair, in rounds: the most
frequent pairs (those of more than half the highest count of their stretch) become
nonterminals, leftmost first within a repeated symbol and by a fixed order of the
pairs where they overlap, until no pair of neighbours occurs twice.  What a
document keeps at the top level is joined by a balanced tree.  A run crosses the
boundary of the smallest node that holds it, so for each nonterminal the runs
that cross its one boundary are computed once, from its first place in the text,
and carried to all places that derive it; the nodes of the tree have one place.
Per boundary, the periods that the words beside it allow are tested by the number
of equal words to both sides.  A carried stretch that goes on beyond its
nonterminal is part of a longer one found higher up, and is merged into that; of
equal stretches the smallest period stays.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined results: a null or empty text, or one of
blanks, has no words, no runs and the empty collapsed text; null and repeated keys
pass through; an empty table gives no row; extra columns are not read.  Texts of
any length are used whole; the memory of a task follows its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_runs

LEAST = 12
AT_ONCE = 3 << 20  # characters
TRIED_AT_ONCE = 1 << 21  # boundaries times periods

Node = tuple[np.ndarray, np.ndarray, np.ndarray]  # starts, middles, ends


def numbered(words: list[bytes], base: int) -> np.ndarray:
    """Equal words get equal numbers, from ``base`` on."""
    last = dict(zip(words, range(base, base + len(words)), strict=True))
    return np.fromiter(map(last.__getitem__, words), np.int64, len(words))


def _pair_counts(left: np.ndarray, right: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Per pair a number of its kind, and per kind how often it occurs."""
    _, kind, count = np.unique(left * span + right, return_inverse=True, return_counts=True)
    return kind, count


def sieve(w: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that may hold runs; ``starts`` are the
    documents' beginnings."""
    n = len(w)
    often = np.bincount(w, minlength=n)[w] > 1
    both = np.flatnonzero(often[:-1] & often[1:])
    holds = np.zeros(max(n - 1, 0), bool)  # the joint after a word: its pair occurs again
    if len(both):
        kind, count = _pair_counts(w[both], w[both + 1], n)
        holds[both] = count[kind] > 1
    first = np.concatenate([[0], np.flatnonzero(~holds) + 1])  # of each block
    size = np.diff(np.append(first, n))
    new = np.isin(first, starts)  # such a block cannot go with the one before
    before = np.where(new, 0, np.concatenate([[0], size[:-1]]))
    after = np.concatenate([np.where(new[1:], 0, size[1:]), [0]])
    keep = size + np.maximum(before, after) >= least
    opens = keep & (new | ~np.concatenate([[False], keep[:-1]]))
    closes = keep & np.concatenate([new[1:] | ~keep[1:], [True]])
    return first[opens], (first + size)[closes]


def repair(w: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: int) -> tuple[list[tuple], tuple]:
    """Re-Pair of the stretches ``lo`` to ``hi``.  Returns the nonterminals of at
    least ``least`` words as (start, middle, end, other starts) and the top level:
    stretch, start and end of each symbol."""
    size = hi - lo
    owner = np.repeat(np.arange(len(lo)), size)
    start = np.arange(size.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    length = np.ones(len(start), np.int64)
    symbol, new = w[start], int(w.max(initial=0)) + 1
    live = np.ones(len(symbol), bool)  # the joint after a symbol may be of a repeated pair
    rules = []
    while len(symbol) > 1:
        at = np.flatnonzero(live[:-1] & (owner[:-1] == owner[1:]))
        if not len(at):
            break
        kind, count = _pair_counts(symbol[at], symbol[at + 1], new)
        held = count[kind] > 1
        live[:] = False
        live[at[held]] = True
        at, kind = at[held], kind[held]
        if not len(at):
            break
        often = count[kind]
        top = np.zeros(len(lo), np.int64)
        np.maximum.at(top, owner[at], often)
        chosen = 2 * often > top[owner[at]]
        # where chosen pairs overlap the higher one goes first: by count, then by a fixed mixing of the kind
        rank = np.full(len(symbol) + 1, -1, np.int64)
        mixed = (kind.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)).astype(np.int64)
        rank[at[chosen] + 1] = (np.minimum(often[chosen], 1 << 21) << 40) | mixed[chosen]
        code = np.full(len(symbol) + 1, -1, np.int64)
        code[at[chosen] + 1] = kind[chosen]
        here, before, after = at[chosen] + 1, at[chosen], np.minimum(at[chosen] + 2, len(symbol))
        same = code[before] == code[here]  # x x x: every second joint, from the left
        wins = ((rank[here] > rank[before]) | same) & ((rank[here] > rank[after]) | (code[after] == code[here]))
        run = np.cumsum(~same)
        first = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
        step = np.arange(len(here)) - np.repeat(first, np.diff(np.append(first, len(here))))
        ok = np.repeat(np.logical_and.reduceat(wins, first), np.diff(np.append(first, len(here))))
        take = ok & (step % 2 == 0)
        j, of = here[take] - 1, code[here[take]]
        if not len(j):
            raise AssertionError("the highest pair always wins")
        kinds, number = np.unique(of, return_inverse=True)
        order = np.argsort(number, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(number[order])) + 1)
        whole = length[j] + length[j + 1]
        for g in groups if (whole >= least).any() else ():
            k = j[g[0]]
            if whole[g[0]] >= least:
                rules.append((start[k], start[k + 1], start[k] + whole[g[0]], start[j[g]]))
        symbol[j], length[j] = new + number, whole
        new += len(kinds)
        keep = np.ones(len(symbol), bool)
        keep[j + 1] = False
        live[j] = live[j + 1] = True
        live[np.maximum(j - 1, 0)] = True
        symbol, length, start, owner, live = (x[keep] for x in (symbol, length, start, owner, live))
    return rules, (owner, start, start + length)


def tree(owner: np.ndarray, start: np.ndarray, end: np.ndarray, least: int) -> Node:
    """Nodes of a balanced tree over the top-level symbols of each stretch."""
    nodes = []
    while len(owner) > 1:
        opens = np.concatenate([[True], owner[1:] != owner[:-1]])
        first = np.flatnonzero(opens)
        step = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        left = np.flatnonzero((step[:-1] % 2 == 0) & ~opens[1:])
        if not len(left):
            break
        nodes.append((start[left], start[left + 1], end[left + 1]))
        end = end.copy()
        end[left] = end[left + 1]
        keep = np.ones(len(owner), bool)
        keep[left + 1] = False
        owner, start, end = owner[keep], start[keep], end[keep]
    joined = [np.concatenate(x) for x in zip(*nodes, strict=True)] if nodes else [np.zeros(0, np.int64)] * 3
    wide = joined[2] - joined[0] >= least
    return tuple(x[wide] for x in joined)


def _equal_words(w: np.ndarray, a: int, b: int, most: int) -> int:
    """How many words from ``a`` on equal those from ``b`` on, ``most`` at most."""
    n, block = 0, 32
    while n < most:
        k = min(block, most - n)
        differs = w[a + n:a + n + k] != w[b + n:b + n + k]
        at = int(differs.argmax())
        if differs[at]:
            return n + at
        n, block = n + k, min(2 * block, 1 << 16)
    return n


def _candidates(w: np.ndarray, nodes: Node, least: int) -> Iterator[tuple[int, int]]:
    """(node, period) where the words beside the node's boundary allow the period,
    by node and then by period."""
    starts, mids, ends = nodes
    half = (ends - starts) // 2
    sides = np.minimum(mids - starts, half), np.minimum(ends - mids, half)
    tried = sides[0] + sides[1]
    need = (least + 1) // 2  # a run of least words has so many words that equal the one a period on
    lo = 0
    while lo < len(mids):
        hi = max(lo + 1, int(np.searchsorted(np.cumsum(tried[lo:]), TRIED_AT_ONCE, "right")) + lo)
        found = []
        for side, most in enumerate(sides):
            count = most[lo:hi]
            node = np.repeat(np.arange(lo, hi), count)
            q = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + 1
            # left: the word after the boundary equals that q before; right: the word before it equals that q on
            x = mids[node] - q if side == 0 else mids[node] - 1
            near = w[x] == w[x + q]
            node, q, x = node[near], q[near], x[near]
            equal, open_ = np.ones(len(x), np.int64), np.ones(len(x), bool)
            for t in range(1, need):  # onward
                open_ = open_ & (x + q + t < ends[node])
                open_[open_] = w[x[open_] + t] == w[x[open_] + q[open_] + t]
                equal += open_
            open_ = np.ones(len(x), bool)
            for t in range(1, need):  # and back
                open_ = open_ & (x - t >= starts[node]) & (equal < need)
                open_[open_] = w[x[open_] - t] == w[x[open_] + q[open_] - t]
                equal += open_
            ok = equal >= need
            found.append((node[ok], q[ok]))
        node, q = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((q, node))
        node, q = node[order], q[order]
        once = np.ones(len(q), bool)
        once[1:] = (node[1:] != node[:-1]) | (q[1:] != q[:-1])
        yield from zip(node[once].tolist(), q[once].tolist(), strict=True)
        lo = hi


def crossing(w: np.ndarray, back: np.ndarray, nodes: Node, least: int) -> list[tuple[int, int, int, int]]:
    """(node, start, end, period) of the stretches that cross a node's boundary,
    within the node.  ``back`` is ``w`` reversed."""
    starts, mids, ends = nodes
    out, at, held = [], -1, []
    n = len(w)
    for node, q in _candidates(w, nodes, least):
        lo, mid, hi = int(starts[node]), int(mids[node]), int(ends[node])
        if node != at:
            at, held = node, []
        for x in (mid - q, mid - 1):  # a word of the left and one of the right half, each with the one q on
            if x < lo or x + q >= hi or w[x] != w[x + q]:
                continue
            # a multiple of a period found here gives the same stretch again
            if any(q % p == 0 and s <= x and x + q < e for s, e, p in held):
                continue
            e = x + q + _equal_words(w, x, x + q, hi - x - q)
            s = x - _equal_words(back, n - x, n - x - q, x - lo)
            if e - s >= max(least, 2 * q) and s < mid < e:
                held.append((s, e, q))
                out.append((node, s, e, q))
    return out


def find_runs(texts: list[list[bytes]], least: int = LEAST) -> list[np.ndarray]:
    """Per text its runs as rows (start, length, period), by start and period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])
    none = np.zeros((0, 3), np.int64)
    if base[-1] < least:
        return [none] * len(texts)
    w = np.concatenate([numbered(t, int(b)) for t, b in zip(texts, base[:-1], strict=True)])
    lo, hi = sieve(w, base[:-1][sizes > 0], least)
    if not len(lo):
        return [none] * len(texts)
    rules, top = repair(w, lo, hi, least)
    back = w[::-1].copy()
    found = [(s, e, q) for _, s, e, q in crossing(w, back, tree(*top, least), least)]
    if rules:
        nodes = tuple(np.array([r[i] for r in rules], np.int64) for i in range(3))
        for node, s, e, q in crossing(w, back, nodes, least):
            first, _, _, places = rules[node]
            found += [(s - first + p, e - first + p, q) for p in places.tolist()]
    s, e, q = np.array(sorted(set(found)), np.int64).reshape(-1, 3).T
    # what goes on beyond its node is part of a longer stretch
    edge = np.concatenate([w, [-1]])  # the word before the first is the last of these
    whole = (edge[s - 1] != edge[s - 1 + q]) & (edge[e] != edge[e - q])
    s, e, q = s[whole], e[whole], q[whole]
    first = np.ones(len(s), bool)  # sorted by start, end, period
    first[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[first], e[first], q[first]
    order = np.lexsort((q, s))
    s, e, q = s[order], e[order], q[order]
    cuts = np.searchsorted(s, base)
    return [np.stack([s[a:b] - o, e[a:b] - s[a:b], q[a:b]], 1)
            for a, b, o in zip(cuts[:-1], cuts[1:], base[:-1], strict=True)]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words but for those that a run holds after its first period."""
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str | Column = "text", least: int = LEAST) -> DataFrame:
    """Per document: the key, ``n_words``, ``runs`` (start, length, period) by start
    and period, and the ``collapsed`` text."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text) if isinstance(text, str) else text,
                                                           F.lit("")).cast("binary").alias("data"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("data").to_pylist()
            for a, b in text_runs(data, AT_ONCE):
                words = [d.split() for d in data[a:b]]  # bytes split at ASCII white space only
                found = find_runs(words, least)
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in found])]), pa.int32())
                flat = np.concatenate(found)
                struct = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(a, b - a), pa.array([len(x) for x in words], pa.int64()),
                     pa.ListArray.from_arrays(offsets, struct),
                     pa.array([collapsed(x, r).decode() for x, r in zip(words, found, strict=True)], pa.string())],
                    [key, "n_words", "runs", "collapsed"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(search, f"`{key}` {kind}, n_words long, runs array<struct<start: long, length: long, "
                                   "period: long>>, collapsed string")


def planted(key: Column, text: Column) -> Column:
    """The text with a period planted by rule: let h be the CRC-32 of the key and g
    its tenth; of every tenth h the words from g % n on repeat the first 1 + (n -
    g % n) / (3 + g % 8) of them."""
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.element_at(
            words, (F.when(i < a, i).otherwise(a + F.pmod(i - a, p)) + 1).cast("int"))), " ")

    # bound as a lambda's argument, the words are made once
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeat(w)).otherwise(F.lit("")))[0]
    return F.when(h % 10 == 0, made).otherwise(text)
