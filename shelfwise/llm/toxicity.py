"""Toxicity: FTRL-proximal logistic regression over hashed n-grams.

Features of a text, each present or absent: every word, its first four and
five letters, every pair of neighbouring words and every pair with one word
between them (skip-gram), hashed to ``BITS`` bits.  Words are runs of letters
and digits, A-Z folded to lower case, over the whole text.

Training (Follow The Regularised Leader, proximal form): each coordinate has
its own learning rate from the sum of its squared gradients, and L1 keeps
every coordinate at exactly zero until the evidence passes the threshold, so
the few weights left are small enough to broadcast (no more than the features
of the bounded sample that are in ``LEAST_DOCUMENTS`` documents of a shard).  Labelled rows are sampled by key hash to
about ``MAX_POSITIVE`` and ``MAX_NEGATIVE`` rows (the documented bound of the
fit), dealt into shards of about ``SHARD_ROWS``; each shard runs its own
learner and the weights are averaged (parameter mixing).  Scoring covers every
row and every word.

Defined results: null or empty text scores the intercept alone; a key with
several labels is positive if one of them is 1; null labels and keys train
nothing; with no label of one class the score is the share of positives (0 if
there is no label at all); repeated rows score alike.  Extra columns pass
through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, free_name, sliced

BITS = 32
LEAST_DOCUMENTS = 3  # sampled documents of a shard that a feature must be in to be learnt
MAX_POSITIVE = 8_000
MAX_NEGATIVE = 12_000
SHARD_ROWS = 4_096
CHUNK = 1 << 18

ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 7.0, 0.0, 4

_FNV = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.zeros(256, np.uint8)  # a byte's folded value in a word, or 0 between words
_WORD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_WORD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_WORD[ord("0"):ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_WORD[0x80:] = np.arange(0x80, 0x100)


def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text in pieces cut at blanks, so that no word is split."""
    at = 0
    while len(data) - at > 2 * CHUNK:
        cut = data.find(b" ", at + CHUNK)
        cut = len(data) if cut < 0 else cut
        yield data[at:cut]
        at = cut
    yield data[at:]


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: the hash of all its bytes, of the first four and five, and
    the position of its first byte."""
    b = np.frombuffer(data, np.uint8)
    w = _WORD[b]
    inside = w != 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        none = np.zeros(0, np.uint64)
        return none, none, none, np.zeros(0, np.int64)
    length = last - first
    # a word's hash: sum of its bytes times powers of an odd number, by position in the word
    place = np.arange(len(b), dtype=np.int64)
    place[first[0]:] -= np.repeat(first, np.diff(np.append(first, len(b))))
    power = _powers(int(length.max()))
    values = w.astype(np.uint64) * np.where(inside, power[np.minimum(place, len(power) - 1)], np.uint64(0))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    whole = run[last] - run[first]
    four = run[np.minimum(first + 4, last)] - run[first]
    five = run[np.minimum(first + 5, last)] - run[first]
    return whole, four, five, first


def _powers(n: int) -> np.ndarray:
    p = np.full(n + 1, _FNV, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def _place(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h ^ np.uint64(kind)) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _documents(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of features: (index of the text, place of the feature)."""
    def features(whole, four, five, owner):
        yield owner, _place(whole, 1)
        yield owner, _place(four, 2)
        yield owner, _place(five, 3)
        for gap, kind in ((1, 4), (2, 5)):
            same = owner[gap:] == owner[:-gap] if len(owner) > gap else np.zeros(0, bool)
            if same.any():
                pair = whole[:-gap] * np.uint64(0xD6E8FEB86659FD93) + whole[gap:]
                yield owner[gap:][same], _place(pair[same], kind)

    held, size, start = [], 0, 0

    def flush():
        data = b"\n".join(held)
        ends = np.cumsum([len(x) + 1 for x in held])
        whole, four, five, first = _word_hashes(data)
        return features(whole, four, five, start + np.searchsorted(ends, first, side="right"))

    for i, t in enumerate(texts):
        data = (t or "").encode("utf-8", "replace")
        if len(data) > 2 * CHUNK:  # by itself: word hashes piece by piece, n-grams over all of them
            if held:
                yield from flush()
            parts = [_word_hashes(p)[:3] for p in _pieces(data)]
            whole, four, five = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield from features(whole, four, five, np.full(len(whole), i, np.int64))
            held, size, start = [], 0, i + 1
            continue
        if held and size + len(data) > CHUNK:
            yield from flush()
            held, size, start = [], 0, i
        held.append(data)
        size += len(data)
    if held:
        yield from flush()


def feature_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct features of each text."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for owner, place in _documents(texts):
        both = np.unique((owner.astype(np.int64) << BITS) | place)
        who = both >> BITS
        cuts = np.flatnonzero(np.diff(who)) + 1
        for part in np.split(both, cuts):
            if len(part):
                out[int(part[0] >> BITS)].append(part & ((1 << BITS) - 1))
    return [np.unique(np.concatenate(x)) if x else np.zeros(0, np.int64) for x in out]


class Ftrl:
    """The learner of one shard: coordinates 0 to ``size`` - 1 and, after them,
    the intercept."""

    def __init__(self, size: int):
        self.size = size
        self.z = np.zeros(size + 1)
        self.n = np.zeros(size + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == self.size, 0.0, L1)  # the intercept is not penalised
        w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, features: np.ndarray, label: int) -> None:
        at = np.append(features, self.size)
        w = self.weights(at)
        g = 1 / (1 + math.exp(-max(min(w.sum(), 35.0), -35.0))) - label
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def _shared_places(features: list[np.ndarray]) -> np.ndarray:
    """The features, sorted, that are in LEAST_DOCUMENTS documents; each has a feature
    once.  One sorted copy of all is made and no count per feature."""
    every = np.concatenate(features)
    every.sort()
    later = every[LEAST_DOCUMENTS - 1:]
    return np.unique(later[later == every[:len(later)]])


def _learn_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("turn", kind="stable")
    labels = pdf["label"].tolist()
    features = [np.asarray(x, np.int32) for x in pdf["features"]]
    places = _shared_places(features)
    known = []
    for f in features:
        at = np.minimum(np.searchsorted(places, f), max(0, len(places) - 1)).astype(np.int32)
        known.append(at[places[at] == f] if len(places) else at[:0])
    learner = Ftrl(len(places))
    for _ in range(EPOCHS):
        for f, y in zip(known, labels, strict=True):
            learner.learn(f, y)
    w = learner.weights(np.arange(len(places) + 1))
    some = np.flatnonzero(w[:-1])
    # the intercept has no place
    return pd.DataFrame({"place": [*places[some].tolist(), None], "weight": [*w[some], w[-1]]}).astype({"place": "Int64"})


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """``docs(key, text)``, ``labels(key, label)`` to (places, weights, intercept)."""
    labels = (labels.where("key IS NOT NULL AND label IS NOT NULL")
              .groupBy("key").agg(F.max(F.expr("int(label = 1)")).alias("label")))
    n = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        share = pos / max(1, pos + neg)
        return np.zeros(0, np.int64), np.zeros(0), math.log((share + 1e-9) / (1 - share + 1e-9))
    keep = [min(1.0, MAX_NEGATIVE / neg), min(1.0, MAX_POSITIVE / pos)]
    turn = F.shiftrightunsigned(F.xxhash64("key"), 1)
    chosen = (labels.withColumn("turn", turn)
              .where(F.col("turn") / float(1 << 63) <= F.when(F.col("label") == 1, keep[1]).otherwise(keep[0])))
    shards = max(1, math.ceil((pos * keep[1] + neg * keep[0]) / SHARD_ROWS))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            found = feature_sets(part.column("text").to_pylist())
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int64), *found]).astype(np.uint32).view(np.int32))
            shard = part.column("turn").to_numpy() // 7 % shards
            yield pa.RecordBatch.from_arrays([pa.array(shard), part.column("turn"), part.column("label"), lists],
                                             ["shard", "turn", "label", "features"])

    rows = (_one_of_each_key(docs, chosen)
            .mapInArrow(features, "shard long, turn long, label int, features array<int>"))
    learned = rows.groupBy("shard").applyInPandas(_learn_shard, "place long, weight double")
    got = learned.groupBy("place").agg((F.sum("weight") / shards).alias("weight")).toPandas()
    intercept = float(got.loc[got["place"].isna(), "weight"].sum())
    got = got[got["place"].notna()]
    places = got["place"].to_numpy(np.int64) & ((1 << BITS) - 1)
    order = np.argsort(places)
    # the classes were sampled at different rates: move the intercept back to the true odds
    return places[order], got["weight"].to_numpy(float)[order], intercept + math.log(keep[0] / keep[1])


def _one_of_each_key(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One document of each chosen key, that with the least hash of its text; a key
    of very many rows is reduced where these are read."""
    # the sample has MAX_POSITIVE + MAX_NEGATIVE rows of three numbers at most, in expectation
    return (docs.join(F.broadcast(chosen), "key").groupBy("key", "turn", "label")
            .agg(F.min_by("text", F.xxhash64("text")).alias("text")))


def predictor(spark, model):
    """A column function: text to the probability of label 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        places, weights, intercept = shared.value
        sieve = np.zeros(1 << 20, bool)  # most features have no weight: their low bits tell
        sieve[places & ((1 << 20) - 1)] = True
        for texts in sliced(batches):
            hits = []
            for owner, place in _documents(texts.to_pylist()):
                some = np.flatnonzero(sieve[place & ((1 << 20) - 1)])
                if len(some):
                    at = np.minimum(np.searchsorted(places, place[some]), len(places) - 1)
                    ok = places[at] == place[some]
                    hits.append(np.unique(owner[some][ok] * len(places) + at[ok]))
            total = np.full(len(texts), intercept)
            if hits:
                both = np.unique(np.concatenate(hits))
                np.add.at(total, both // len(places), weights[both % len(places)])
            yield pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))

    return predict


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic") -> DataFrame:
    """``docs`` plus ``toxicity`` (0 to 1) and ``held_out``.

    Learns labels only from rows whose crc32(key as text) mod 5 is not 0;
    labels and key are never inputs of a score.
    """
    own = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).where(fold("key", 5) != 0)
    model = train(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), own)
    predict = predictor(docs.sparkSession, model)
    return docs.withColumns({free_name(docs, "toxicity"): predict(F.col(text)),
                             free_name(docs, "held_out"): F.coalesce(fold(key, 5) == 0, F.lit(False))})
