"""Language identification with interpolated Kneser-Ney character models.

One model per label of the training rows.  Texts are reduced to lower-case
letters and single blanks; every position gives one 4-gram of symbols, packed
into a 64-bit key.  A symbol is the letter's code point, so no two letters of
the basic plane are the same; letters beyond it share the codes of surrogates
and private use, which no letter has.  Spark counts (language, key) over *all* training rows and
derives the continuation counts of the lower orders from the distinct grams,
so the statistics follow the whole corpus.

Storage: for each order the sorted grams and contexts that occur, by their full
keys, with one column of numbers per language; nothing is folded, so the model
grows with the distinct grams.  They are counted first: models of up to
``MODEL_BYTES`` are broadcast; a larger one stays in Spark tables, and the
distinct grams of the distinct texts are joined with it order by order.

Decision: the language with the lowest cross-entropy per symbol.  *All* training
rows calibrate (a) the effective length of the posterior that becomes ``score`` and
(b) per language the usual cross-entropy; a text far above it, or with a posterior
under MIN_SCORE, is rejected.  A row calibrates under a model that has not seen its
text: texts fall into two folds by their hash, and each fold is scored by the model
of the other one's counts.  So no row is kept from training: the queries train on all
of them.  ``identify`` by itself may hold back the rows of remainder 3 of small tables
(up to CALIBRATION_ROWS of them), which then calibrate under the final model.

Defined results: null text, empty text or no letter gives ``und``, score 0 and
rejected; ties go to the first language in code-point order; rows with a null
label train nothing; repeated rows train as often as they occur and calibrate once,
and a label whose texts all fall into one fold calibrates by held-back rows, if any;
with no training row at all every text is ``und``.  Extra columns pass through.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .common import fold, free_name, segment_sums, sliced, text_runs, written

ORDER = 4
SYMBOL_BITS = 16
MODEL_BYTES = 64 << 20  # larger models are not gathered
CALIBRATION_ROWS = 4_000  # up to so many rows of remainder 3 are held back from training
LENGTHS = (10.0, 20.0, 50.0, 100.0, 200.0, 500.0, 1000.0)  # effective lengths to choose from
CHUNK = 1 << 18
CACHE_BITS = 18
DEVIATIONS = 8.0  # cross-entropies this many deviations above the usual are rejected
MIN_SCORE = 0.35  # posteriors below are rejected
UNKNOWN = "und"

_BLANK = 32
_SPARE = (0xD800, 0xF900)  # codes in the basic plane that no letter has


@functools.cache
def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its symbol (blank for anything but letters and marks), and
    whether it is a letter."""
    symbol = np.full(0x110000, _BLANK, np.uint64)
    letter = np.zeros(0x110000, bool)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LM":
            low = chr(cp).lower()
            s = ord(low) if len(low) == 1 else cp
            symbol[cp] = s if s < 1 << SYMBOL_BITS else _SPARE[0] + s % (_SPARE[1] - _SPARE[0])
            letter[cp] = kind == "L"
    return symbol, letter


def _windows(texts: list[str]) -> Iterator[tuple[int, int, str]]:
    """Runs of texts to work on together; a text far above CHUNK comes in pieces,
    cut at a blank if there is one near: (index, start, piece)."""
    for a, b in text_runs(texts, CHUNK):
        if b - a == 1 and texts[a] and len(texts[a]) > 2 * CHUNK:
            text, at = texts[a], 0
            while at < len(text):
                cut = text.find(" ", at + CHUNK, at + 2 * CHUNK)
                cut = cut if cut > 0 else at + CHUNK
                yield a, at, text[at:cut]
                at = cut
        else:
            yield a, -1, texts[a:b]


def _keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 4-gram key at each symbol, the end position of each text among the
    keys, and the number of letters of each text."""
    symbol, letter = _symbols()
    joined = "\n".join(texts) + "\n"
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    letters = segment_sums(letter[cps].astype(np.int8), ends)
    s = symbol[cps]
    keep = np.empty(len(s), bool)
    keep[0] = True
    np.not_equal(s[1:], _BLANK, out=keep[1:])
    keep[1:] |= s[:-1] != _BLANK
    keep[0] = s[0] != _BLANK
    # a text of letters ends in exactly one blank; runs of blanks count once
    kept = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])
    s = s[keep]
    padded = np.concatenate([np.full(ORDER - 1, _BLANK, np.uint64), s])
    key = np.zeros(len(s), np.uint64)
    stops = kept[ends]
    starts = np.concatenate([np.zeros(1, np.int64), stops[:-1]])
    for i in range(ORDER):
        part = padded[i:i + len(s)].copy()
        for k in range(ORDER - 1 - i):  # before a text there are blanks, not the text before it
            part[(starts + k)[starts + k < stops]] = _BLANK
        key = (key << np.uint64(SYMBOL_BITS)) | part
    return key, stops, letters


def _suffix(order: int) -> int:
    return (1 << (SYMBOL_BITS * order)) - 1


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        keys = np.concatenate([k for k, _ in parts])
        counts = np.concatenate([c for _, c in parts])
        keys, at = np.unique(keys, return_inverse=True)
        return keys, np.bincount(at, counts, len(keys)).astype(np.int64)

    for part in sliced(batches, 2_000):
        for lang, group in part.to_pandas().groupby(["lang", "fold"]):
            for _, _, run in _windows(group["text"].tolist()):
                key, _, _ = _keys([run] if isinstance(run, str) else run)
                parts = held.setdefault(lang, [])
                parts.append(np.unique(key, return_counts=True))
                if len(parts) >= 8:
                    held[lang] = [merged(parts)]
    for (lang, fold), parts in held.items():
        keys, counts = merged(parts)
        for at in range(0, len(keys), 50_000):
            some = keys[at:at + 50_000].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(np.full(len(some), fold, np.int32)),
                 pa.array(some), pa.array(counts[at:at + 50_000])], ["lang", "fold", "gram", "n"])


@dataclass
class Model:
    """Per order the sorted grams and contexts, and per language the discounted
    mass of the grams, the total and the number of types after a context; a model
    over MODEL_BYTES has them as tables (ord, gram, one array per number)."""

    langs: list[str]
    gram: list[np.ndarray]
    gram_mass: list[np.ndarray]  # [gram, language]
    ctx: list[np.ndarray]
    ctx_total: list[np.ndarray]
    ctx_back: list[np.ndarray]  # discount * types
    wide: tuple[DataFrame, DataFrame] | None = None
    length: float = 100.0
    usual: np.ndarray | None = None  # mean cross-entropy per language
    spread: np.ndarray | None = None

    def log_probs(self, keys: np.ndarray) -> np.ndarray:
        """ln p(last symbol | the three before) per key and language."""
        p = np.full((len(keys), len(self.langs)), 1.0 / (1 << SYMBOL_BITS))
        for order in range(1, ORDER + 1):
            gram = keys & np.uint64(_suffix(order))
            ctx = gram >> np.uint64(SYMBOL_BITS)
            mass = _lookup(self.gram[order - 1], self.gram_mass[order - 1], gram)
            total = _lookup(self.ctx[order - 1], self.ctx_total[order - 1], ctx)
            back = _lookup(self.ctx[order - 1], self.ctx_back[order - 1], ctx)
            seen = total > 0
            p = np.where(seen, (mass + back * p) / np.where(seen, total, 1.0), p)
        return np.log(p)


def _lookup(known: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros((len(keys), values.shape[1]))
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where((known[at] == keys)[:, None], values[at], 0.0)


def train(rows: DataFrame) -> Model:
    """Fit the models on ``rows(text, lang)``; rows with a null in either train nothing."""
    return _fit(_gram_counts(rows.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")))


def _gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, fold, gram, n) of ``rows(text, lang)``; all copies of a text are in one fold."""
    partial = rows.select("text", "lang", _fold().alias("fold")).mapInArrow(
        _count_grams, "lang string, fold int, gram long, n long")
    return written(partial.groupBy("lang", "fold", "gram").agg(F.sum("n").alias("n")), "langid-folds")


def _fold() -> Column:
    return F.xxhash64("text").bitwiseAND(F.lit(1)).cast("int")


def _fit(grams_by_fold: DataFrame) -> Model:
    """The models of ``_gram_counts``."""
    counts = [None] * (ORDER + 1)
    counts[ORDER] = written(grams_by_fold.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid-grams")
    for order in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
        counts[order] = (counts[order + 1]
                         .groupBy("lang", F.expr(f"gram & {_suffix(order)}L").alias("gram"))
                         .agg(F.count("*").alias("n")))
    langs = sorted(r.lang for r in counts[1].select("lang").distinct().collect())
    if not langs:
        return Model([], [], [], [], [], [])
    number = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int") - 1
    grams = ctxs = None
    for order in range(1, ORDER + 1):
        c = counts[order].select(F.lit(order).alias("ord"), number.alias("lang"), "gram", "n")
        x = (c.groupBy("ord", "lang", F.shiftrightunsigned("gram", SYMBOL_BITS).alias("gram"))
             .agg(F.sum("n").alias("total"), F.count("*").alias("types")))
        grams = c if grams is None else grams.unionByName(c)
        ctxs = x if ctxs is None else ctxs.unionByName(x)
    grams, ctxs = written(grams, "langid-model"), written(ctxs, "langid-contexts")
    discount = np.full((ORDER, len(langs)), 0.75)
    for r in grams.groupBy("ord", "lang").agg(F.sum(F.expr("int(n = 1)")).alias("once"),
                                              F.sum(F.expr("int(n = 2)")).alias("twice")).collect():
        if r.once:
            discount[r.ord - 1, r.lang] = r.once / (r.once + 2.0 * r.twice)
    discount = np.clip(discount, 0.1, 0.95)
    size = sum(t.select("ord", "gram").distinct().count() * 8 * (1 + k * len(langs)) for t, k in ((grams, 1), (ctxs, 2)))
    if size <= MODEL_BYTES:
        return _assemble(langs, grams.toPandas(), ctxs.toPandas(), discount)
    return _tabled(langs, grams, ctxs, discount)


def _assemble(langs: list[str], grams: pd.DataFrame, ctxs: pd.DataFrame, discount: np.ndarray) -> Model:
    parts = [[], [], [], [], []]
    for order in range(1, ORDER + 1):
        for frame, fields, out in ((grams, ("mass",), (0, 1)), (ctxs, ("total", "back"), (2, 3, 4))):
            frame = frame[frame["ord"] == order]
            keys, at = np.unique(frame["gram"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
            cols = frame["lang"].to_numpy(np.int64)
            d = discount[order - 1][cols]
            if out[0]:
                total = frame["total"].to_numpy(float)
                made = {"total": total, "back": d * frame["types"].to_numpy(float)}
            else:
                made = {"mass": frame["n"].to_numpy(float) - d}
            parts[out[0]].append(keys)
            for k, field in zip(out[1:], fields, strict=True):
                m = np.zeros((len(keys), len(langs)))
                m[at, cols] = made[field]
                parts[k].append(m)
    return Model(langs, *parts)


def _tabled(langs: list[str], grams: DataFrame, ctxs: DataFrame, discount: np.ndarray) -> Model:
    """The model as two tables with one row per order and gram or context."""
    flat = F.array(*[F.lit(float(x)) for x in discount.ravel()])
    d = F.element_at(flat, (F.col("ord") - 1) * len(langs) + F.col("lang") + 1)

    def arrays(frame, name, **fields):
        made = frame.select("ord", "gram", "lang", *[c.alias(k) for k, c in fields.items()])
        maps = made.groupBy("ord", "gram").agg(*[F.map_from_entries(F.collect_list(F.struct("lang", k))).alias(k)
                                                 for k in fields])
        return written(maps.select("ord", "gram", *[
            F.expr(f"transform(sequence(0, {len(langs) - 1}), i -> coalesce(try_element_at({k}, i), 0D))").alias(k)
            for k in fields]), name)

    return Model(langs, [], [], [], [], [], (
        arrays(grams, "langid-wide-grams", mass=F.col("n") - d),
        arrays(ctxs, "langid-wide-contexts", total=F.col("total").cast("double"), back=F.col("types") * d)))


def _occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(digest, key, times) of each text, the text's letters on its first row."""
    for pdf in batches:
        digests = pdf["digest"].to_numpy(object)
        for a, _, run in _windows(pdf["text"].tolist()):
            run = [run] if isinstance(run, str) else run
            keys, ends, letters = _keys(run)
            if not len(keys):
                continue
            of = np.repeat(np.arange(len(run)), np.diff(ends, prepend=0))
            order = np.lexsort((keys, of))
            of, keys = of[order], keys[order]
            new = np.ones(len(keys), bool)
            new[1:] = (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])
            at = np.flatnonzero(new)
            first = np.ones(len(at), bool)
            first[1:] = of[at][1:] != of[at][:-1]
            yield pd.DataFrame({"digest": digests[a + of[at]], "key": keys[at].astype(np.int64),
                                "n": np.diff(at, append=len(keys)),
                                "letters": np.where(first, letters[of[at]], 0).astype(np.int64)})


def _wide_log_probs(model: Model, keys: DataFrame) -> DataFrame:
    """(key, ln p per language) of distinct ``keys(key)``, as Model.log_probs."""
    grams, ctxs = model.wide
    langs = len(model.langs)
    rows = keys.withColumn("p", F.array_repeat(F.lit(1.0 / (1 << SYMBOL_BITS)), langs))
    for order in range(1, ORDER + 1):
        g = grams.where(F.col("ord") == order).select("gram", "mass")
        x = ctxs.where(F.col("ord") == order).select(F.col("gram").alias("ctx"), "total", "back")
        # of one symbol there are at most 2**SYMBOL_BITS
        # (larger ones are merged: their files, well compressed, may look small enough to broadcast)
        g, x = (F.broadcast(t) if order <= most else t.hint("shuffle_merge") for t, most in ((g, 1), (x, 2)))
        gram = F.expr(f"key & {_suffix(order)}L") if order < ORDER else F.col("key")
        rows = (rows.withColumn("gram", gram).withColumn("ctx", F.shiftrightunsigned("gram", SYMBOL_BITS))
                .join(g, "gram", "left").join(x, "ctx", "left")
                .select("key", F.expr(f"if(total IS NULL, p, transform(sequence(0, {langs - 1}), i -> if(total[i] > 0, "
                                      "(if(mass IS NULL, 0D, mass[i]) + back[i] * p[i]) / total[i], p[i])))").alias("p")))
    return rows.select("key", F.expr("transform(p, x -> ln(x))").alias("ln"))


def _wide_sums(model: Model, texts: DataFrame) -> DataFrame:
    """(digest, sums per language, n symbols, letters) of the distinct ``texts(text)``."""
    some = texts.where("text IS NOT NULL").select(F.md5("text").alias("digest"), "text").dropDuplicates(["digest"])
    found = written(some.mapInPandas(_occurrences, "digest string, key long, n long, letters long"), "langid-occurrences")
    probs = written(_wide_log_probs(model, found.select("key").distinct()), "langid-log-probs")
    sums = F.array(*[F.sum(F.col("n") * F.col("ln")[i]) for i in range(len(model.langs))])
    return (found.join(probs.hint("shuffle_merge"), "key").groupBy("digest")
            .agg(sums.alias("sums"), F.sum("n").cast("double").alias("n"), F.sum("letters").alias("letters")))


class Scorer:
    """Sums of log probabilities per text; keys met before come from a
    direct-mapped cache, whose size is fixed."""

    def __init__(self, model: Model):
        self.model = model
        self.cache_key = np.full(1 << CACHE_BITS, np.uint64((1 << 64) - 1))
        self.cache_value = np.zeros((1 << CACHE_BITS, len(model.langs)), np.float32)

    def _values(self, keys: np.ndarray) -> np.ndarray:
        at = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        new = self.cache_key[at] != keys
        if new.any():
            fresh, first = np.unique(keys[new], return_index=True)
            slot = at[new][first]
            values = self.model.log_probs(fresh).astype(np.float32)
            self.cache_key[slot] = fresh  # of two keys for one slot the last stays
            self.cache_value[slot] = values
            out = self.cache_value[at]
            lost = self.cache_key[at] != keys
            if lost.any():
                some, back = np.unique(keys[lost], return_inverse=True)
                out[lost] = self.model.log_probs(some)[back]
            return out
        return self.cache_value[at]

    def sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: the sum per language, the number of symbols and of letters."""
        plain = [t or "" for t in texts]
        total = np.zeros((len(texts), len(self.model.langs)))
        n, letters = np.zeros(len(texts)), np.zeros(len(texts))
        for a, at, run in _windows(plain):
            run = [run] if at >= 0 else run
            keys, ends, some = _keys(run)
            to = slice(a, a + len(run))
            if len(keys) and self.model.langs:
                total[to] += segment_sums(self._values(keys), ends)
            n[to] += np.diff(ends, prepend=0)
            letters[to] += some
        return total, n, letters


def _drawn(rows: DataFrame) -> Column:
    """Draws about CALIBRATION_ROWS of ``rows(key, text, lang)`` by the hash of key and
    text, or all if there are fewer."""
    share = min(1.0, CALIBRATION_ROWS / max(1, rows.count()))
    return F.shiftrightunsigned(F.xxhash64("key", "text"), 11) < int(share * (1 << 53))


def _calibration_rows(rows: DataFrame, drawn: Column | None = None) -> DataFrame:
    """The rows drawn from those of ``rows(key, text, lang)`` with text and label:
    copies under several keys are drawn one by one, equal rows count once."""
    rows = rows.select("key", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    own = rows.where(_drawn(rows) if drawn is None else drawn)
    return own.groupBy("key", "lang", F.md5("text").alias("digest")).agg(F.first("text").alias("text"))


_MARKS = "key string, lang string, digest string, entropy double, losses array<double>"


def _marks(langs: list[str], rows: pd.DataFrame, sums: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """``rows(key, lang, digest)`` of known languages with the loss of each effective length,
    and the cross-entropy where the decision is right and the text long enough."""
    truth = rows["lang"].map({x: i for i, x in enumerate(langs)})
    known = truth.notna().to_numpy() & (n > 0)
    rows, sums, n, truth = rows[known], sums[known], n[known], truth[known].to_numpy(np.int64)
    at = np.arange(len(n))
    losses = [-np.log(_posterior(sums, n, t)[at, truth] + 1e-9) for t in LENGTHS] if len(n) else [n] * len(LENGTHS)
    own = (sums.argmax(axis=1) == truth) & (n >= 50)
    entropy = np.where(own, -sums[at, truth] / np.maximum(n, 1), 0.0)
    return pa.RecordBatch.from_arrays(
        [*[pa.array(rows[c], pa.string()) for c in ("key", "lang", "digest")], pa.array(entropy, mask=~own),
         pa.array(list(np.stack(losses, axis=1)), pa.list_(pa.float64()))], ["key", "lang", "digest", "entropy", "losses"])


def _calibration(model: Model, rows: DataFrame) -> list[Row]:
    """Per language of ``rows(key, text, lang)``, which the model has not seen: the rows and
    their losses, and number, mean and variance of the cross-entropies."""
    if not model.langs:
        return []
    langs = model.langs
    rows = rows.select(F.col("key").cast("string").alias("key"), "lang", F.md5("text").alias("digest"), "text")
    shared = None
    if model.wide:
        def judge(batches):
            for part in sliced(batches):
                pdf = part.to_pandas()
                sums = np.stack(pdf["sums"].to_numpy()) if len(pdf) else np.zeros((0, len(langs)))
                yield _marks(langs, pdf, sums, pdf["n"].to_numpy(float))

        found = (rows.drop("text").join(_wide_sums(model, rows), "digest").where("letters > 0")
                 .select("key", "lang", "digest", "sums", "n"))
    else:
        shared = rows.sparkSession.sparkContext.broadcast(model)
        found = rows

        def judge(batches):
            scorer = Scorer(shared.value)
            for part in sliced(batches):
                sums, n, letters = scorer.sums(part.column("text").to_pylist())
                yield _marks(langs, part.select(["key", "lang", "digest"]).to_pandas(), sums, np.where(letters > 0, n, 0))

    marks = found.mapInArrow(judge, _MARKS).dropDuplicates(["key", "lang", "digest"])  # equal rows count once
    got = marks.groupBy("lang").agg(
        *[F.sum(F.col("losses")[i]).alias(f"loss{i}") for i in range(len(LENGTHS))],
        F.count("entropy").alias("n"), F.avg("entropy").alias("mean"), F.var_pop("entropy").alias("var")).collect()
    if shared is not None:
        shared.destroy()
    return got


def calibrate(model: Model, found: list[Row]) -> Model:
    """Set the effective length and usual cross-entropies from the figures of ``_calibration``."""
    if not found:
        return model
    losses = [math.fsum(r[f"loss{i}"] for r in found) for i in range(len(LENGTHS))]
    model.length = LENGTHS[int(np.argmin(losses))]
    model.usual, model.spread = np.full(len(model.langs), np.inf), np.full(len(model.langs), np.inf)
    for i, lang in enumerate(model.langs):
        own = [r for r in found if r.lang == lang and r.n]
        n = sum(r.n for r in own)
        if n >= 20:
            mean = sum(r.n * r["mean"] for r in own) / n
            model.usual[i] = mean
            model.spread[i] = max(0.02, math.sqrt(sum(r.n * (r["var"] + (r["mean"] - mean) ** 2) for r in own) / n))
    return model


def learn(rows: DataFrame, hold: bool = True) -> Model:
    """The calibrated model of ``rows(key, text, lang, part)``; without ``hold`` all rows
    but those of remainder 2 train, whatever the size of the table."""
    rows = rows.where("part <> 2 AND text IS NOT NULL AND lang IS NOT NULL")
    hold = hold and rows.where("part = 3").count() <= CALIBRATION_ROWS
    trains = rows.where("part <> 3") if hold else rows
    grams = _gram_counts(trains)
    model = _fit(grams)
    if hold and not model.langs:  # nothing to hold back from
        return learn(rows, False)
    found = _calibration(model, _calibration_rows(rows.where("part = 3"), F.lit(True))) if hold else []
    for fold in (0, 1):
        found += _calibration(_fit(grams.where(F.col("fold") != fold)), trains.where(_fold() == fold))
    return calibrate(model, found)


def _posterior(sums: np.ndarray, n: np.ndarray, length: float) -> np.ndarray:
    """Softmax of the log likelihoods, each text's length n counting as
    n * length / (n + length): neighbouring symbols are no independent evidence."""
    z = (sums - sums.max(axis=1, keepdims=True)) * (length / (n + length))[:, None]
    z = np.exp(np.maximum(z, -50))
    return z / z.sum(axis=1, keepdims=True)


PREDICTION = "lang_pred string, score double, cross_entropy double, rejected boolean"
_PREDICTED = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()),
                        ("rejected", pa.bool_())])


def _decide(m: Model, total: np.ndarray, n: np.ndarray, letters: np.ndarray) -> pd.DataFrame:
    """PREDICTION of texts from their sums per language."""
    out = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "cross_entropy": np.nan, "rejected": True},
                       index=range(len(total)))
    ok = (letters > 0) & (len(m.langs) > 0)
    if ok.any():
        best = total[ok].argmax(axis=1)
        post = _posterior(total[ok], n[ok], m.length)[np.arange(len(best)), best]
        entropy = -total[ok, :][np.arange(len(best)), best] / n[ok]
        far = np.zeros(len(best), bool)
        if m.usual is not None:
            known = np.isfinite(m.usual[best])
            limit = m.usual[best] + DEVIATIONS * m.spread[best] * np.sqrt(1 + 200 / n[ok])
            far = known & (entropy > limit)
        out.loc[ok, "lang_pred"] = np.array(m.langs, dtype=object)[best]
        out.loc[ok, "score"] = post
        out.loc[ok, "cross_entropy"] = entropy
        out.loc[ok, "rejected"] = far | (post < MIN_SCORE)
    return out


def predictor(spark, model: Model):
    """A column function: text to PREDICTION."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for texts in sliced(batches):
            found = _decide(shared.value, *scorer.sums(texts.to_pylist()))
            yield pa.RecordBatch.from_pandas(found, _PREDICTED, preserve_index=False).to_struct_array()

    return predict


def _wide_predictions(model: Model, texts: DataFrame) -> DataFrame:
    """(digest, PREDICTION) of the distinct ``texts(text)`` that have any symbol."""
    shared = texts.sparkSession.sparkContext.broadcast(replace(model, wide=None))

    @F.pandas_udf(PREDICTION)
    def decide(sums: pd.Series, n: pd.Series, letters: pd.Series) -> pd.DataFrame:
        return _decide(shared.value, np.stack(sums.to_numpy()) if len(sums) else np.zeros((0, len(shared.value.langs))),
                       n.to_numpy(float), letters.to_numpy(float))

    return _wide_sums(model, texts).select("digest", decide("sums", "n", "letters").alias("found"))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
             hold: bool = True) -> DataFrame:
    """``docs`` plus a struct column ``prediction`` (PREDICTION) and ``held_out``.

    Learns from rows whose crc32(key as text) mod 4 is not 2 (null keys count as
    0): all of them calibrate, and all train, but for rows of remainder 3 of a small
    table with ``hold``.  Label and key are never inputs of a prediction.
    """
    part = F.coalesce(fold(key, 4), F.lit(0))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("lang"), part.alias("part"))
    model = learn(rows, hold)
    if model.wide:
        names, digest = (free_name(docs, "prediction"), free_name(docs, "held_out")), free_name(docs, "digest")
        found = _wide_predictions(model, rows).select(F.col("digest").alias(digest), F.col("found").alias(names[0]))
        none = F.expr(f"named_struct('lang_pred', '{UNKNOWN}', 'score', 0D, 'cross_entropy', CAST(NULL AS DOUBLE), "
                      "'rejected', true)")
        return (docs.withColumns({digest: F.md5(F.col(text)), names[1]: part == 2}).join(found, digest, "left")
                .select(*docs.columns, F.coalesce(F.col(names[0]), none).alias(names[0]), names[1]))
    predict = predictor(docs.sparkSession, model)
    return docs.withColumns({free_name(docs, "prediction"): predict(F.col(text)),
                             free_name(docs, "held_out"): part == 2})
