"""Token counts of prefixes, fill-in-the-middle, periodic runs: the library or brute force, odd input."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from llm_fixtures import documents, shipped  # noqa: F401
from oracle_compare import compare, duck
from shelfwise.llm import fillmiddle, periods, tokencounts

ODD = [(1, None, None, None), (2, "", None, "a"), (3, " \t\n", "en", "a"), (4, "one two\n", "en", None),
       (4, "one two\n", "en", None), (None, "x y z", "en", "b"), (5, "long line " * 30_000 + "\nend", "en", "b"),
       (6, "ünï ☃ 漢字\nzwei\n\n", "en", "c"), (7, "holds <P> itself\nx", "en", "c"), (8, "w" * 50_000, "en", "c")]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokencounts.default_vocabulary())


def n_tokens(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_has_the_librarys_count(library):
    counter, rnd = tokencounts.PrefixCounter(tokencounts.default_vocabulary()), random.Random(3)
    alphabets = ["abcdefghijklmnopqrstuvwxyz'' .,!ABC019", "'srevtlmd ", "aẠ́èô 각x", "<|startofx>end ",
                 "日本語éÉİßſ한 　Ǆǅ１²🙂👍🏽‍abà", "कि्षो กิ่ก", "ab"]
    texts = ["".join(rnd.choice(a) for _ in range(rnd.randint(0, 25))) for a in alphabets for _ in range(60)]
    texts += ["<|endoftext|>", "x<|endoftext|>'s", "!<|startoftext|><|endoftext|>b", "don't we'll they're o'clock 'tis",
              "ab" * 200, "a" * 300, "é" * 50, "ậ̣x"]
    for text, steps in zip(texts, counter.steps(texts), strict=True):
        assert tokencounts.decoded(steps).tolist() == [n_tokens(library, text[:i]) for i in range(len(text) + 1)], text


def test_neighbouring_tokens_that_do_not_fit(library):
    """Whether two tokens may stand side by side is what the encoding says."""
    counter, rnd = tokencounts.PrefixCounter(tokencounts.default_vocabulary()), random.Random(4)
    tokens = sorted(t for t, (inner, _) in counter.merges.roles.items() if inner and t.isascii() and t.isalpha() and t.islower())
    endings = sorted(e for _, e in counter.merges.roles.values() if e and e[:-4].isascii() and e[:-4].isalpha() and e[:-4].islower())
    for _ in range(2000):
        a, b = rnd.choice(tokens), rnd.choice(endings)
        got = library.encode(a + b.removesuffix("</w>"), add_special_tokens=False).tokens
        assert counter.merges.fit(a, b) == (got == [a, b])


def test_budget_and_truncation(documents, library):  # noqa: F811
    docs = documents([(1, "The quick brown fox, doesn't it? ünï 漢字 jumps!", None, None), (2, None, None, None),
                      (3, "unbelievably antidisestablishmentarianism", None, None)])
    counts = tokencounts.stored(docs)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for budget in (0, 1, 3, 7, 1000):
        best = {r.doc_id: r.p for r in counts.select("doc_id", tokencounts.longest_prefix(
            F.col("steps"), F.lit(budget)).alias("p")).collect()}
        for k, t in texts.items():
            assert best[k] == max(i for i in range(len(t) + 1) if n_tokens(library, t[:i]) <= budget)
        cut = {r.doc_id: r.text for r in tokencounts.truncated(docs, counts, budget).collect()}
        assert {k: (v or "") for k, v in cut.items()} == {k: t[:best[k]] for k, t in texts.items()}
    at = {r.doc_id: r.n for r in counts.select("doc_id", tokencounts.tokens_at(F.col("steps"), F.lit(9)).alias("n")).collect()}
    assert at == {k: n_tokens(library, t[:9]) for k, t in texts.items()}


def test_counts_of_odd_rows(documents, library):  # noqa: F811
    docs = documents(ODD, ", n_tokens string, steps string", ("x", "y"))
    rows = sorted(((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in tokencounts.prefix_counts(docs).collect()))
    assert rows == sorted((d or -1, len((t or "").encode()), n_tokens(library, t or "")) for d, t, *_ in ODD)
    assert tokencounts.prefix_counts(docs.limit(0)).count() == 0


def test_token_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = E.queries()["op11_token_counts"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        k: (len((t or "").encode()), n := n_tokens(library, t or ""), n > 2048) for k, t in texts.items()}


def test_another_vocabulary_is_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="word endings"):
        tokencounts.PrefixCounter(public_tokenizers.path("byte_bpe_50k.json"))


def brute_middle(key, text, seed=7):
    text, name = text or "", "" if key is None else str(key)
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    h = [int(digits[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) else "spm" if h[3] % 100 < 50 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    told = (None, None) if form == "plain" else (len(p), len(m))
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (out, text)]
    return (-1 if key is None else key, n, form, *told, *sha), out


@pytest.mark.parametrize("chunk", [1 << 15, 7])
def test_middle_of_odd_rows(documents, chunk):  # noqa: F811
    rows = [r for r in ODD if chunk > 100 or len(r[1] or "") < 1000]
    docs = documents(rows, ", form string, hash long", ("x", 1)).repartition(3)
    got = [tuple(-1 if v is None and i == 0 else v for i, v in enumerate(r))
           for r in fillmiddle.transform(docs, chunk=chunk).collect()]
    assert sorted(got, key=str) == sorted((brute_middle(d, t)[0] for d, t, *_ in rows), key=str)
    made = [(r.doc_id, r.form, r.output) for r in fillmiddle.outputs(docs, chunk=chunk).collect()]
    assert sorted(o for _, _, o in made) == sorted(brute_middle(d, t)[1] for d, t, *_ in rows)
    assert sorted(fillmiddle.restored(o, f) for _, f, o in made) == sorted(t or "" for _, t, *_ in rows)
    assert fillmiddle.transform(docs.limit(0)).count() == 0


def test_middle_spreads_a_repeated_row(spark):
    """A third of the rows equal: they do not meet in one task."""
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) AS doc_id", "'a\\nb\\nc' AS text").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = fillmiddle.output_pieces(rows).where("pos = -1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in held) < 1000
    assert fillmiddle.transform(rows).count() == 3000


def test_middle_query_matches_sql(spark):
    con = duck(SF_SMALL)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    ok, msg = compare(E.queries()["op12_fill_in_middle"](spark, SF_SMALL), con, E.oracle_sql()["op12_fill_in_middle"])
    assert ok, msg


def brute_runs(w, least=12):
    seen = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                seen.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in seen.items())


def made_words(rnd):
    k, out = rnd.choice([1, 2, 2, 3, 5, 30]), []
    for _ in range(rnd.randint(0, 5)):
        unit = [b"w%d" % rnd.randrange(k) for _ in range(rnd.randint(1, 20))]
        out += (unit * rnd.randint(1, 6))[:rnd.randint(1, 80)]
    if rnd.random() < .1:  # a Fibonacci word: many runs of many periods
        a, b = [b"a"], [b"a", b"b"]
        for _ in range(8):
            a, b = b, b + a
        out = b + out
    return out + out if rnd.random() < .2 else out


def test_runs_are_those_of_brute_force():
    rnd, found = random.Random(5), 0
    for _ in range(40):
        docs = [made_words(rnd) for _ in range(25)]
        for words, runs in zip(docs, periods.find_runs(docs), strict=True):
            expected = brute_runs(words)
            found += len(expected)
            assert [tuple(r) for r in runs.tolist()] == expected
    assert found > 2000


def test_grammar_derives_its_stretches():
    """The nonterminals' places all spell the same words, and no pair is left twice."""
    import numpy as np

    rnd = random.Random(6)
    w = np.array([rnd.randrange(4) for _ in range(3000)] * 2, np.int64)
    rules, (_, start, end) = periods.repair(w, np.array([0]), np.array([len(w)]), 2)
    assert start[0] == 0 and end[-1] == len(w) and (start[1:] == end[:-1]).all()
    for a, mid, b, places in rules:
        assert a < mid < b
        for p in places:
            assert (w[p:p + b - a] == w[a:b]).all()
    assert len(start) < 1000


def test_long_runs_and_random_words():
    assert periods.find_runs([[b"a"] * 200_000])[0].tolist() == [[0, 200_000, 1]]
    unit = [b"%d" % i for i in range(7_000)]
    assert periods.find_runs([unit * 3 + unit[:10]])[0].tolist() == [[0, 21_010, 7_000]]
    rnd = random.Random(7)
    words = [b"%d" % rnd.randrange(2) for _ in range(3_000)]
    assert [tuple(r) for r in periods.find_runs([words])[0].tolist()] == brute_runs(words)


def test_runs_of_odd_rows(documents):  # noqa: F811
    rows = [*ODD, (9, "a b " * 8, None, None), (9, "a b " * 8, None, None), (10, "x " * 11, None, None), (11, "x\x1cx " * 12, None, None)]
    docs = documents(rows, ", runs string, collapsed int", ("x", 1))
    found = {}
    for r in periods.periodic_runs(docs).collect():
        found.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    assert found[1] == found[2] == found[3] == [(0, [], "")]
    assert found[9] == [(16, [(0, 16, 2)], "a b")] * 2
    assert found[10] == [(11, [], " ".join("x" * 11))]
    assert found[11] == [(12, [(0, 12, 1)], "x\x1cx")]
    assert found[5] == [(60_001, [(0, 60_000, 2)], "long line end")]
    assert periods.periodic_runs(docs.limit(0)).count() == 0


def test_runs_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in E.queries()["op13_periodic_runs"](spark, SF_SMALL).collect()}
    assert rows.keys() == texts.keys()
    with_runs = 0
    for key, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(w), zlib.crc32(str(key).encode())
        if n > 1500:
            continue
        if h % 10 == 0 and n:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
        runs = brute_runs(w)
        with_runs += bool(runs)
        dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        expected = (key, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
                    *(hashlib.sha256(x.encode()).hexdigest() for x in (
                        "".join(f"{s},{size},{q}\n" for s, size, q in runs),
                        " ".join(x for i, x in enumerate(w) if i not in dropped))))
        assert tuple(rows[key]) == expected
    assert with_runs > 10
