"""SimHash: fingerprints and components against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from llm_fixtures import documents, shipped  # noqa: F401
from shelfwise.llm import simhash
from shelfwise.llm.components import connected_components


def brute_fingerprint(text, k=4):
    low = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius):
    """Smallest index reachable over pairs within the radius."""
    v = np.array(values, np.uint64)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= radius
    label = np.arange(len(v))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(v))])
        if (new == label).all():
            return label
        label = new


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    fps = [brute_fingerprint(r.text) for r in docs]
    label = brute_components(fps, 4)
    got = {r.doc_id: r for r in E.queries()["op5_simhash_dedup"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for i, r in enumerate(docs):
        assert got[r.doc_id].fingerprint == f"{fps[i]:016x}"
        assert got[r.doc_id].component_id == docs[label[i]].doc_id


def test_fingerprint_hash_is_sparks_xxhash64(spark):
    text = "Ünï a b c"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("limit", [4, 64, 100_000])
def test_links_of_dense_and_scattered_fingerprints(spark, limit):
    """A ball of close values far above the shard limit is dealt again, not cut."""
    rng = np.random.default_rng(1)
    center = int(rng.integers(1 << 62))
    ball = {center}
    while len(ball) < 300:
        x = int(rng.choice(list(ball))) ^ (1 << int(rng.integers(64)))
        ball.add(x)
    values = sorted(ball | {int(x) for x in rng.integers(0, 1 << 62, 300)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r.node: r.component for r in
             connected_components(simhash.links(fps, limit=limit)).collect()}
    label = brute_components(values, 4)
    want: dict[int, set] = {}
    for v, k in zip(signed, label, strict=True):
        want.setdefault(k, set()).add(v)
    have: dict[int, set] = {}
    for v in signed:
        have.setdefault(found.get(v, v), set()).add(v)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 160)] + [(300, 300), (None, 5), (7, None),
                                                                                    (101, 102), (102, 101)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(frame).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(100, 160)) and got[300] == 300
    assert connected_components(frame.limit(0)).count() == 0


def test_odd_rows_and_deduplicate(spark, documents):
    text = " ".join(f"w{i}" for i in range(60))
    near = text.replace("w5 ", "w5x ")
    rows = [(5, text, "en", "s"), (3, near, "en", "s"), (9, text.upper(), "en", "s"), (1, None, None, None),
            (2, "", None, None), (4, " \t\n", None, None), (7, "two words", "en", "s"), (7, "two words", "en", "s"),
            (None, "alone and apart from all", None, None), (8, "z " * 100_000, "en", "s")]
    docs = documents(rows, ", fp int, _kept int", (1, 2))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r.component_id for r in got}
    assert by_id[1] == by_id[2] == by_id[4] == 1 and by_id[5] == by_id[9] and by_id[None] is None
    left = simhash.deduplicate(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert ids.count(7) == 1 and ids.count(None) == 1 and 1 in ids and 2 not in ids and 9 not in ids
    assert simhash.deduplicate(docs.limit(0)).count() == 0


def test_row_kept_of_a_repeated_key_is_in_its_group(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (8, b)], "doc_id long, text string")
    kept = {(r.doc_id, r.text) for r in simhash.deduplicate(docs).collect()}
    assert kept == {(3, a), (5, b)}
