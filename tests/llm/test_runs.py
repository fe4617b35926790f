"""Periodic runs against brute force, and odd texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weatherloom.llm import queries, runs

from .conftest import SF


def all_runs(words):
    """Maximal stretches for every distance; the least distance of each."""
    n, found = len(words), {}
    numbers = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    for d in range(1, n // 2 + 1):
        same = np.concatenate(([0], ids[:-d] == ids[d:], [0])).astype(np.int8)
        for a, b in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist()):
            if b - a + d >= max(12, 2 * d):
                found.setdefault((a, b + d), d)
    return sorted((a, q, b) for (a, b), q in found.items())


def expected(doc_id, text, plant=True):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and n and h % 10 == 0:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = all_runs(words)
    gone = {i for a, q, b in found for i in range(a + q, b)}
    best = min(((a - b, a, q) for a, q, b in found), default=None)
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    listed = "".join(f"{a},{b - a},{q}\n" for a, q, b in found).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *top, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert got == {expected(*r) for r in docs}
    assert sum(r[1] for r in got) > 20


@pytest.mark.parametrize("seed", range(4))
def test_random_sequences(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n = rng.choice([0, 1, 11, 12, 13, 40, 150, 700])
        words = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(n)]
        if n and rng.random() < 0.7:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        got = runs.runs(np.array([-1, *words, -2], np.int64), n)
        assert [(a - 1, q, b - 1) for a, b, q in got.tolist()] == all_runs(words)


def test_runs_within_runs():
    fibonacci = [0, 1]
    before = [0]
    while len(fibonacci) < 600:
        before, fibonacci = fibonacci, fibonacci + before
    for words in (fibonacci, [0] * 500, ([0] * 20 + [1]) * 20, [0, 1] * 9 + [0, 2] * 9 + [0, 1] * 9):
        got = runs.runs(np.array([-1, *words, -2], np.int64), len(words))
        assert [(a - 1, q, b - 1) for a, b, q in got.tolist()] == all_runs(words)


def test_very_long_repetitive_text_stays_linear():
    for period in (1, 7, 40001):
        words = np.arange(200_000) % period
        assert runs.runs(np.concatenate(([-1], words, [-2])), len(words)).tolist() == [[1, 200_001, period]]


def test_transforms_are_exact():
    rng = np.random.default_rng(3)
    blocks, windows = rng.integers(0, runs.PRIME, (5, 64)), rng.integers(0, runs.PRIME, (5, 256))
    got = runs.correlations(runs._centred(blocks.astype(float)), runs._centred(windows.astype(float)), 192)
    for r in range(5):
        for d in (0, 1, 100, 191):
            assert int(got[r, d]) % runs.PRIME == sum(int(x) * int(y) for x, y in zip(blocks[r], windows[r, d : d + 64])) % runs.PRIME


def test_odd_rows(spark, odd_docs):
    rows = odd_docs.collect()
    for plant in (False, True):
        got = sorted(map(tuple, runs.periodic_runs(odd_docs, plant=plant).collect()), key=repr)
        assert got == sorted((expected(r.doc_id, r.text, plant) for r in rows), key=repr)
    assert runs.periodic_runs(odd_docs.filter(F.lit(False))).collect() == []


def test_words_of_any_script_and_texts_over_one_batch(docs_of, monkeypatch):
    monkeypatch.setattr(runs, "_TEXT_BYTES", 64)
    rows = [(i, t) for i, t in enumerate(["née ☃ " * 9, "a　b " * 12, "\x00 \x1f\v" * 20, None, "", "x\ny\tz " * 5, "no run here"])]
    got = sorted(map(tuple, runs.periodic_runs(docs_of(rows)).collect()))
    assert got == sorted(expected(*r, plant=False) for r in rows)
