"""Trained and deduplicating queries, row by row against plain models with the same hash and seed."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_text_queries import SF, brute_counts
from weatherloom.llm import chunks, langid, linear, ngrams, quality_rules, queries, resample

LOW64, LOW32 = (1 << 64) - 1, (1 << 32) - 1
BASE, MIX, REPEAT = (int(x) for x in (ngrams._BASE, ngrams._MIX, ngrams._REPEAT))
STEPS = [int(x) for x in ngrams._STEPS]


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def quality(small_tables):
    return {d: q for d, q in small_tables.execute("SELECT doc_id, max(quality) FROM labels WHERE quality IS NOT NULL GROUP BY doc_id").fetchall()}


def mix(x):
    x = (x ^ (x >> 32)) * MIX & LOW64
    return x ^ (x >> 29)


def gram(points, buckets):
    h = points[0] * STEPS[0] & LOW32
    for j, p in enumerate(points[1:], 1):
        h = ((h ^ (h >> 15)) * STEPS[j] + p * STEPS[0]) & LOW32
    return ((h ^ (h >> 13)) * STEPS[3] & LOW32) >> (33 - buckets.bit_length())


def families(text, buckets):
    hashes = [mix(sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(w)) & LOW64) for w in (text or "").encode().split()]
    pairs = [REPEAT if a == b else mix((a * BASE + b) & LOW64) for a, b in zip(hashes, hashes[1:])]
    points = [ord(c) for c in text or ""]
    high = 65 - buckets.bit_length()
    return [Counter(h >> high for h in hashes), Counter(h >> high for h in pairs), Counter(gram(points[i : i + 3], buckets) for i in range(len(points) - 2))]


def test_language(spark, docs):
    def grams(text):
        low = [ord(c.lower()) if len(c.lower()) == 1 and ord(c) < 1 << 16 else ord(c) for c in text or ""]
        return Counter(gram(low[i : i + n], langid.BUCKETS) for n in langid.ORDERS for i in range(len(low) - n + 1))

    seen, rows = defaultdict(Counter), Counter()
    for d, text, lang in docs:
        if zlib.crc32(str(d).encode()) % 3 != 1 and text is not None and lang is not None:
            seen[lang].update(grams(text))
            rows[lang] += 1
    total = {lang: sum(c.values()) + 0.5 * langid.BUCKETS for lang, c in seen.items()}
    got = {r["doc_id"]: r for r in queries.op1_language_id(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, text, _ in docs:
        joint = {lang: math.log(rows[lang] / rows.total()) + sum(n * math.log((seen[lang][b] + 0.5) / total[lang]) for b, n in grams(text).items()) for lang in sorted(seen)}
        best = max(joint, key=joint.get)
        score = 1 / sum(math.exp(x - joint[best]) for x in joint.values())
        if not any(c.isalpha() for c in text or ""):
            best, score = "und", 0.0
        assert got[d]["lang_pred"] == best and abs(got[d]["score"] - score) < 1e-6 and got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1)


def test_verdict_of_the_quality_rules(spark, docs, quality):
    marks = {r["doc_id"]: r["held"] for r in spark.createDataFrame([(d,) for d, _, _ in docs], "doc_id long").select("doc_id", (F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4)) == 0).alias("held")).collect()}
    found = {d: families(text, quality_rules.BUCKETS) for d, text, _ in docs}
    learn = [d for d, _, _ in docs if d in quality]
    label, held = np.array([int(quality[d] > 0) for d in learn]), np.array([marks[d] for d in learn])

    def sparse(ids):
        rows = [(i, f * quality_rules.BUCKETS + b, np.float32(100 * n / c.total())) for i, d in enumerate(ids) for f, c in enumerate(found[d]) for b, n in sorted(c.items())]
        return [np.array(x) for x in zip(*rows)]

    row, index, value = sparse([d for d, h in zip(learn, held) if not h])
    weights, bias = linear.fit_logistic(index, value.astype(float), row, label[~held], 3 * quality_rules.BUCKETS)
    row, index, value = sparse([d for d, h in zip(learn, held) if h])
    slope, shift = linear.fit_platt(bias + np.bincount(row, value * weights[index], held.sum()), label[held])
    got = {r["doc_id"]: r for r in queries.op3_quality_rules(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, text, _ in docs:
        raw = bias + sum(100 * n / c.total() * weights[f * quality_rules.BUCKETS + b] for f, c in enumerate(found[d]) for b, n in c.items())
        p, base = float(linear.sigmoid(slope * raw + shift)), brute_counts(text)
        assert abs(got[d]["p_quality"] - p) < 1e-5
        assert got[d]["kept"] == (base[0] >= 20 and 100 * base[4] <= 30 * base[0] and p >= 0.5)


def test_resampling(spark, docs, quality):
    found = {d: families(text, resample.BUCKETS) for d, text, _ in docs}
    raw, target = ([sum((found[d][f] for d, _, _ in docs if every or quality.get(d) == 1), Counter()) for f in range(3)] for every in (True, False))

    def ratio(f, b):
        return math.log((target[f][b] + 1) / (target[f].total() + resample.BUCKETS)) - math.log((raw[f][b] + 1) / (raw[f].total() + resample.BUCKETS))

    got = {r["doc_id"]: r for r in queries.op6_quality_classifier(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, _, _ in docs:
        sums = [sum(n * ratio(f, b) for b, n in c.items()) for f, c in enumerate(found[d])]
        if not found[d][0]:
            assert got[d]["log_weight"] == -1e6
            continue
        assert abs(got[d]["log_ratio"] - sum(sums) / 3) < 1e-6
        assert abs(got[d]["log_weight"] - 64 * sum(s / max(c.total(), 1) for s, c in zip(sums, found[d])) / 3) < 1e-6
    k = sum(r["log_weight"] >= resample.MIN_LOG_WEIGHT for r in got.values())
    least = sorted((r["draw"] for r in got.values()), reverse=True)[k - 1]
    assert all(r["kept"] == (r["draw"] >= least) for r in got.values())


def brute_chunks(data):
    gear, n = chunks._GEAR.astype(np.uint64), len(data) - 15
    raw = np.frombuffer(data, np.uint8)
    h = sum(gear[raw[k : k + n]] << np.uint64(15 - k) for k in range(16)) & np.uint64(LOW32)
    h = h * np.uint64(int(chunks._SPREAD)) & np.uint64(LOW32)
    h ^= h >> np.uint64(15)
    h[raw[:n] & 0xC0 == 0x80] = LOW32
    reach, window = chunks.REACH, chunks.CUT_WINDOW
    view = np.lib.stride_tricks.sliding_window_view
    peaks = [i + reach for i, p in enumerate(view(h, 2 * reach + 1).argmin(axis=1).tolist()) if p == reach]
    lows = {i + p for i, p in enumerate(view(h, window).argmin(axis=1).tolist())}
    ends = []
    for a, b in zip([0, *peaks], [*peaks, len(data)]):
        ends += sorted(x for x in lows if a < x < b) * (b - a > chunks.LONG_CHUNK) + [b]
    parts = [data[a:b] for a, b in zip([0, *ends], ends)]
    out = []
    for part in parts:
        if out and out[-1][0] == part and (out[-1][1] + 1) * len(part) <= window:
            out[-1][1] += 1
        else:
            out.append([part, 1])
    return [part * n for part, n in out]


def brute_spans(texts):
    """doc_id to the (start, end) that go."""
    first, hits = {}, defaultdict(list)
    for d in sorted(texts):
        data, at = texts[d].encode(), 0
        for part in brute_chunks(data) if len(data) >= 99 else []:
            f_id, f_start = first.setdefault(part, (d, at))
            if (f_id, f_start) != (d, at):
                hits[d].append((at, len(part), f_id, 0, f_start))
            at += len(part)
    out = {d: [] for d in texts}
    for d, found in hits.items():
        own, gone = texts[d].encode(), np.zeros(len(texts[d].encode()) + 1, bool)
        marks = set()
        for start, end, f_id, _, f_start, f_end in chunks.joined_chunks(found):
            there = texts[f_id].encode()
            a, b = chunks.extended(np.frombuffer(own, np.uint8), start, end, there[max(f_start - 128, 0) : f_start], there[f_end : f_end + 128])
            gone[a:b] = True
            marks |= {(a, b)}
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0)).tolist()
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= min(400, len(own)) or len(own[a:b].split()) >= 50:
                out[d].append((a, b))
    return out


def test_substring_dedup(spark, docs):
    texts = {d: text or "" for d, text, _ in docs}
    want = brute_spans(texts)
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["removed_spans"]] for r in queries.op4_substring_dedup(spark, SF).collect()}
    assert got == want and any(want.values())
