"""Registered queries against SQL, brute force and what is planted in the tables."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from weatherloom.llm import queries, simhash
from weatherloom.llm.decontam import words_of

SF = "/root/testdata/sf0.001"


def sortable(rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, small_tables, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = small_tables.execute(queries.ORACLES[name])
    order = [[d[0] for d in result.description].index(c) for c in columns]
    assert sortable(tuple(r[c] for c in columns) for r in df.collect()) == sortable(tuple(r[i] for i in order) for r in result.fetchall())


def test_language_on_held_out_rows(spark, small_tables):
    got = {r["doc_id"]: r for r in queries.op1_language_id(spark, SF).collect()}
    lang = dict(small_tables.execute("SELECT doc_id, lang FROM documents").fetchall())
    held = [d for d, r in got.items() if r["held_out"]]
    assert 20 < len(held) < len(got)
    assert np.mean([got[d]["lang_pred"] == lang[d] for d in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def brute_counts(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").encode().split(b"\n") if x.strip()]
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, texts, small_tables):
    got = queries.op3_quality_rules(spark, SF).collect()
    assert len(got) == len(texts)
    quality = dict(small_tables.execute("SELECT doc_id, quality FROM labels").fetchall())
    for r in got:
        base = brute_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base
        assert r["base_failed"] == (base[0] < 20 or 100 * base[4] > 30 * base[0])
        assert not (r["base_failed"] and r["kept"])
    sure = [r["kept"] == bool(quality[r["doc_id"]]) for r in got if r["doc_id"] in quality and not r["base_failed"]]
    assert np.mean(sure) > 0.9


def test_resampling_keeps_good_text(spark, small_tables):
    kept = {r["doc_id"]: r["kept"] for r in queries.op6_quality_classifier(spark, SF).collect()}
    quality = dict(small_tables.execute("SELECT doc_id, quality FROM labels").fetchall())
    assert np.mean([kept[d] for d, q in quality.items() if q == 1]) > 0.95
    assert np.mean([kept[d] for d, q in quality.items() if q == 0]) < 0.2


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash(spark, texts):
    got = {r["doc_id"]: r for r in queries.op7_simhash(spark, SF).collect()}
    marks = {d: brute_fingerprint(t) for d, t in texts.items()}
    assert {d: r["fingerprint"] for d, r in got.items()} == {d: f"{m:016x}" for d, m in marks.items()}
    reached = {d: d for d in marks}
    changed = True
    while changed:
        changed = False
        for a in marks:
            least = min(reached[b] for b in marks if (marks[a] ^ marks[b]).bit_count() <= 4)
            if least < reached[a]:
                reached[a], changed = least, True
    assert {d: r["component_id"] for d, r in got.items()} == reached


@pytest.mark.parametrize("radius,shard_size", [(4, 3), (4, 1024), (1, 5), (0, 4)])
def test_links_join_what_all_links_join(spark, radius, shard_size):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 1 << 63, 12)
    marks = {int(c) ^ int(sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 9), replace=False))) for c in centres for _ in range(9)}
    frame = spark.createDataFrame([(m,) for m in marks], "fp long")

    def components(pairs):
        above = {m: m for m in marks}

        def top(x):
            while above[x] != x:
                x = above[x]
            return x

        for a, b in pairs:
            above[top(a)] = top(b)
        return {frozenset(m for m in marks if top(m) == t) for t in {top(m) for m in marks}}

    every = [(a, b) for a in marks for b in marks if (a ^ b).bit_count() <= radius]
    found = [(r["a"], r["b"]) for r in simhash.links(frame, radius, shard_size).collect()]
    assert all((a ^ b).bit_count() <= radius for a, b in found)
    assert components(found) == components(every)


def test_substring_dedup_removes_later_copies_only(spark, texts):
    got = {r["doc_id"]: r for r in queries.op4_substring_dedup(spark, SF).collect()}
    for d, r in got.items():
        raw = texts[d].encode()
        kept, at = b"", 0
        for a, b in [(s["start"], s["end"]) for s in r["removed_spans"]]:
            assert b - a >= 96 and any(raw[a:b][:60] in t.encode() for e, t in texts.items() if e < d or e == d)
            kept, at = kept + raw[at:a], b
        assert hashlib.sha256(kept + raw[at:]).hexdigest() == r["kept_sha256"]
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["removed_spans"])
    first = {}
    for d in sorted(texts):
        if texts[d] in first and len(texts[d]) > 300:
            assert got[d]["n_removed"] == len(texts[d].encode())
        first.setdefault(texts[d], d)


def test_encoding_comes_back(spark, texts):
    got = queries.op8_sentencepiece_nbest(spark, SF).collect()
    assert len(got) == len(texts) and all(r["round_trip"] for r in got)
    assert all(r["n_tokens"] == len(r["ids"]) and len(r["nbest"]) == 3 for r in got if r["n_tokens"] > 9)
    assert all(a["score"] >= b["score"] for r in got for a, b in zip(r["nbest"], r["nbest"][1:]))


def test_pipeline(spark, small_tables):
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert len(stages) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stage(spark, seen[-1], SF).cache())
        assert seen[-1].columns == docs.columns
    sizes = [s.count() for s in seen]
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] >= sizes[4] > 0
    items = [r["w"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select(words_of("text").alias("w")).collect()]
    final = [" ".join(r["w"]) for r in seen[-1].select(words_of("text").alias("w")).collect()]
    assert not any(" ".join(w) in t for w in items for t in final)
    assert all(r["n_chars"] == len(r["text"]) for r in seen[-1].collect())
    last = corpus_pipeline.run(spark, SF)
    assert last.count() == sizes[-1] and last.filter("not round_trip").isEmpty()
