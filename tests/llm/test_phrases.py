"""Collocations against SQL and plain Python."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from weatherloom.llm import phrases


def expected(rows, max_words=3, min_count=10, top=2000, percent=50):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= min_count}
        covered = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    covered[p[i : i + k]] = max(covered[p[i : i + k]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * covered[p] >= percent * a and covered[p]:
                continue
            score, _, left, right = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(2)
    words = np.array(["The", "CAT", "sat", "on", "mat", "née", "Éa", "☃", "x\x00y", "new", "york", "city", "*"])
    rows = []
    for i in range(120):
        text = "".join(f"{w}{rng.choice([' ', '  ', chr(9), ' ', ' ', ', ', '. ', chr(10), chr(13)])}" for w in rng.choice(words, 60))
        rows.append((("en", "de", None)[i % 3], text + "New York City " * (i % 4)))
    return rows + [(None, None), ("fr", ""), ("fr", " .,\n"), ("en", "solo"), ("zz", "ab " * 40), ("en", "a" * 5000)]


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("shard_words, bits, max_words", [(1 << 20, 20, 3), (50, 6, 3), (300, 18, 4), (300, 18, 2)])
def test_against_plain_python(spark, texts, shard_words, bits, max_words):
    df = spark.createDataFrame(texts, "lang string, text string").repartition(3)
    for name in ("phrase", "words", "f", "a", "l", "n", "score", "rank", "bucket"):
        df = df.withColumn(name, F.lit(1))
    got = found(phrases.collocations(df, shard_words=shard_words, sketch_bits=bits, max_words=max_words))
    assert got == expected(texts, max_words)
    assert len(got) > 20


def test_limits_are_parameters(spark, texts):
    df = spark.createDataFrame(texts, "lang string, text string")
    got = found(phrases.collocations(df, min_count=4, top=7, covered_percent=80))
    assert got == expected(texts, min_count=4, top=7, percent=80)


def test_sql_of_the_contract(spark, texts):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (lang VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", texts)
    assert sorted(con.execute(phrases.SQL).fetchall()) == expected(texts)


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_019, 3_000_000_037, 3_000_000_043
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(phrases.score("a", "l", "r")).first()[0] == 10**6 * a * a // (left * right)


def test_no_rows(spark):
    for rows in ([], [("en", None)], [("en", ""), (None, " ")]):
        assert phrases.collocations(spark.createDataFrame(rows, "lang string, text string")).collect() == []


def test_index_counts_every_phrase():
    rng = np.random.default_rng(4)
    ids = np.append(rng.integers(0, 6, 400), 5).astype(np.int32)  # 5 breaks
    index = phrases.FMIndex(ids, 5, 3)
    level = index.words()
    for words in range(1, 5):
        if words > 1:
            level = index.extended(*level, left=words % 2 == 0)
        want = Counter(tuple(ids[i : i + words].tolist()) for i in range(len(ids) - words + 1))
        want = {p: n for p, n in want.items() if 5 not in p}
        assert dict(zip(map(tuple, level[0].tolist()), level[3].tolist())) == want
