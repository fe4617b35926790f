"""Nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables for every operator."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import LONG, PASSAGE
from weatherloom.llm import chat, chunks, decontam, langid, nbest, ngrams, quality_rules, resample, simhash, suffixes, warc


def rows_by_id(df, *columns):
    return sorted(((r["doc_id"], *(r[c] for c in columns)) for r in df.collect()), key=repr)


def test_language(odd_docs):
    model = langid.fit(odd_docs)
    got = langid.predict(odd_docs, model, ["doc_id"])
    assert got.count() == odd_docs.count()
    und = {r["doc_id"] for r in got.filter("lang_pred = 'und'").collect()}
    assert {1, 2, 3, 10} <= und and not und & {4, 5, 6, 8}
    empty = odd_docs.limit(0)
    assert list(langid.fit(empty).blocks()) == [] and langid.predict(empty, langid.fit(empty), ["doc_id"]).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd_docs, langid.fit(empty), ["doc_id"]).collect()} == {"und"}


def test_decontamination(odd_docs, items):
    got = {(r["doc_id"], r["item_id"], r["n_shared"], r["n_item"]) for r in decontam.contained_items(odd_docs, items).collect()}
    assert {(6, 1), (7, 1), (None, 1), (8, 2), (4, None)} == {(d, i) for d, i, _, _ in got}
    assert decontam.contained_items(odd_docs.limit(0), items).count() == 0
    assert decontam.contained_items(odd_docs, items.limit(0)).count() == 0
    clean = decontam.clean_documents(odd_docs, items)
    assert clean.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in clean.collect()) == [0, 1, 2, 3, 5, 9, 10]


@pytest.mark.parametrize("share", [0.5, 0.79, 0.8, 0.9])
def test_containment_has_no_misses(spark, docs_of, share):
    rng = np.random.default_rng(3)
    items = [[f"i{k}x{j}" for j in range(n)] for k, n in enumerate((5, 6, 9, 14, 33, 36, 69))]
    docs = []
    for k, words in enumerate(items):
        cut = 4 + int(np.ceil((len(words) - 4) * share))
        docs.append((k, " ".join([*(f"f{i}" for i in rng.integers(0, 999, 400)), *words[:cut], "Z!", *(f"g{i}" for i in rng.integers(0, 999, 300))])))
    frame = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {r["doc_id"] for r in decontam.contained_items(docs_of(docs), frame).collect()}
    assert got == {k for k, w in enumerate(items) if int(np.ceil((len(w) - 4) * share)) >= (len(w) - 4) * 0.8 - 1e-9}


def test_quality_rules(odd_docs, labels):
    model = quality_rules.fit(odd_docs, labels)
    got = quality_rules.judged(odd_docs, model)
    assert got.count() == odd_docs.count()
    assert {r["n_words"] for r in got.filter("doc_id in (1, 2, 3)").collect()} == {0}
    assert got.filter("doc_id = 4").first()["n_words"] == len(LONG.split())
    assert quality_rules.judged(odd_docs, quality_rules.fit(odd_docs, labels.limit(0))).count() == odd_docs.count()
    assert quality_rules.judged(odd_docs.limit(0), model).count() == 0


CUT_TEXTS = ["a b " * 50, None, "", LONG[:9000], " " * 300 + "x" * 500 + " y", "é\n" * 300, "q " * 31 + " " * 70 + "r s", "wörd ☃ 🙂 " * 40]


@pytest.mark.parametrize("limit", [1, 3, 64, 200])
def test_ngrams_do_not_depend_on_pieces(limit):
    data, offsets = ngrams.text_bytes(pa.array(CUT_TEXTS))

    def families(limit):
        return Counter((r, f, x) for own, found in ngrams.counted(data, offsets, 1 << 16, limit) for f, (index, n) in enumerate(found) for r, x in zip(np.repeat(own, n).tolist(), index.tolist()))

    def characters(limit):
        return Counter((r, x) for own, index, n in langid._buckets(data, offsets, limit) for r, x in zip(np.repeat(own, n).tolist(), index.tolist()))

    assert families(limit) == families(1 << 20) and characters(limit) == characters(1 << 20)
    weights = np.random.default_rng(1).normal(size=(3, 1 << 10))
    for a, b in zip(ngrams.mean_weights(data, offsets, weights, limit), ngrams.mean_weights(data, offsets, weights)):
        assert np.allclose(a, b)
    matrix = np.log(np.random.default_rng(2).random((langid.BUCKETS + 1, 3)))
    cut, whole = langid.scores(data, offsets, matrix, limit), langid.scores(data, offsets, matrix)
    assert np.allclose(cut, whole) and (cut.argmax(axis=1) == whole.argmax(axis=1)).all()


def test_many_languages_in_blocks(docs_of):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice([f"{chr(97 + k)}{chr(110 - k)}{c}" for c in "aeiou"], 30)), f"l{k}") for i, k in enumerate([*range(7)] * 4)]
    docs = docs_of([*rows, (90, "12 34", None), (91, None, "l1")])
    want = sorted(langid.predict(docs, langid.fit(docs), ["doc_id"]).collect())
    assert [r["lang_pred"] for r in want[:28]] == [lang for _, _, lang in rows] and [r["lang_pred"] for r in want[28:]] == ["und"] * 2
    for at_once in (1, 3):
        got = sorted(langid.predict(docs, langid.fit(docs, langs_at_once=at_once), ["doc_id"]).collect())
        assert [r[:2] for r in got] == [r[:2] for r in want] and np.allclose([r[2] for r in got], [r[2] for r in want])


def test_training_rows_are_bounded(docs_of, labels):
    docs = docs_of([(4, f"text number {i} of many under one id") for i in range(300)] + [(5, "the other class")] * 300)
    model = quality_rules.fit(docs, labels, rows_per_class=20)
    assert quality_rules.judged(docs, model).count() == 600


def test_counts_do_not_depend_on_pieces(monkeypatch):
    texts = pa.array(["a b " * 50, None, "", LONG[:9000], "x" * 500 + " y", "é\n" * 300])
    whole = quality_rules.counts(*ngrams.text_bytes(texts))
    monkeypatch.setattr(ngrams.pieces, "__defaults__", (64,))
    cut = quality_rules.counts(*ngrams.text_bytes(texts))
    assert all((whole[c] == cut[c]).all() for c in whole)


def test_substring_dedup(odd_docs, docs_of):
    got = chunks.deduplicated(odd_docs)
    assert got.columns[:5] == odd_docs.columns[:5] and got.count() == odd_docs.count()
    text = dict(rows_by_id(got.filter("doc_id is not null"), "text"))
    assert text[1] is None and text[2] == "" and text[4] == LONG and text[6] == PASSAGE and len(text[7]) < 100
    assert chunks.deduplicated(odd_docs.limit(0)).count() == 0
    shifted = docs_of([(1, "start " + PASSAGE), (2, "an insertion moves it " + PASSAGE)])
    left = dict(rows_by_id(chunks.deduplicated(shifted), "text"))
    assert left[1] == "start " + PASSAGE and len(left[2]) < 150


def test_chunks_cover_the_text():
    for text in (LONG, "x" * 5000, "é" * 3000, "", "short", PASSAGE):
        data = np.frombuffer(text.encode(), np.uint8)
        ends = chunks.chunk_ends(data)
        parts = [data[a:b].tobytes() for a, b in zip([0, *ends], ends)]
        assert b"".join(parts).decode() == text and all(p.decode() for p in parts) and all(len(p) <= chunks.LONG_CHUNK for p in parts[1:-1])


def test_chat(spark):
    rows = [
        (1, 1, "assistant", "b\\"), (1, 0, "user", None), (1, 1, "assistant", "b\\"), (None, 0, None, "</turn>\n### x:\n"), (2, None, "a:\nb\\;n", ""),
        (2, 5, "assistant", "### </turn>" * 3 + LONG),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns)).collect()}

    def digest(*turns):
        return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()

    assert got[1]["turns_sha256"] == digest(("user", ""), ("assistant", "b\\"), ("assistant", "b\\")) and got[1]["loss_chars"] == 4
    assert got[None]["turns_sha256"] == digest(("", "</turn>\n### x:\n")) and got[None]["loss_chars"] == 0
    assert got[2]["turns_sha256"] == digest(("a:\nb\\;n", ""), rows[5][2:]) and got[2]["loss_chars"] == len(rows[5][3])
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_resampling(odd_docs, labels):
    got = resample.resampled(odd_docs, labels)
    assert got.count() == odd_docs.count()
    assert got.filter("kept and doc_id in (1, 2, 3)").isEmpty()
    assert resample.resampled(odd_docs.limit(0), labels).count() == 0
    assert resample.resampled(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert resample.resampled(odd_docs, labels, k=3).filter("kept").count() >= 3


def test_kth_largest(spark):
    values = [float(x) for x in np.random.default_rng(1).normal(0, 30, 500)] + [7.5] * 40
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 77, 300, 540):
        assert resample.kth_largest(frame, "v", k) == sorted(values, reverse=True)[k - 1]


def test_simhash(odd_docs):
    got = simhash.near_duplicates(odd_docs)
    assert got.count() == odd_docs.count()
    class_of = dict(rows_by_id(got.filter("doc_id is not null"), "component_id"))
    assert class_of[1] == class_of[2] == class_of[3] == 1 and class_of[6] == 6
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0
    left = simhash.first_of_each_group(odd_docs)
    assert left.columns == odd_docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert ids.count(6) == 1 and 2 not in ids and 1 in ids and 4 in ids


def test_encoding(odd_docs):
    got = nbest.encoded(odd_docs)
    assert got.count() == odd_docs.count() and got.filter("not round_trip").isEmpty()
    back = dict(rows_by_id(nbest.decoded(got.filter("doc_id is not null")), "text"))
    assert back[9] == "▁ ☃ 🙂 \\ <0x41> ### </turn>" and back[1] == "" and back[4] == LONG
    assert nbest.encoded(odd_docs.limit(0)).count() == 0


def every_segmentation(vocabulary, text):
    if not text:
        return [(0.0, ())]
    out = []
    if text[0] not in vocabulary.ids:
        out += [(vocabulary.unknown + s, tuple(vocabulary.spelled(text[0])) + rest) for s, rest in every_segmentation(vocabulary, text[1:])]
    for n in range(1, len(text) + 1):
        if text[:n] in vocabulary.ids:
            found, score = vocabulary.ids[text[:n]]
            out += [(score + s, (found, *rest)) for s, rest in every_segmentation(vocabulary, text[n:])]
    return out


def test_nbest_against_every_segmentation():
    vocabulary = nbest.Vocabulary(nbest.read_model())
    encoder = nbest.Encoder(vocabulary)
    texts = ["Hello wo", "the, a", "sh.\nTo", "a☃b", "x▁y", " a  b ", "..... !!", "🙂é", "z" * 8]
    ids, ends, ranked = encoder.encode(*ngrams.text_bytes(pa.array(texts)), 4)
    for i, text in enumerate(texts):
        marked = "▁" + text.replace("▁", "\ud800").replace(" ", "▁")
        every = {path: score for score, path in every_segmentation(vocabulary, marked)}
        assert [r["score"] for r in ranked[i]] == sorted(every.values(), reverse=True)[:4]
        paths = set()
        for r in ranked[i]:
            path = ids[ends[i] : ends[i + 1]].tolist()
            for e in reversed(r["edits"]):
                path[e["at"] : e["at"] + e["drop"]] = e["put"]
            assert every[tuple(path)] == r["score"] and len(path) == r["n_tokens"]
            paths.add(tuple(path))
        assert len(paths) == len(ranked[i])


def brute_repeats(texts, n=400):
    seen = {}
    for t in texts:
        for i in range(len(t) - n + 1):
            seen[t[i : i + n]] = seen.get(t[i : i + n], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                gone[i : i + n] = True
        out.append(bytes(b for b, g in zip(t, gone) if not g))
    return out


@pytest.mark.parametrize("group_size", [256, 3, 1])
def test_suffix_dedup_against_every_window(docs_of, group_size):
    rng = np.random.default_rng(5)
    letters = "".join(rng.choice(list("abcdefgh é\n"), 1500))
    rows = [(i, f"{i}" * int(rng.integers(0, 90)) + letters[int(rng.integers(0, 300)) : int(rng.integers(500, 1500))] + "!" * int(rng.integers(0, 60))) for i in range(14)]
    rows += [(20, "ab" * 700), (21, "q" * 399), (22, "r" * 401), (23, None), (None, ""), (24, rows[0][1]), (25, letters[:400]), (26, letters[:399])]
    got = rows_by_id(suffixes.without_repeats(docs_of(rows), group_size=group_size).select("doc_id", "kept", "n_shared"), "kept", "n_shared")
    texts = [(t or "").encode() for _, t in rows]
    shared = [len(t) - len(left) for t, left in zip(texts, brute_repeats(texts, suffixes.SHARED_BYTES))]
    assert [(d, bytes(k), n) for d, k, n in got] == sorted(zip([d for d, _ in rows], brute_repeats(texts), shared), key=repr)


def test_suffix_dedup_on_odd_rows(odd_docs):
    got = suffixes.without_repeats(odd_docs)
    assert got.count() == odd_docs.count()
    kept = {r["doc_id"]: bytes(r["kept"]) for r in got.filter("doc_id is not null").collect()}
    assert kept[6] == b"" and kept[7] == b" more" and kept[4] == LONG.encode() and kept[1] == b"" and kept[5] == b""
    assert suffixes.without_repeats(odd_docs.limit(0)).count() == 0


PAGES = [(1, "http://a b/\r\nx", "y" * 100), (2, None, "y" * 100), (3, "u", "y" * 99), (4, "u", "y" * 99), (None, "u", "y" * 100), (6, "u", None), (7, "u", ""), (2, "v", "y" * 100)]


def test_warc(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.archived(pages).collect()), key=repr)
    want = [(1, "response", None, 100), (2, "revisit", 1, 100), (2, "revisit", 1, 100), (3, "response", None, 99), (4, "response", None, 99), (6, "response", None, 0), (7, "response", None, 0), (None, "revisit", 1, 100)]
    assert got == sorted(want, key=repr)
    assert warc.archived(pages.limit(0)).count() == 0


def test_warc_magic_inside_data_and_many_ranges(spark, tmp_path):
    rng = np.random.default_rng(2)
    payloads = [rng.bytes(int(n)) for n in rng.integers(0, 3000, 60)]
    inside = b"".join(warc.MAGIC * 2 + bytes([i]) for i in range(200))  # stored as it is, so the magic is in the member
    payloads[10] = payloads[33] = inside + rng.bytes(500)
    members = []
    for i, p in enumerate(payloads):
        body = warc.record(i, "u", p, hashlib.sha256(p).hexdigest(), None, False)
        if i % 3 == 0:
            import struct
            import zlib

            deflate = zlib.compressobj(0, zlib.DEFLATED, -15)
            packed = warc._MEMBER_HEADER + deflate.compress(body) + deflate.flush() + struct.pack("<II", zlib.crc32(body), len(body))
        else:
            packed = warc.member(body)
        members.append(packed)
    (tmp_path / "a.warc").write_bytes(b"".join(members))
    for split in ("512", "3000", "1m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            got = {r["page_id"]: bytes(r["payload"]) for r in warc.read(spark, str(tmp_path)).collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == dict(enumerate(payloads))


def test_warc_records_that_are_wrong():
    digest = hashlib.sha256(b"ab").hexdigest()
    sound = warc.record(1, "u", b"ab", digest, None, False)
    assert warc.parse(sound)[4:] == (2, digest, b"ab", None)
    for old, new, size, payload, error in [
        (b"Content-Length: 2", b"Content-Length: x", 2, b"ab", "Content-Length is no number"),
        (b"Content-Length: 2", b"Content-Length: -1", 2, b"ab", "Content-Length is no number"),
        (b"Content-Length: 2", b"Content-Length: 99", 6, b"ab\r\n\r\n", "short block; digest differs"),
        (b"Content-Length: 2", b"Content-Length: 1", 1, b"a", "long block; digest differs"),
        (b"WARC-Type: response", b"X: y", 2, b"ab", "no WARC-Type"),
        (b"\r\n\r\nab\r\n\r\n", b"", 0, b"", "header without end; short block; digest differs"),
    ]:
        got = warc.parse(sound.replace(old, new))
        assert got[0] == 1 and got[4] == size and got[6:] == (payload, error)
    revisit = warc.record(2, "u", b"ab", digest, 1, True)
    assert warc.parse(revisit)[3:] == (1, 2, digest, None, None)
    assert warc.parse(revisit.replace(b"X-Payload-Length: 2", b"X-Payload-Length: "))[3:] == (1, None, digest, None, "X-Payload-Length is no number")
    assert warc.parse(b"HTTP/1.1\r\n\r\n") is None


def test_warc_members_that_are_damaged(spark, tmp_path):
    rng = np.random.default_rng(4)
    payloads = [rng.bytes(2000) for _ in range(6)]
    members = [warc.member(warc.record(i, "u", p, hashlib.sha256(p).hexdigest(), None, False)) for i, p in enumerate(payloads)]
    members[2] = members[2][:900] + bytes(40) + members[2][940:]
    (tmp_path / "a.warc").write_bytes(b"".join(members)[:-700])
    (tmp_path / "b.warc").write_bytes(b"not an archive, " * 500)
    (tmp_path / "c.warc").write_bytes(b"")
    (tmp_path / "d.warc").write_bytes(warc.member(b"no record" * 200) * 3)
    for split in ("1500", "1m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            got = warc.read(spark, str(tmp_path)).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert {r["page_id"]: bytes(r["payload"]) for r in got if r["error"] is None} == {i: payloads[i] for i in (0, 1, 3, 4)}
        wrong = {r["page_id"] for r in got if r["error"] == "damaged or truncated member"}
        assert {2, 5} <= wrong and all(r["payload"] is None for r in got if r["error"])
        assert any(r["error"] == "no record" for r in got)


def test_chat_with_wide_offsets():
    narrow = [pa.array(["user", "assistant", "user"]), pa.array(["a\nb", "### x </turn>", ""])]
    loss, conv = np.array([False, True, False]), np.array([1, 1, 2])
    wide = [x.cast(pa.large_string()) for x in narrow]
    one, two = chat.assemble(*narrow, loss, conv), chat.assemble(*wide, loss, conv)
    assert one[0].to_pylist() == two[0].to_pylist() and str(one[1:]) == str(two[1:])


def test_pipeline_stages_on_odd_rows(spark, odd_docs, labels, items, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    items.withColumnRenamed("item_id", "item_id").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd_docs, str(tmp_path))
        got.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.columns == odd_docs.columns
        assert stage(spark, odd_docs.limit(0), str(tmp_path)).count() == 0
