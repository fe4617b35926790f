"""Repeated passages are found whole, whatever their script and however repetitive they are."""

import random

import numpy as np
import pytest

from weatherloom.llm import chunks, suffixes


def left_of(docs):
    return {r["doc_id"]: r["text"] for r in chunks.deduplicated(docs).collect()}


def words(rng, n, different):
    known = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(different)]
    return " ".join(rng.choice(known) for _ in range(n))


def test_unspaced_passage_is_found_shifted(docs_of):
    rng = random.Random(3)
    chars = [chr(c) for c in range(0x4E00, 0x5600)]
    han, code = ("".join(rng.choices(c, k=2000)) for c in (chars, "abcdef0123456789(){};="))
    for passage, filler in ((han, chars), (code, "ghijk"), ("　".join(han[i : i + 4] for i in range(0, 400, 4)), chars)):
        fronts = ["".join(rng.choices(filler, k=n)) for n in (200, 217)]
        left = left_of(docs_of([(1, fronts[0] + passage), (2, fronts[1] + passage)]))
        assert left == {1: fronts[0] + passage, 2: fronts[1]}


@pytest.mark.parametrize("different", [51, 8, 2])
def test_passages_of_51_words_go_whole(docs_of, different):
    rng = random.Random(different)
    rows, ends = [], {}
    for k in range(60):
        passage = words(rng, 51, different)
        fronts = [f"<{2 * k + i}> {words(rng, 30, 30)} <" for i in (0, 1)]
        rows += [(2 * k + i, f"{fronts[i]}{passage}>{i}") for i in (0, 1)]
        ends[2 * k + 1] = (fronts[1], ">1", len(passage))
    left = left_of(docs_of(rows))
    assert all(left[2 * k] == rows[2 * k][1] for k in range(60)) or different == 2
    for doc, (front, back, size) in ends.items():
        if size >= chunks.SURE_BYTES:
            # The bytes beside a passage may happen to be equal as well, and parts of it may stand in it before.
            assert len(left[doc]) <= len(front) + len(back)


def test_border_bytes_and_characters(docs_of):
    passage = words(random.Random(1), 51, 51)
    # é and è share their first byte, which is not a character
    left = left_of(docs_of([(1, "one é" + passage + "é end"), (2, "two ©" + passage + "è fin")]))
    assert left[2] == "two ©è fin"


def test_periodic_text_has_few_chunks():
    for unit in (b"ab", b"x", b"one two three, ", b"a bit longer than one half of the window "):
        ends, digests = chunks._digested(np.frombuffer(unit * 20000, np.uint8)[:40000])
        moved, others = chunks._digested(np.frombuffer(b"something else" + unit * 20000, np.uint8)[:40000])
        assert len(ends) < 2000 and len(set(digests[1:-1])) <= 2 and set(digests[2:-2]) == set(others[6:-2])


def test_joined_chunks_and_extension():
    hits = [(10, 50, 1, 5, 40), (60, 64, 1, 5, 90), (60 + 300, 64, 1, 5, 390), (100, 64, 2, 6, 0)]
    assert sorted(chunks.joined_chunks(hits)) == [(10, 124, 1, 5, 40, 154), (100, 164, 2, 6, 0, 64), (360, 424, 1, 5, 390, 454)]
    data = np.frombuffer("abcé-é".encode(), np.uint8)
    assert chunks.extended(data, 3, 5, b"xbc", "-è".encode()) == (1, 6)


def test_short_repeats_stay(docs_of):
    rng = random.Random(8)
    fifty, less = (words(rng, n, 60) for n in (50, 30))
    rows = [(1, f"one {less}. {fifty} end"), (2, f"two {less}, {fifty} fin")]
    left = left_of(docs_of(rows))
    assert left[1] == rows[0][1] and less in left[2] and fifty not in left[2]


def test_different_texts_under_one_id_lose_what_they_share(docs_of):
    passage = words(random.Random(5), 60, 60)
    for doc_id in (7, None):
        rows = [(doc_id, f"one {passage} end"), (doc_id, f"two {passage} fin"), (doc_id, f"two {passage} fin")]
        left = [r["text"] for r in chunks.deduplicated(docs_of(rows)).collect()]
        assert sum(passage in t for t in left) in (1, 2) and len({t for t in left if passage in t}) == 1


def test_texts_that_collide_in_a_polynomial_hash_stay(docs_of):
    """Two texts without a common 400-byte string whose difference vanishes in any polynomial hash modulo 2**64 with an odd base."""
    difference = np.array([4], np.int64)
    for n in (1, 2, 4, 8, 16, 16, 32, 32, 64, 64, 400):
        difference = np.convolve(difference, [-1] + [0] * (n - 1) + [1])
    assert len(difference) == 640 and np.abs(difference).max() <= 32 and not difference[240:400].any()
    base = int(suffixes._BASE)
    assert sum(int(d) * pow(base, i, 1 << 64) for i, d in enumerate(difference)) % (1 << 64) == 0
    rng = np.random.default_rng(0)
    for _ in range(5000):  # until the one anchor that both have stands for all their windows
        one = np.where(difference < 0, 100, 60) + rng.integers(0, 20, 640)
        texts = [one.astype(np.uint8), (one + difference).astype(np.uint8)]
        found = [suffixes.anchored_windows(t) for t in texts]
        if all(len(f[0]) == 1 for f in found) and found[0][0][0] == found[1][0][0]:
            break
    else:
        raise AssertionError("no such pair")
    texts = [t.tobytes().decode("ascii") for t in texts]
    assert not {texts[0][i : i + 400] for i in range(241)} & {texts[1][i : i + 400] for i in range(241)}
    left = suffixes.without_repeats(docs_of([(1, texts[0]), (2, texts[1])]))
    assert {(r["doc_id"], bytes(r["kept"]).decode()) for r in left.collect()} == {(1, texts[0]), (2, texts[1])}
