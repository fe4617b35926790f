"""Runs of spaces have pieces of their own, which segmentations use like any other."""

import pyarrow as pa
import sentencepiece

from weatherloom.llm import nbest, ngrams

SPACE = "▁"


def best_scores(pieces, lowest, text, n):
    """The ``n`` best scores over all pieces of the model, place by place, without stretches."""
    longest = max(map(len, pieces))
    best = [[0.0]]
    for b in range(1, len(text) + 1):
        found = [s + pieces[text[a:b]] for a in range(max(0, b - longest), b) if text[a:b] in pieces for s in best[a]]
        if text[b - 1] not in pieces:
            found += [s + lowest for s in best[b - 1]]
        best.append(sorted(found, reverse=True)[:n])
    return best[-1]


def test_runs_of_spaces_against_all_pieces():
    processor = sentencepiece.SentencePieceProcessor(model_proto=nbest.read_model())
    ids = [i for i in range(processor.get_piece_size()) if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i))]
    scores = {processor.id_to_piece(i): processor.get_score(i) for i in ids}
    lowest = min(s for s in scores.values() if s > -1e8) - 10.0
    scores = {p: max(s, lowest) for p, s in scores.items()}
    assert sum(set(p) == {SPACE} for p in scores) == 15
    texts = [" " * k + "def f" for k in range(2, 41)] + ["a" + " " * k + "b" + " " * (60 - k) + "cd  e " for k in range(1, 60, 7)]
    texts += [" " * k for k in (1, 2, 16, 47, 48, 200)]
    encoder = nbest.Encoder(nbest.Vocabulary(nbest.read_model()))
    data, offsets = ngrams.text_bytes(pa.array(texts))
    tokens, ends, ranked = encoder.encode(data, offsets, 4)
    for i, text in enumerate(texts):
        own = tokens[ends[i] : ends[i + 1]]
        assert [r["score"] for r in ranked[i]] == best_scores(scores, lowest, SPACE + text.replace(" ", SPACE), 4)
        assert sum(scores[processor.id_to_piece(t)] for t in own.tolist()) == ranked[i][0]["score"]
        assert encoder.decode(own).decode() == text
    code = encoder.encode(*ngrams.text_bytes(pa.array([" " * 15 + "x"])), 1)[0].tolist()
    assert processor.id_to_piece(code[0]) == SPACE * 16 or len(code) <= 3


def test_ids_are_the_best_sum_and_not_the_merges_of_the_library():
    processor = sentencepiece.SentencePieceProcessor(model_proto=nbest.read_model())
    text = "the quick brown fox jumps over the lazy dog while nobody looks at tokenization"
    ids = nbest.Encoder(nbest.Vocabulary(nbest.read_model())).encode(*ngrams.text_bytes(pa.array([text])), 1)[0].tolist()
    merged = processor.encode(text)
    assert sum(map(processor.get_score, ids)) > sum(map(processor.get_score, merged)) and len(ids) > len(merged)
    assert "is not what the library's encode gives" in nbest.encoded.__doc__
