import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF_CHECK, SF_SMALL
from llm_cases import EDGES, documents  # noqa: F401
from strata.llm import lm, queries


def random_model(seed=0):
    rng = np.random.default_rng(seed)
    model = lm.GatedModel(rng.random(lm.VOCABULARY) + 0.01, seed)
    return model, rng


def slow_score(model, ids, end):
    """One document, one token at a time, straight from the definition."""
    h, total, before = np.zeros(lm.HIDDEN), 0.0, end
    k = lm.HIDDEN
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for token in ids:
        x, back = model.inputs[before].astype(float), h @ model.rec.astype(float)
        z, r = sigmoid(x[:k] + back[:k]), sigmoid(x[k:2 * k] + back[k:2 * k])
        n = np.tanh(x[2 * k:] + r * back[2 * k:])
        h = (1 - z) * n + z * h
        c, w = divmod(int(token), lm.CLASS_SIZE)
        a, b = h @ model.class_w + model.class_b, h @ model.word_w[c] + model.word_b[c]
        total += a[c] - np.logaddexp.reduce(a) + b[w] - np.logaddexp.reduce(b)
        before = token
    return total / math.log(10)


def test_streamed_scores_carry_state_over_whole_documents():
    model, rng = random_model()
    docs = [rng.integers(0, lm.VOCABULARY, n).astype(np.int32) for n in (1, 3, 200, 64, 65, 31, 7, 500)]
    got = lm.log10_scores(model, docs, 5)
    assert np.allclose(got, [slow_score(model, d, 5) for d in docs], rtol=1e-4)
    assert len(lm.log10_scores(model, [], 5)) == 0


def test_gradients_match_differences():
    model, rng = random_model(1)
    docs = [rng.integers(0, lm.VOCABULARY, n).astype(np.int32) for n in (5, 3, 9, 1)]
    (tokens, fresh, goal, _, valid), = lm.streams(docs, 7, width=2, steps=64)
    start = np.zeros((tokens.shape[1], lm.HIDDEN), np.float32)
    at = np.flatnonzero(valid.ravel())

    def total():
        _, trace = model.forward(tokens, fresh, start)
        return model.outputs(trace[-1].reshape(-1, lm.HIDDEN)[at], goal.ravel()[at]).astype(float).sum()

    _, trace = model.forward(tokens, fresh, start)
    _, grads, part = model.outputs(trace[-1].reshape(-1, lm.HIDDEN)[at], goal.ravel()[at], True)
    down = np.zeros((valid.size, lm.HIDDEN), np.float32)
    down[at] = part
    grads |= model.backward(tokens, fresh, trace, down.reshape(*tokens.shape, lm.HIDDEN))
    for name, g in grads.items():
        own = getattr(model, name)
        place = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = own[place]
        own[place] = old + 1e-2
        up = total()
        own[place] = old - 1e-2
        slope = (up - total()) / 2e-2
        own[place] = old
        assert abs(slope - g[place]) < 1e-2 * max(1, abs(slope)), name


def test_probabilities_sum_to_one():
    model, rng = random_model(2)
    hidden = rng.normal(size=(1, lm.HIDDEN)).astype(np.float32)
    every = np.arange(lm.VOCABULARY)
    assert abs(np.exp(model.outputs(np.repeat(hidden, len(every), 0), every)).sum() - 1) < 1e-4


def brute_base(docs):
    words = {k: [*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), "\n"] for k, (_, t) in enumerate(docs)}
    held = {k: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for k, (i, _) in enumerate(docs)}
    counts = Counter(w for k, ws in words.items() if not held[k] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for k, (i, _) in enumerate(docs):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words[k])
        yield (i, held[k], len(words[k]), sum(counts[w] > 0 for w in words[k]), n), base


@pytest.mark.parametrize("blocks", [None, 2_000])
def test_query_matches_brute_force_counts(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(lm, "BLOCK_BYTES", blocks)
    docs = [tuple(r) for r in queries.table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in queries.op10_lm_scoring(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for head, base in brute_base(docs):
        r = got[head[0]]
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == head
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0


def test_edges(spark, documents):  # noqa: F811
    docs = documents(EDGES, "block")
    rows = lm.score(docs).collect()
    key = lambda x: str(x)
    want = sorted(((h, round(b, 6)) for h, b in brute_base(EDGES)), key=key)
    assert sorted((((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]), round(r["base_score"], 6))
                   for r in rows), key=key) == want
    assert lm.score(docs.limit(0)).count() == 0


def test_training_helps_on_held_out_documents(spark):
    rows = queries.table(spark, SF_CHECK, "documents").select("doc_id", "text")
    got = lm.score(rows).where("held_out").collect()
    known = [r for r in got if r["n_tokens"] >= 200]
    gain = sum(r["score"] - r["base_score"] for r in known) / sum(r["n_tokens"] for r in known)
    assert gain > 0


def test_a_block_scored_in_chunks_gives_the_same_rows(spark, monkeypatch):
    import pyarrow as pa

    from strata.llm.common import arrow_schema

    counts = [("a", 5), ("b", 3), ("c", 1), (lm.END, 4)]
    vocab = lm.Vocabulary(counts, 13, 4)
    docs = pa.table({"doc_id": [1, 2, 3, 4], "text": ["a b a", None, "c zz a", "b " * 50]})
    known = pa.table({"token": [w for w, _ in counts], "n": [n for _, n in counts]})
    out = arrow_schema("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    model = lm.GatedModel(vocab.frequencies)
    whole = lm._score_block(vocab, model, docs, known, out)
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 3)
    parts = lm._score_block(vocab, model, docs, known, out)
    assert whole.drop(["score"]).equals(parts.drop(["score"]))
    assert np.allclose(whole["score"].to_numpy(), parts["score"].to_numpy())
    assert whole["n_known"].to_pylist() == [4, 1, 3, 51]


def test_the_model_grows_with_the_counted_types():
    assert lm.VOCABULARY >= 1024 and lm.HIDDEN >= 16 and lm.side(0) ** 2 == lm.VOCABULARY
    sizes = [len(lm.Vocabulary([(f"w{k:05}", 9) for k in range(9_000)], 10**7, types).frequencies) for types in (10**4, 4 * 10**5, 4 * 10**6)]
    assert sizes[0] == lm.VOCABULARY < 2_500 < sizes[1] < 8_000 <= sizes[2]
    top = [("w%05d" % k, 9) for k in range(2_000)]
    vocab = lm.Vocabulary(top, 10**7, 4 * 10**5)
    assert vocab.other not in vocab.encode([w.encode() for w, _ in top]).tolist()  # each has its own entry
    model = lm.GatedModel(vocab.frequencies)
    assert math.isclose(sum(np.exp(model.outputs(np.ones((len(vocab.frequencies), lm.HIDDEN), np.float32),
                                                 np.arange(len(vocab.frequencies))))), 1, rel_tol=1e-4)


def zipf_model(seed=3):
    vocab = lm.Vocabulary([(f"w{k:04}", 10**6 // (k + 1)) for k in range(1_500)] + [(lm.END, 900)], 2 * 10**7, 10**4)
    return lm.GatedModel(vocab.frequencies, seed, vocab.bounds), vocab, np.random.default_rng(seed)


def test_classes_follow_the_frequencies():
    model, vocab, _ = zipf_model()
    widths = np.diff(vocab.bounds)
    size = len(vocab.frequencies)
    assert len(widths) == lm.side(10**4) and widths.min() >= 1 and widths.sum() == size  # no fewer classes or entries
    share = np.add.reduceat(vocab.frequencies, vocab.bounds[:-1]) / vocab.frequencies.sum()
    assert (share * widths).sum() < lm.side(10**4) / 2  # entries a token is told apart from; equal classes: side
    assert widths[model.class_of[vocab.other]] == 1
    for frequencies in (np.zeros(1024), np.ones(1024), np.r_[10.0**9, np.zeros(1023)]):
        bounds = lm.class_bounds(frequencies)
        assert len(bounds) == 33 and bounds[0] == 0 and bounds[-1] == 1024 and (np.diff(bounds) > 0).all()


def test_unequal_classes_score_as_defined_and_have_their_gradients():
    model, vocab, rng = zipf_model()
    size = len(vocab.frequencies)
    hidden, target = rng.normal(size=(300, lm.HIDDEN)).astype(np.float32), np.r_[rng.integers(0, size, 250), np.full(50, vocab.other)]

    def slow(h, token):
        c = int(np.searchsorted(vocab.bounds, token, "right")) - 1
        a, b = h @ model.class_w + model.class_b, h @ model.word_w[c] + model.word_b[c]
        return a[c] - np.logaddexp.reduce(a) + b[token - vocab.bounds[c]] - np.logaddexp.reduce(b)

    score, grads, down = model.outputs(hidden, target, True)
    assert np.allclose(score, [slow(h, t) for h, t in zip(hidden, target)], rtol=1e-4, atol=1e-4)
    assert np.allclose(score, model.outputs(hidden, target))
    every = np.arange(size)
    assert abs(np.exp(model.outputs(np.repeat(hidden[:1], size, 0), every)).sum() - 1) < 1e-3
    for place in [np.unravel_index(k, model.out.shape) for k in np.abs(grads["out"]).ravel().argsort()[-40::8]]:
        old, ends = model.out[place], []
        for change in (1e-2, -1e-2):
            model.out[place] = old + change
            ends.append(model.outputs(hidden, target).astype(float).sum())
        model.out[place] = old
        assert abs((ends[0] - ends[1]) / 2e-2 - grads["out"][place]) < 1e-2 * max(1, abs(grads["out"][place]))
    moved = hidden.copy()
    moved[:, 2] += 1e-2
    slope = (model.outputs(moved, target) - score).astype(float).sum() / 1e-2
    assert abs(slope - down[:, 2].sum()) < 2e-2 * max(1, abs(slope))


def test_words_are_split_as_before():
    import pyarrow as pa

    texts = ["  A b\x0bc\x0c\x1c d ", "", " \n", None, "Ä x Y z", "one", "\x85 e\x1fF\tg\r\n"]
    for limit in (1, 10, 10**6):
        got = []
        for lo, hi, words, lengths in lm.words_of(pa.array(texts), limit):
            ends = np.cumsum(lengths)
            assert hi - lo == len(lengths)
            got += [words.to_pylist()[e - n:e] for e, n in zip(ends, lengths)]
        assert got == [(t or "").encode().lower().split() for t in texts]
    assert [r[:2] for r in lm.words_of(pa.array([], pa.string()), 10)] == []
