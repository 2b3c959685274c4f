import random
import re
from itertools import product

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import EDGES, SF_CHECK, documents  # noqa: F401
from strata.llm import quality, queries


def brute_base(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    marked = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    lines, seen, duplicates = text.split("\n"), set(), 0
    for line in lines:
        if re.search("[^\x20\x09-\x0d]", line):
            duplicates += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(marked))


@given(st.text(alphabet="ab \n\x1c #é", max_size=120))
@settings(max_examples=200, deadline=None)
def test_base_features_match_brute_force(text):
    assert quality.base_features(text) == brute_base(text)


def test_viterbi_and_gradient_match_enumeration():
    rng = np.random.default_rng(5)
    field = quality.LineField(rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=(2, 2)))
    x, gold = rng.normal(size=(5, quality.N_FEATURES)), np.array([0, 1, 1, 0, 1])

    def total(f, path):
        return sum((x[i] @ f.weights)[y] for i, y in enumerate(path)) + sum(f.moves[a, b] for a, b in zip(path, path[1:]))

    paths = list(product((0, 1), repeat=5))
    assert tuple(field.viterbi(x)) == max(paths, key=lambda p: total(field, p))

    def log_likelihood(f):
        return total(f, gold) - np.logaddexp.reduce([total(f, p) for p in paths])

    w, m = field.gradient(x, gold)
    for name, g in (("weights", w), ("moves", m)):
        for at in ((0, 0), (1, 1)):
            own = getattr(field, name)
            old = own[at]
            own[at] = old + 1e-5
            up = log_likelihood(field)
            own[at] = old - 1e-5
            down = log_likelihood(field)
            own[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-4


def test_held_out_documents_are_judged_right(spark):
    docs, labels = (queries.table(spark, SF_CHECK, t) for t in ("documents", "labels"))
    field = quality.train(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.score(docs, field).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    clear = [r for r in rows if not r["base_failed"]]
    assert sum(r["kept"] == bool(r["quality"]) for r in clear) >= 0.97 * len(clear) and len(clear) > 100


def test_query_matches_brute_force_rules(spark):
    texts = dict(map(tuple, queries.table(spark, SF_CHECK, "documents").select("doc_id", "text").collect()))
    rows = queries.op9_quality_rules(spark, SF_CHECK).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in random.Random(1).sample(rows, 120):
        base = brute_base(texts[r["doc_id"]]) if len(texts[r["doc_id"]]) < 6000 else quality.base_features(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base
        assert r["base_failed"] == (base[0] < 20 or 100 * base[4] > 30 * base[0])
        assert not (r["base_failed"] and r["kept"])


def test_edges(spark, documents):
    docs = documents(EDGES, "kept")
    labels = spark.createDataFrame([(9, 0, 0), (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    field = quality.train(docs, labels)
    assert quality.score(docs, field).count() == len(EDGES)
    assert quality.keep_good(docs, field).columns == docs.columns
    none = quality.train(docs, labels.limit(0))
    assert not none.weights.any() and quality.score(docs.limit(0), none).count() == 0
