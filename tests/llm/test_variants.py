"""Spelling variants: the query against brute force, cells of any size, the trie search, edge cases."""

import collections
import re
import zlib

import numpy as np
import pytest

from llm_cases import EDGES, SF_SMALL, documents  # noqa: F401

from strata.llm import variants
from strata.llm.queries import QUERIES


def near(a: str, b: str) -> bool:
    """Brute force: one inserted, deleted or replaced character."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = 1 if i is None else zlib.crc32(f"{i}:{word}".encode())
            if h % 97 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 5 and k >= 3}
    by_length = collections.defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    out, form = {}, {}
    for w, k in n.items():
        close = [x for m in (-1, 0, 1) for x in by_length[len(w) + m] if near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 2 * k:
            form[w] = best
        out[w] = len(close)
    def root(w):
        return root(form[w]) if w in form else w
    return {(w, form.get(w), root(w), n[w], out[w], n.get(form.get(w))) for w in n}


def test_query_equals_brute_force(spark):
    got = QUERIES["op12_spelling_variants"](spark, SF_SMALL)
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got_rows = got.collect()
    expected = brute([tuple(r) for r in rows])
    assert len(got_rows) == len(expected)
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got_rows} == expected


@pytest.mark.parametrize("cell_words", [2, 40])
def test_any_cell_size_gives_the_same(spark, documents, cell_words):
    """Cells and blocks of few words: the walk goes to the last level, words with equal counts are dealt out in blocks."""
    rng = np.random.default_rng(3)
    texts = []
    for i in range(60):
        words = ["".join(rng.choice(list("abcde"), rng.integers(5, 8))) for _ in range(20)]
        texts.append((i, " ".join(words * 3) + " ababa babab aabba bbaab abbaa Ãbabab ababÃ× "))
    got = variants.group_variants(documents(texts), cell_words=cell_words).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute(texts)


def test_search_finds_what_is_one_edit_away():
    rng = np.random.default_rng(5)
    for length in (5, 6):
        members = sorted({"".join(rng.choice(list("abc"), length)) for _ in range(150)})
        asked = sorted({"".join(rng.choice(list("abc"), n)) for n in (5, 6, 7) for _ in range(60)})
        vec = lambda w: [w.count("a"), w.count("b"), w.count("c")]
        budget = [(1, 1) if len(q) == length else (1, 0) if len(q) < length else (0, 1) for q in asked]
        n = [(w, 1 + zlib.crc32(w.encode()) % 5) for w in members]
        got = variants.search(n, np.array([vec(w) for w in members]), asked, np.array([vec(w) for w in asked]), np.array(budget))
        expected = []
        for q in asked:
            close = [(k, w) for w, k in n if near(q, w)]
            if close:
                k, w = min(close, key=lambda x: (-x[0], x[1]))
                expected.append((q, len(close), k, w))
        assert sorted(got) == sorted(expected)


def test_one_edit():
    cases = ["abcde", "abcdf", "abcd", "bcde", "abxcde", "abcdee", "edcba", "abc", "abced"]
    for a in cases:
        for b in cases:
            assert variants.one_edit(a, b) == near(a, b), (a, b)


def test_edges(spark, documents):
    rows = EDGES + [(20, "abcde abcde abcde abcdef abcdef abcdef"), (None, "zzzzz zzzzz zzzzz zzzzy zzzzy zzzzy zzzzz zzzzz zzzzz"),
                    (21, "a" * 300_000), (22, "longlong " * 100_000)]
    docs = documents(rows, extra="word")
    got = variants.group_variants(docs).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute(rows)
    assert variants.group_variants(docs.limit(0)).count() == 0
