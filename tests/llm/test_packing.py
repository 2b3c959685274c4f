import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_cases import EDGES, SF_SMALL, documents  # noqa: F401
from strata.llm import packing, queries

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(VOCAB)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_tokenizer_files(text):
    assert [*packing.encoder(VOCAB)(text), 2] == ids_of(text)


def test_special_token_text_is_the_special_id():
    assert packing.encoder(VOCAB)("a <|endoftext|> b") == TOKENIZER.encode("a <|endoftext|> b", add_special_tokens=False).ids


def brute_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@given(st.lists(st.integers(1, 50), max_size=120))
@settings(max_examples=200, deadline=None)
def test_histogram_plan_is_best_fit_decreasing(lengths):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    used, ranks = {}, {}
    for length, rank, count, first, offset in packing.best_fit(histogram, 50):
        for k in range(count):
            used.setdefault(first + k, []).append((offset, length))
            ranks.setdefault(length, []).append(rank + k)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    rooms = []
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        rooms.append(50 - at)
    assert sorted(rooms) == brute_best_fit(lengths, 50)


def test_capacity_tree_finds_the_tightest():
    rng, tree, have = random.Random(3), packing.CapacityTree(64), set()
    for _ in range(2000):
        room, is_open = rng.randrange(65), rng.random() < 0.5
        tree.set(room, is_open)
        (have.add if is_open else have.discard)(room)
        need = rng.randrange(65)
        assert tree.tightest(need) == min((r for r in have if r >= need), default=None)


@pytest.mark.parametrize("n,want", [(1, [(0, 1)]), (10, [(0, 10)]), (25, [(0, 5), (5, 10), (15, 10)]), (20, [(0, 10), (10, 10)])])
def test_cut(n, want):
    assert packing.cut(n, 10) == want


def check(rows, texts, capacity=1024):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for i, text in texts:
        ids, own = np.array(ids_of(text), "<u4"), sorted(by_doc[i], key=lambda r: r["piece"])
        if len([x for x, _ in texts if x == i]) > 1:
            continue
        assert [(r["start"], r["length"]) for r in own] == packing.cut(len(ids), capacity)
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in own)
    lengths = [r["length"] for r in rows]
    assert len(by_sequence) == len(brute_best_fit(lengths, capacity))


def test_query_packs_every_document(spark):
    docs = queries.table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    check(queries.op2_best_fit_packing(spark, SF_SMALL).collect(), [tuple(r) for r in docs])


def test_edges_and_real_sequences(spark, documents):
    docs = documents(EDGES)
    packed = packing.pack(docs, VOCAB, keep_ids=True)
    rows = packed.collect()
    check(rows, EDGES)
    ids = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert all(ids[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"] for r in packed.collect())
    assert packing.pack(docs.limit(0), VOCAB).count() == 0


def test_long_runs_of_white_space_are_encoded():
    from tokenizers import Tokenizer

    from strata.llm.queries import vocab_path

    exact = Tokenizer.from_file(vocab_path())
    for text in ("\n" * 10**6, " " * 10**6, "\t" * 10**6, "a" + " " * 10**6 + "a", "\u3000" * 10**6, "\r\n" * 500_000):
        assert packing.encoder(vocab_path())(text) == exact.encode(text, add_special_tokens=False).ids
