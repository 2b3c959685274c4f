"""Cross-tokenizer alignment: the query against a whole-text brute force, odd characters, edge cases, long texts."""

import collections
import hashlib
import time
from itertools import accumulate

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import EDGES, SF_SMALL, documents  # noqa: F401

from strata.llm import alignment
from strata.llm.queries import PIECES, QUERIES, vocab_path

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(vocab_path(), vocab_path(PIECES))


def whole(aligner, text):
    """Brute force: the text in one piece, byte ranges from decoded tokens, every pair of tokens of a group compared."""
    if not text:
        return None
    a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    a_bytes, b_bytes = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None
    x, y = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
    groups, links, i0, j0 = [], [], 0, 0
    for cut in sorted(set(x) & set(y)):
        i1, j1 = x.index(cut) + 1, y.index(cut) + 1
        groups.append(",".join(map(str, a[i0:i1])) + "|" + ",".join(map(str, b[j0:j1])))
        links += [(a[i], b[j]) for i in range(i0, i1) for j in range(j0, j1)
                  if max(x[i] - len(a_bytes[i]), y[j] - len(b_bytes[j])) < min(x[i], y[j])]
        i0, j0 = i1, j1
    return len(a), len(b), groups, links


def brute(aligner, rows):
    found = [(i, whole(aligner, t)) for i, t in rows]
    counts = collections.Counter(p for _, f in found if f for p in set(f[3]))
    best = collections.defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = f
            out.append((i, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links),
                        sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


def chunked(aligner, text):
    entries = next(iter(aligner.read([text])))
    if entries is None:
        return None
    links = np.frombuffer(b"".join(e[2] for e in entries), np.int64).tolist()
    n_a, groups = sum(e[0] for e in entries), ";".join(e[1] for e in entries).split(";")
    return n_a, len(links) + len(groups) - n_a, groups, sorted((p >> 32, p & 0xFFFFFFFF) for p in links)


def same(aligner, text):
    expected, got = whole(aligner, text), chunked(aligner, text)
    assert (got is None) == (expected is None), text
    assert got is None or got == (*expected[:3], sorted(expected[3])), text


def test_query_equals_brute_force(spark, aligner):
    got = QUERIES["op13_tokenizer_alignment"](spark, SF_SMALL)
    assert got.columns == COLUMNS
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(aligner, [tuple(r) for r in rows])


def test_odd_texts(aligner):
    assert aligner.by_chunk
    for text in ["", " ", "  ", "a", "a ", " a", "a  b", "a\n b", "a\n  b ", "\x00a", "é€😀́", "\U0001f9ff一ꀀx \U0001f9ff", "▁a", "ﬁ x", "a\r\nb\tc\x0b \x85 \xa0 　 x",
                 "\x1c \x1d!\x1c b", "<|endoftext|> <s> <0x0A>", "it's I'LL 12 3a!! ...", "  \n\n  x\n", "x" * 300, "​ ᠎ a ﻿ b", "n 's 's"]:
        same(aligner, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(list(" \n\t ax'1.é€😀▁\x1c\x85　<s>")), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_chunks_give_the_tokens_of_the_whole_text(aligner, text):
    same(aligner, text)


def test_ends_refine_shared_characters():
    # "€x": three byte tokens of one character, then one of its own
    assert alignment.ends([(0, 0), (0, 0), (0, 1), (1, 2)], [b"\xe2", b"\x82", b"\xac", b"x"], [0, 3, 4]) == [1, 2, 3, 4]
    assert alignment.ends([(0, 1), (0, 1), (1, 3)], [b"\xe2\x82", b"\xac", b"xy"], [0, 3, 4, 5]) == [2, 3, 5]
    assert alignment.align([1, 2, 3], [2, 3, 5], [7, 8], [3, 5]) == (["1,2|7", "3|8"], [1 << 32 | 7, 2 << 32 | 7, 3 << 32 | 8])


def test_edges_and_small_blocks(spark, documents, aligner, monkeypatch):
    docs = documents(EDGES, extra="pair")
    got = alignment.align_corpus(docs, vocab_path(), vocab_path(PIECES))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(aligner, EDGES)
    assert alignment.align_corpus(docs.limit(0), vocab_path(), vocab_path(PIECES)).count() == 0
    groups = {r.doc_id: r.groups for r in alignment.groups_of(docs.where("doc_id in (2, 4)"), vocab_path(), vocab_path(PIECES)).collect()}
    assert groups == {2: [], 4: whole(aligner, "one")[2]}


def test_blocks_of_few_links_keep_every_document(aligner):
    import pyarrow as pa

    long = pa.int64()
    schema = pa.schema([("block", long), ("doc_id", long), ("n_a", long), ("n_b", long), ("n_groups", long), ("n_links", long), ("groups_sha256", pa.string()),
                        ("links", pa.binary()), ("times", pa.binary()), ("pair", long), ("place", pa.int32()), ("docs", long)])
    block = alignment._Block()
    for i, entries in enumerate(aligner.read(["one two one", None, "two"])):
        block.add(i, entries)
    rows = block.rows(5, schema).to_pylist()
    pairs = {r["place"]: (r["pair"], r["docs"]) for r in rows if r["pair"] is not None}
    texts = [r for r in rows if r["pair"] is None]
    assert [r["doc_id"] for r in texts] == [0, 1, 2] and {r["block"] for r in rows} == {5}
    held = collections.Counter()
    for r in texts:
        at, times = np.frombuffer(r["links"], np.int32), np.frombuffer(r["times"], np.int32)
        assert times.sum() == r["n_links"]
        held.update(pairs[k][0] for k in at)
    assert dict(pairs.values()) == dict(held)


def test_long_texts(aligner):
    for text in ("\n" * 10**6, " " * 10**6, "a" + " " * 10**6 + "a", "x" * 10**6, "word " * 300_000):
        t = time.process_time()
        entries = next(iter(aligner.read([text])))
        assert b"".join(aligner.a_bytes[i] for i in aligner.a.encode(" " + text[:100], add_special_tokens=False).ids).decode() == " " + text[:100]
        assert entries and sum(e[0] for e in entries) > 0
        assert time.process_time() - t < 60
    assert len(aligner.young) + len(aligner.old) <= 2 * alignment.HELD_CHUNKS + 10_000
