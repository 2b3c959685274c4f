import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import EDGES, SF_SMALL, documents  # noqa: F401
from strata.llm import queries, simhash
from strata.llm.graph import components


def brute_fingerprint(text):
    import re

    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, distance=4):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    own = sorted(fps)
    for i, a in enumerate(own):
        for b in own[:i]:
            if bin(a ^ b).count("1") <= distance:
                parent[find(a)] = find(b)
    return {f: find(f) for f in own}


@given(st.text(alphabet="abAB \t\n\x1c é", max_size=60))
@settings(max_examples=150, deadline=None)
def test_fingerprint_is_the_majority_of_shingle_hashes(text):
    assert simhash.fingerprint(text) % 2**64 == brute_fingerprint(text)


def test_query_matches_brute_force(spark):
    docs = queries.table(spark, SF_SMALL, "documents").collect()
    fps = {}
    for r in docs:
        fps.setdefault(brute_fingerprint(r["text"]), []).append(r["doc_id"])
    groups = {}
    for f, root in brute_components(list(fps)).items():
        groups.setdefault(root, []).extend(fps[f])
    want = {(i, min(ids)) for ids in groups.values() for i in ids}
    got = queries.op7_simhash(spark, SF_SMALL).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == want and len(got) == len(docs)
    assert {r["fingerprint"] for r in got} == {f"{f:016x}" for f in fps}


@pytest.mark.parametrize("n", [40, 400])
def test_link_finds_every_pair_near_and_far(spark, n):
    rng = random.Random(n)
    fps = set()
    while len(fps) < n:  # dense balls, chains and strangers
        center = rng.getrandbits(64)
        fps.add(center)
        for _ in range(rng.randrange(12)):
            x = center
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << b
            fps.add(x)
    want = brute_components(fps)
    signed = lambda f: f - 2**64 if f >> 63 else f
    got = simhash.link(spark.createDataFrame([(signed(f),) for f in fps], "fp long")).collect()
    parts = lambda pairs: {frozenset(k for k, v in pairs if v == r) for r in {v for _, v in pairs}}
    assert parts([(r["fp"] % 2**64, r["root"]) for r in got]) == parts(list(want.items()))


def test_plan_covers_all_bits_with_the_right_budget():
    bits = np.random.default_rng(0).integers(0, 2, (300, 64)).astype(np.uint8)
    bits[:, 5] = bits[:, 40]  # correlated bits share a group
    for n in (10, 10_000, 10_000_000):
        groups = simhash.plan(bits, n)
        for m in range(1, 6):
            full = simhash.group_bits(bits, m)
            assert sorted(b for g in full for b in g) == list(range(64))
        assert all(t >= 0 for _, t in groups)
    four = simhash.group_bits(bits, 4)
    assert any({5, 40} <= set(g) for g in four)


def test_edges_and_keep_one(spark, documents):
    docs = documents(EDGES)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(EDGES)
    empty = {r["component"] for r in got if r["fp"] == 0}
    assert empty == {1}  # null, empty and blank texts link at fingerprint zero; null ids count last
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == [1, 4, 5, 7, 8, 9]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one_per_group(docs.limit(0)).count() == 0


def test_unlike_texts_under_one_id_are_groups_of_their_own(spark, documents):
    unlike = [(5, "one two three four five six"), (5, "red green blue black white grey"), (6, "red green blue black white grey")]
    docs = documents(unlike, extra="root")
    assert len({r["root"] for r in simhash.near_duplicates(docs).collect()}) == 2
    kept = simhash.keep_one_per_group(docs)
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted(unlike[:2]) and kept.columns == docs.columns


def test_components_of_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100), (200, 150), (150, 200), (7, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 150: 150, 200: 150}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
