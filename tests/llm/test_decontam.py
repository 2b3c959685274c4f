import random
import tracemalloc

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import EDGES, SF_CHECK, documents  # noqa: F401
from strata.llm import decontam, queries


@given(st.lists(st.lists(st.sampled_from("abcdefghij"), min_size=1, max_size=9), min_size=1, max_size=40),
       st.sets(st.sampled_from("abcdefghijz"), max_size=8), st.sampled_from([0.2, 0.5, 0.8]))
@settings(max_examples=200, deadline=None)
def test_block_max_wand_retrieves_all_above_the_threshold(items, query, threshold):
    index = decontam.BlockMaxIndex([(i, " ".join(words)) for i, words in enumerate(items)], segment=3, block=2)
    terms = sorted(index.terms[w] for w in query if w in index.terms)
    scores = {}
    for t in terms:
        for d, x in zip(*index.postings[t]):
            scores[d] = scores.get(d, 0.0) + x
    want = {d for d, x in scores.items() if x >= threshold - 1e-9}
    got = index.search(terms, threshold)
    assert {d for d, _ in got} == want and len(got) == len(want)
    assert all(abs(scores[d] - x) < 1e-9 for d, x in got)


def test_screening_drops_no_match():
    rng = random.Random(3)
    items = [(i, " ".join("w%d" % rng.randrange(300) for _ in range(40))) for i in range(50)]
    index = decontam.BlockMaxIndex(items)
    text = " ".join("w%d" % rng.randrange(300) for _ in range(500)).split()
    for i in (3, 17):
        at = rng.randrange(450)
        text[at:at] = items[i][1].split()
    assert {3, 17} <= set(index.matches(" ".join(text)))


def test_query_finds_every_item_that_stands_in_a_text(spark):
    docs = queries.table(spark, SF_CHECK, "documents").select("doc_id", "text").collect()
    items = queries.table(spark, SF_CHECK, "benchmark").collect()
    want = {(d["doc_id"], b["item_id"]) for d in docs for b in items if b["text"] in d["text"]}
    got = queries.op4_benchmark_decontamination(spark, SF_CHECK).collect()
    assert want and want <= {(r["doc_id"], r["item_id"]) for r in got}
    whole = {d["doc_id"]: " ".join(decontam.words_of(d["text"])) for d in docs}
    text = {b["item_id"]: decontam.question_answer(b["text"]) for b in items}
    for r in got:  # nothing else comes back: question shingles and answer words are there
        q, a = text[r["item_id"]]
        grams = decontam.shingles(q)
        assert sum(" ".join(g) in whole[r["doc_id"]] for g in grams) >= 0.8 * len(grams)
        assert len(set(a) & set(whole[r["doc_id"]].split())) >= 0.8 * len(set(a))


def test_edges_and_drop(spark, documents):
    item = "Which river flows through the old town of the eastern province and then into the sea? The long green river does"
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "?"), (None, "unrelated words only")],
                                  "item_id long, text string")
    docs = documents(EDGES + [(80, "before " * 50 + item.upper() + " after" * 90), (81, item[:50])], "score")
    got = decontam.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(80, 1)}
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(EDGES) + 1
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0 and decontam.drop_contaminated(docs.limit(0), bench).count() == 0


def test_scores_do_not_depend_on_the_number_of_indexes(spark, documents, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join("t%d" % min(rng.randrange(900), rng.randrange(900)) for _ in range(rng.randrange(20, 90)))) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    docs = documents([(i, "x " + t + " y") for i, t in items] + [(100 + i, t[:int(len(t) * 0.9)]) for i, t in items])
    found = []
    for size in (decontam.SHARD_CHARS, 6_000, 500):
        monkeypatch.setattr(decontam.write_indexes, "__defaults__", ("item_id", "text", size))
        assert len(list(decontam.read_indexes(decontam.write_indexes(bench)))) > 1 or size > 6_000
        found.append({tuple(r) for r in decontam.contaminated(docs, bench).collect()})
    assert found[0] == found[1] == found[2] and {(i, i) for i, _ in items} <= {r[:2] for r in found[0]}
    kept = {r["doc_id"] for r in decontam.drop_contaminated(docs, bench).collect()}
    assert kept == set(range(100, 160)) - {r[0] for r in found[0]}


def test_screen_of_a_very_long_text_is_bounded():
    rng = random.Random(4)
    items = [(i, " ".join("w%d" % min(rng.randrange(4000), rng.randrange(4000)) for _ in range(60))) for i in range(3000)]
    index = decontam.BlockMaxIndex(items)
    text = ["w%d" % rng.randrange(4000) for _ in range(300_000)]
    for at, i in ((5, 7), (150_001, 2_000), (299_900, 2_999)):
        text[at:at] = items[i][1].split()
    ids = np.fromiter((index.terms.get(w, -1) for w in text), np.int64, len(text))
    tracemalloc.start()
    slots = index.screen(ids, decontam.MIN_SCORE)
    assert tracemalloc.get_traced_memory()[1] < 200 * 1024 * 1024
    tracemalloc.stop()
    assert {7, 2_000, 2_999} <= set(index.matches(" ".join(text)))
    assert slots == sorted(set(slots))
