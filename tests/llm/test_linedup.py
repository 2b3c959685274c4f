import random

from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import EDGES, documents  # noqa: F401
from strata.llm import linedup


@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=8), st.lists(st.integers(0, 4), max_size=8))
@settings(max_examples=200, deadline=None)
def test_shared_runs_share_a_fingerprint(shared, before, after):
    size = lambda k: 7 * k + 3
    pick = lambda lines: {h for _, _, h in linedup.winnow([b"%d" % k for k in lines], [size(k) for k in lines])}
    if sum(map(size, shared)) >= linedup.WINDOW_WORDS:
        assert pick(before + shared) & pick(shared + after)


def sentence(rng, n):
    return " ".join("w%d" % rng.randrange(10**6) for _ in range(n))


def test_later_copies_of_long_passages_go_and_the_first_stays(spark, documents):
    rng = random.Random(2)
    one_line, several = sentence(rng, 60), "\n".join(sentence(rng, 13) for _ in range(5))
    rows = [(i, "\n".join([sentence(rng, 30), one_line if i % 2 else several, sentence(rng, 30)])) for i in range(10, 40)]
    rows += [(50, sentence(rng, 40)), (51, "short common line\n" + sentence(rng, 30)), (52, "short common line\n" + sentence(rng, 30))]
    twice = sentence(rng, 55)
    rows.append((60, f"{twice}\nbetween\n\n{twice}\nend"))
    got = {r["doc_id"]: r["text"] for r in linedup.drop_repeated_runs(documents(rows)).collect()}
    for i, text in rows[:30]:
        lines = text.split("\n")
        first = i in (10, 11)
        assert got[i] == (text if first else "\n".join([lines[0], lines[-1]])), i
    assert all(got[i] == text for i, text in rows[30:33])
    assert got[60] == f"{twice}\nbetween\n\nend"


def test_every_line_keeps_its_first_copy(spark, documents):
    rng = random.Random(4)
    pool = [sentence(rng, rng.randrange(5, 70)) for _ in range(25)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    out = linedup.drop_repeated_runs(documents(rows, "runs"), report="gone").collect()
    got = {r["doc_id"]: r for r in out}
    seen = set()
    for i, text in rows:
        lines = text.split("\n")
        cut = {k for r in got[i]["gone"] or [] for k in range(r["lo"], r["hi"] + 1)}
        assert got[i]["text"] == "\n".join(x for k, x in enumerate(lines) if k not in cut)
        for k, line in enumerate(lines):
            assert k not in cut or line in seen  # only later copies go
            if len(line.split()) >= linedup.WINDOW_WORDS:
                assert (line in seen) == (k in cut)  # a long line is kept exactly once
            seen.add(line)


def test_edges(spark, documents):
    docs = documents(EDGES + [(70, "word " * 3000)], "runs")
    out = linedup.drop_repeated_runs(docs)
    assert out.columns == docs.columns and out.count() == len(EDGES) + 1
    got = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (1, None) in got and (70, "") in got and (9, "word " * 3000) in got
    assert linedup.drop_repeated_runs(docs.limit(0)).count() == 0


def test_long_repeats_around_a_line_known_from_earlier_go_whole(spark, documents):
    rng = random.Random(6)
    rows = []
    for k in range(0, 400, 10):  # which gram a window picks depends on its hash
        w, x, a, y, z = (sentence(rng, n) for n in (12, 20, 30, 20, 12))
        own = lambda *lines: "\n".join([sentence(rng, 9), *lines, sentence(rng, 9)])
        rows += [(k, own(a)), (k + 1, own(x, a, y)), (k + 2, own(x, a, y)), (k + 3, own(w, x, a, y, z)), (k + 4, own(w, x, a, y, z))]
    got = {r["doc_id"]: r["text"] for r in linedup.drop_repeated_runs(documents(rows)).collect()}
    for i, text in rows:
        lines = text.split("\n")
        want = {2: [lines[0], lines[-1]], 3: [*lines[:2], *lines[-2:]], 4: [lines[0], lines[-1]]}.get(i % 10, lines)
        assert got[i].split("\n") == want, i
