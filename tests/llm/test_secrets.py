import base64
import hashlib
import random
import re
import string
import time

from conftest import SF_CHECK
from llm_cases import EDGES, documents  # noqa: F401
from strata.llm import queries, secrets

ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def render(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


HEX, B64 = hashlib.sha256(b"x").hexdigest(), base64.b64encode(hashlib.sha256(b"y").digest()).decode().rstrip("=")
CASES = [*EDGES, (20, f"token = \"{HEX}\" and AKIA{'Z9' * 8}"), (21, "secret:password: abcdefghijklmnop token=token=abcdefghijklm"),
         (22, "Password='short' API_KEY:  aaaaaaaaaaaa apikey=bbbbbbbbbbbbb"), (23, "AKIAAKIA1234 AKIA AKIAAKIA" + "A" * 20),
         (24, f"é👩 {HEX[:15]} {HEX[:16]}g{HEX} é"), (25, f"plain {B64}x9 some_long_identifier_name_2 internationalization1234"),
         (26, "İapi_key=abcdefghijklmno PASſWORD=abcdefghijklmno toKen=abcdefghijklmno"), (27, (HEX + " ") * 300)]


def test_edges_match_the_plain_patterns(spark, documents):  # noqa: F811
    docs = documents(CASES, "spans")
    model = secrets.train(queries.table(spark, SF_CHECK, "documents"))
    got = secrets.scan(docs, model).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    want = {(i, t): brute_base(t) for i, t in CASES}
    assert len(got) == len(CASES)
    for i, spans in sorted(((i, s) for (i, _), s in want.items()), key=key):
        rows = [r for r in got if r["doc_id"] == i]
        assert any(r["base_sha256"] == hashlib.sha256(render(spans).encode()).hexdigest()
                   and (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
                   and set(render(spans).split(",")) <= set(r["spans"].split(",")) | {""} for r in rows), i
    added = {r["doc_id"]: r["spans"] for r in got if r["n_markov"]}
    # random by their characters: the base 64 string, and values that the patterns leave out (15 hex digits, a short
    # key, values after a word that is no key word); a repeated character and long names are not
    assert set(added) == {21, 23, 24, 25, 26} and added[25] == f"markov:6:{6 + len(B64) + 2}"
    assert added[24].split(",")[0] == "markov:3:18"
    assert secrets.scan(docs.limit(0), model).count() == 0
    assert not any(secrets.train(docs.limit(0)))


def test_query_matches_the_plain_patterns(spark):
    texts = dict(map(tuple, queries.table(spark, SF_CHECK, "documents").select("doc_id", "text").collect()))
    got = queries.op8_secret_scan(spark, SF_CHECK).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["base_sha256"] == hashlib.sha256(render(brute_base(texts[r["doc_id"]])).encode()).hexdigest()


def test_model_separates_held_out_strings(spark):
    model = secrets.train(queries.table(spark, SF_CHECK, "documents"))
    size, at = len(secrets.ALPHABET), {c: i for i, c in enumerate(secrets.ALPHABET)}
    mean = lambda t: sum(model[at[a] * size + at[b]] for a, b in zip(t, t[1:])) / (len(t) - 1)
    random_ones = [base64.b64encode(hashlib.sha256(b"held%d" % i).digest()).decode()[:40] for i in range(200)]
    plain = ["theraininthenation" + w for w in ("something", "Overthere", "inandoutof", "notthisone")]
    assert sum(mean(t) >= secrets.MIN_RATIO for t in random_ones) >= 190 and all(mean(t) < secrets.MIN_RATIO for t in plain)


def test_no_python_on_the_path(spark):
    plan = queries.op8_secret_scan(spark, SF_CHECK)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def random_tokens(length, alphabet, n=200):
    rng = random.Random(length)
    return ["".join(rng.choice(alphabet) for _ in range(length)) for _ in range(n)]


ALNUM = string.ascii_letters + string.digits


def test_recall_and_false_hits_on_held_out_labelled_strings(spark, documents):  # noqa: F811
    table = queries.table(spark, SF_CHECK, "documents")
    model = secrets.train(table.where("doc_id % 2 = 0"))
    made = [(1000 * k + i, f"set {t} as it is") for k, (n, a) in enumerate(
        [(12, ALNUM), (16, ALNUM), (20, ALNUM), (32, ALNUM), (20, string.ascii_letters)]) for i, t in enumerate(random_tokens(n, a))]
    got = [r["doc_id"] // 1000 for r in secrets.scan(documents(made), model).where("n_markov > 0").collect()]
    assert [got.count(k) >= share * 200 for k, share in enumerate((0.85, 0.95, 0.97, 0.99, 0.95))] == [True] * 5
    rest = secrets.scan(table.where("doc_id % 2 = 1"), model).select("doc_id", "spans").where("n_markov > 0").collect()
    texts = dict(map(tuple, table.select("doc_id", "text").collect()))
    for r in rest:  # nothing found in prose alone
        spans = [s.split(":") for s in r["spans"].split(",")]
        assert all(re.search("[0-9+/=_-]", texts[r["doc_id"]][int(a):int(b)]) for k, a, b in spans if k == "markov")


def test_added_spans_touch_no_pattern_hit(spark, documents):  # noqa: F811
    rng, rnd = random.Random(6), random_tokens(18, ALNUM, 60) + random_tokens(30, ALNUM, 60)
    parts = ["api_key=", "APIKEY: ", "token=", "password = ", "AKIA" + "Q7" * 8, HEX[:20], HEX[:15], " ", " ", "é", "=", "/", "secret"]
    docs = [(i, "".join(rng.choice(parts) if rng.random() < 0.6 else rng.choice(rnd) for _ in range(14))) for i in range(400)]
    got = secrets.scan(documents(docs), secrets.train(queries.table(spark, SF_CHECK, "documents"))).collect()
    texts, added = dict(docs), 0
    for r in got:
        base = brute_base(texts[r["doc_id"]])
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert sorted((a, secrets.KINDS.index(k), b) for k, a, b in spans if k != "markov") == base
        for k, a, b in spans:
            if k == "markov":
                added += 1
                assert b - a >= secrets.MIN_TOKEN and not any(x < b and a < y for x, _, y in base), texts[r["doc_id"]]
    assert added > 100


def test_many_hits_in_one_text(spark, documents):  # noqa: F811
    text = " ".join(hashlib.sha256(b"%d" % i).hexdigest() + " " + base64.b64encode(hashlib.sha256(b"%d" % i).digest())[:24].decode()
                    for i in range(20_000))
    model = secrets.train(queries.table(spark, SF_CHECK, "documents"))
    begin = time.time()
    r, = secrets.scan(documents([(1, text)]), model).collect()
    assert time.time() - begin < 60 and r["n_hex"] >= 20_000 and r["n_markov"] >= 19_000
    assert r["base_sha256"] == hashlib.sha256(render(brute_base(text)).encode()).hexdigest()
