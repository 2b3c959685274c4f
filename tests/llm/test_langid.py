import pytest

from conftest import SF_CHECK
from llm_cases import documents  # noqa: F401
from strata.llm import langid, queries


@pytest.mark.parametrize("url,want", [
    ("http://m.a.example.de/fr/1?x", ("m.a.example.de", "example.de", "de/fr")), ("https://u:p@H.Com:80", ("h.com", "h.com", "com/")),
    ("http://x.org/free/", ("x.org", "x.org", "org/")), (None, ("", "", "")), ("", ("", "", "")), ("nonsense", ("", "", ""))])
def test_address(url, want):
    assert langid.address(url) == want


def test_visible_text_leaves_code_out():
    assert langid.visible_text("<p>a&amp;b<script>x<y</script><!-- c --> d < e").split() == ["a&b", "d", "<", "e"]


def test_text_model_on_held_out_documents(spark):
    docs = queries.table(spark, SF_CHECK, "documents")
    model = langid.train(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1 and n_chars > 100").select("text", "lang").collect()
    right = sum(model.langs[model.log_likelihood(r["text"]).argmax()] == r["lang"] for r in held)
    assert right >= 0.98 * len(held)


def test_evidence_is_fused(spark):
    docs = queries.table(spark, SF_CHECK, "documents")
    model = langid.train(docs)
    english = docs.where("lang = 'en' and n_chars > 500").limit(40).select("text").collect()
    pages = [(i, f"http://news.site.com/{i}", f'<html lang="en"><p>{r["text"]}</p>') for i, r in enumerate(english)]
    pages += [(900, "http://news.site.com/x", "<html><p>a</p>"), (901, "http://news.site.com/y", '<html lang="en"><p>b</p>'),
              (902, None, None), (903, "http://other.org/", ""), (None, "x", "y"), (900, "http://news.site.com/x", "<html><p>a</p>")]
    df = spark.createDataFrame([(*p, "t") for p in pages], "page_id long, url string, html string, votes string").repartition(3)
    got = langid.identify(df, model).collect()
    assert len(got) == len(pages) and all(0 < r["posterior"] <= 1 + 1e-9 for r in got)
    lang = {r["page_id"]: r for r in got}
    assert lang[900]["lang"] == lang[901]["lang"] == "en"  # the host says what the text does not
    assert lang[901]["posterior"] > 0.9 and lang[903]["posterior"] < lang[901]["posterior"]
    assert langid.identify(df.limit(0), model).count() == 0
    none = langid.identify(df, langid.train(docs.limit(0))).collect()
    assert len(none) == len(pages) and all(r["lang"] is None for r in none)


def test_query_agrees_with_the_pages_languages(spark):
    rows = queries.op5_language_id(spark, SF_CHECK).join(queries.table(spark, SF_CHECK, "pages"), "page_id").collect()
    assert len(rows) == queries.table(spark, SF_CHECK, "pages").count()
    known = [r for r in rows if r["declared"] in ("en", "de", "fr", "es")]
    assert sum(r["lang"] == r["declared"] for r in known) >= 0.9 * len(known)
