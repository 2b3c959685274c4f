"""Language of web pages by Bayesian fusion of evidence.

For every page, log posterior(l) = text log-likelihood(l) + log P(declared markup
language | l) + log P(address suffix | l) + log prior(l | host).  The text model
is a naive Bayes over hashed byte trigrams, fitted on a bounded labelled sample.
The other terms come from grouped aggregations of the pages' text posteriors:
the host prior is smoothed towards its domain, the domain towards all pages, and
a page's own vote is taken out of them.
"""

from __future__ import annotations

import html as html_lib
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, hash_share, map_arrow, map_rows, materialise

#: About so many labelled documents per language train the text model (lowest hashed ids).
MAX_TRAIN_DOCS = 300
HASH_BITS = 14
#: A text counts as at most this many independent trigrams.
MAX_EVIDENCE = 100
#: Pseudo-counts: pages a parent distribution is worth.
HOST_WEIGHT, DOMAIN_WEIGHT, TABLE_WEIGHT = 5.0, 20.0, 5.0
_HIDDEN = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^<>]*>")
_DECLARED = re.compile(r"""(?is)<html\b[^<>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})\b""")
_HOST = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?(?:/([a-z]{2})(?=[/?#]|$))?")


def visible_text(html: str) -> str:
    return html_lib.unescape(_HIDDEN.sub(" ", html))


def address(url: str | None) -> tuple[str, str, str]:
    """``(host, domain, suffix)``: lower-cased host, its last two labels, and the
    last label with a two-letter first path segment if there is one."""
    m = _HOST.match(url or "")
    if not m:
        return "", "", ""
    labels = [x for x in m[1].lower().split(".") if x]
    return ".".join(labels), ".".join(labels[-2:]), (labels[-1] if labels else "") + "/" + (m[2] or "").lower()


def trigram_codes(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    mixed = (data[:-2] * np.uint32(65_599 * 65_599 % 2**32) + data[1:-1] * np.uint32(65_599) + data[2:]) * np.uint32(2_654_435_769)
    return (mixed >> np.uint32(32 - HASH_BITS)).astype(np.int64)


class TextModel:
    """Log-probabilities of hashed trigrams per language."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        p = counts + 0.5
        self.table = np.log(p / p.sum(axis=0)) if len(langs) else p

    def log_likelihood(self, text: str) -> np.ndarray:
        """Per language; a text without trigrams says nothing (zeros)."""
        codes = trigram_codes(text)
        if not len(codes):
            return np.zeros(len(self.langs))
        total = np.zeros(len(self.langs))
        for lo in range(0, len(codes), 1 << 16):
            total += self.table[codes[lo:lo + (1 << 16)]].sum(axis=0)
        return total * (min(len(codes), MAX_EVIDENCE) / len(codes))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_docs: int = MAX_TRAIN_DOCS) -> TextModel:
    """Fit on about ``max_docs`` labelled documents per language (lowest hashed ids, one row an id)."""
    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"),
                       col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    picked = F.lit(False)
    for r in rows.groupBy("lang").count().collect():  # one number per language
        picked = picked | ((F.col("lang") == r["lang"]) & hash_share(rows, ["id"], max_docs, r["count"]))
    sample = rows.where(picked).dropDuplicates(["lang", "id"]).select("lang", "text")

    def count(batches):
        import pyarrow as pa

        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = counts.setdefault(lang, np.zeros(1 << HASH_BITS, np.int64))
                own += np.bincount(trigram_codes(text), minlength=1 << HASH_BITS)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(counts), pa.string()),
                                          "counts": pa.array([c.tolist() for c in counts.values()], pa.list_(pa.int64()))})

    got = map_arrow(sample.repartition(1), count, "lang string, counts array<long>").orderBy("lang").collect()
    return TextModel([r["lang"] for r in got], np.array([r["counts"] for r in got], np.float64).reshape(
        len(got), 1 << HASH_BITS).T)


def _totals(pages: DataFrame, key: str, n: int) -> DataFrame:
    """Summed text posteriors per value of ``key`` as array column ``{key}_n``."""
    got = pages.groupBy(key).agg(*[F.sum(F.col("votes")[i]).alias(f"v{i}") for i in range(n)])
    return materialise(got.select(key, F.array(*[F.col(f"v{i}") for i in range(n)]).alias(f"{key}_n")), f"langid-{key}")


def _share(counts: Column, own: Column, parent: Column, weight: float) -> Column:
    """``(counts - own + weight * parent) / sum`` without the page's own vote."""
    raw = F.zip_with(F.zip_with(counts, own, lambda a, b: F.greatest(a - b, F.lit(0.0))), parent,
                     lambda a, p: a + F.lit(weight) * p)
    return F.transform(raw, lambda x: x / F.aggregate(raw, F.lit(0.0), lambda s, y: s + y))


def identify(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html") -> DataFrame:
    """``(page_id, host, declared, text_lang, lang, posterior)`` per page.

    ``lang`` is the language of the largest posterior (first by name on ties),
    ``text_lang`` that of the text alone.  A null html or url gives no text or
    address evidence; null and repeated ids keep their rows; an empty table
    gives an empty result; without any training text ``lang`` is null.
    """
    rows = pages.select(col(id_col).alias("page_id"), col(url_col).cast("string").alias("url"),
                        col(html_col).cast("string").alias("html"))
    id_type = rows.schema["page_id"].dataType.simpleString()
    shared, n = pages.sparkSession.sparkContext.broadcast(model), len(model.langs)

    def make():
        own = shared.value

        def one(page_id, url, html):
            m = _DECLARED.search(html or "")
            like = own.log_likelihood(visible_text(html or ""))
            like -= like.max(initial=-np.inf) if n else 0
            votes = np.exp(like)
            return [(page_id, *address(url), m[1].lower() if m else "", like.tolist(), (votes / max(votes.sum(), 1e-300)).tolist())]

        return one

    pages = map_rows(rows, make, f"page_id {id_type}, host string, domain string, suffix string, declared string, "
                                 "text array<double>, votes array<double>")
    declared = F.nullif(F.col("declared"), F.lit(""))
    if not n:
        none = F.lit(None).cast("string")
        return pages.select("page_id", "host", declared.alias("declared"), none.alias("text_lang"), none.alias("lang"),
                            F.lit(None).cast("double").alias("posterior"))
    pages = materialise(pages, "langid")
    sums = pages.agg(*[F.coalesce(F.sum(F.col("votes")[i]), F.lit(0.0)).alias(f"v{i}") for i in range(n)]).first()
    total = F.array(*[F.lit(float(v)) for v in sums])
    everywhere = F.array(*[F.lit((float(v) + 1.0) / (sum(sums) + n)) for v in sums])
    joined = pages
    for key in ("domain", "host", "declared", "suffix"):
        joined = joined.join(_totals(pages, key, n), key, "left")
    domain = _share(F.col("domain_n"), F.col("votes"), everywhere, DOMAIN_WEIGHT)
    prior = _share(F.col("host_n"), F.col("votes"), F.col("domain_p"), HOST_WEIGHT)

    def table(key: str) -> Column:  # P(value | language), up to a factor that is the same for all languages
        others = F.zip_with(F.col(f"{key}_n"), "votes", lambda a, b: F.greatest(a - b, F.lit(0.0)))
        base = F.aggregate(F.col(f"{key}_n"), F.lit(0.0), lambda s, x: s + x) / F.lit(max(sum(sums), 1e-9))
        return F.when(F.col(key) == "", F.transform(total, lambda _: F.lit(0.0))).otherwise(F.zip_with(
            others, total, lambda a, t: F.log((a + TABLE_WEIGHT * base) / (t + TABLE_WEIGHT))))

    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    names = F.array(*[F.lit(x) for x in model.langs])
    best = lambda a: F.get(names, F.array_position(a, F.array_max(a)).cast("int") - 1)
    scored = joined.withColumn("domain_p", domain).select(
        "page_id", "host", declared.alias("declared"), best(F.col("text")).alias("text_lang"),
        plus(plus(F.col("text"), F.transform(prior, lambda p: F.log(p))), plus(table("declared"), table("suffix"))).alias("log_p"))
    top = F.array_max("log_p")
    return scored.select("page_id", "host", "declared", "text_lang", best(F.col("log_p")).alias("lang"),
                         (1 / F.aggregate("log_p", F.lit(0.0), lambda s, x: s + F.exp(x - top))).alias("posterior"))
