"""Secret scans: fixed patterns plus character Markov models, in DataFrame expressions only.

Two first-order Markov chains over characters, one of random strings and one of
ordinary identifiers, are trained from labelled samples; a long token whose
mean log-likelihood ratio per distinct transition exceeds a threshold that falls
with their number is reported as kind ``markov``.  Samples: random strings are the pattern
hits of the corpus and digests of ids in hexadecimal and base 64; ordinary
identifiers are the words of all documents outside the pattern hits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, hash_share

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Same matches as AKIA[A-Z0-9]+ and [0-9a-f]+ with the short ones dropped: both are maximal runs.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIN_VALUE = 12
_AFTER = r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""
_WORD = r"(?i:password|passwd|secret|token|api_?key)"
#: What the patterns look at (assignments of any length): the Markov chains read the text around it.  A run of
#: an access key or of hex digits may end in the key word of an assignment.
_KEYED = rf"(?:[A-Za-z_]{{0,8}}(?<={_WORD}){_AFTER}+)?"
PATTERNS = rf"(?:{_WORD}{_AFTER}+|{ACCESS}[0-9a-f]*{_KEYED}|{HEX}{_KEYED})"
_STARTS = rf"(?:{_WORD}{_AFTER}|AKIA[A-Z0-9]{{14}}|[0-9a-f]{{16}})"
MIN_TOKEN = 12
TOKEN = rf"(?:(?!{_STARTS})[A-Za-z0-9+/_=-]){{{MIN_TOKEN},}}"
#: About so many ids give digests as samples of random strings (lowest hashed ids).
SAMPLE_IDS = 1_000
#: Mean log-likelihood ratio (nats per transition) from which a token counts as random.
MIN_RATIO = 0.75
#: Log odds (nats) against a token being random before it is looked at: the summed ratio must outweigh them,
#: so short tokens need a higher mean.
PRIOR_ODDS = 14.0
#: Hits whose places are summed up together; keeps the cost of a text's places linear in practice.
PLACES = 64
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SMOOTHING = 0.5


# ---------------------------------------------------------------- spans
def _spans(text: Column, pattern: str, kind: int, value_group: int | None = None) -> Column:
    """Spans ``(start, kind, end)`` of all matches, leftmost first, in code points.

    The pieces between the matches and the matches themselves alternate, so
    the running total of their lengths gives the positions.
    """
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    placed = F.transform(_places(text, pattern), lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))
    if value_group is not None:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
        placed = F.filter(F.zip_with(placed, values, lambda s, v: F.when(F.length(v) >= MIN_VALUE, s)), lambda s: s.isNotNull())
    return F.when(text.rlike(pattern), placed).otherwise(empty)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` reads it inside its own lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _places(text: Column, pattern: str) -> Column:
    """``(start, end, hit)`` of all matches of ``pattern``, leftmost first, in code points.

    Running totals are taken in blocks of ``PLACES`` hits and over the blocks of
    ``PLACES`` blocks, so no long array is copied once a hit.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sized = F.zip_with(F.split(text, pattern, -1), F.concat(hits, F.array(F.lit(None).cast("string"))),
                       lambda piece, hit: F.struct(F.length(piece).alias("gap"), F.length(hit).alias("size"), hit.alias("hit")))
    empty = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def cut(items: Column) -> Column:
        last = F.ceil(F.size(items) / F.lit(PLACES)).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.slice(items, k * PLACES + 1, F.lit(PLACES)))

    def inside(block: Column) -> Column:  # a block of hits, places from its own start
        return F.aggregate(
            block, F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda s, x: F.struct(
                (s["at"] + x["gap"] + x["size"]).alias("at"),
                F.concat(s["out"], F.array(F.struct(
                    (s["at"] + x["gap"]).alias("start"), (s["at"] + x["gap"] + x["size"]).alias("end"),
                    x["hit"].alias("hit")))).alias("out")))

    def joined(blocks: Column) -> Column:  # blocks with places of their own -> one with places from the first one's start
        begin = lambda blocks: F.aggregate(
            blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda s, b: F.struct((s["at"] + b["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))
        return _let(blocks, lambda own: _let(begin(own), lambda t: F.struct(t["at"].alias("at"), F.flatten(F.zip_with(
            own, t["out"], lambda b, at: F.transform(b["out"], lambda x: F.struct(
                (at + x["start"]).alias("start"), (at + x["end"]).alias("end"), x["hit"].alias("hit"))))).alias("out"))))

    blocks = _let(F.filter(sized, lambda x: x["hit"].isNotNull()), lambda own: F.transform(cut(own), inside))
    return joined(_let(blocks, lambda own: F.transform(cut(own), joined)))["out"]


def base_spans(text: Column) -> Column:
    return F.concat(_spans(text, ASSIGN, 0, 2), _spans(text, ACCESS, 1), _spans(text, HEX, 2))


def _render(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat(
        F.get(names, s["kind"]), F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")


# ---------------------------------------------------------------- Markov model
def _transitions(tokens: DataFrame, label: str) -> DataFrame:
    """Counts of adjacent character pairs in ``tokens(token)``; equal tokens are counted once, with their number."""
    own = tokens.groupBy("token").agg(F.count("*").alias("n"))
    pairs = own.select("n", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substr("token", i, F.lit(2)))).alias("pair"))
    return pairs.groupBy("pair").agg(F.sum("n").alias("n")).select(F.lit(label).alias("label"), "pair", "n")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_ids: int = SAMPLE_IDS) -> list[float]:
    """Log-likelihood ratios ``log P(b|a, random) - log P(b|a, ordinary)`` at ``index(a) * size + index(b)``.

    Random strings: the values that the patterns find, and digests of about
    ``sample_ids`` ids; ordinary identifiers: the words of all texts outside the
    pattern hits.  The counts reaching the driver are bounded by the square of
    the alphabet.  Without training text every ratio is zero and nothing is added.
    """
    rows = docs.select(col(id_col).cast("string").alias("id"), col(text_col).cast("string").alias("text")).where("text is not null")
    hits = rows.where(F.col("text").rlike(f"{ASSIGN}|{ACCESS}")).select(F.explode(F.concat(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("text", F.lit(f"({ACCESS})"), F.lit(1)))).alias("token")).where(f"length(token) >= {MIN_VALUE}")
    digest = F.sha2(F.concat(F.lit("sample:"), F.coalesce("id", F.lit(""))), 256)
    made = rows.where(hash_share(rows, ["id"], sample_ids)).select(
        F.explode(F.array(digest, F.regexp_replace(F.base64(F.unhex(digest)), "=+$", ""))).alias("token"))
    plain = F.when(F.col("text").rlike(_STARTS), F.regexp_replace("text", PATTERNS, " ")).otherwise(F.col("text"))
    words = rows.select(F.explode(F.regexp_extract_all(plain, F.lit("[A-Za-z][A-Za-z0-9_-]{3,}"), F.lit(0))).alias("token")) \
        .where(~F.col("token").rlike("[0-9]{6,}"))
    inside = F.col("token").rlike("^[A-Za-z0-9+/_=-]{2,}$")
    counts = _transitions(hits.where(inside).union(made.where(inside)), "random").union(_transitions(words, "ordinary"))
    return ratios([(r["label"], r["pair"], r["n"]) for r in counts.collect()])


def ratios(counts: list[tuple[str, str, int]]) -> list[float]:
    size = len(ALPHABET)
    at = {c: i for i, c in enumerate(ALPHABET)}
    table = {label: [[SMOOTHING] * size for _ in range(size)] for label in ("random", "ordinary")}
    for label, pair, n in counts:
        if len(pair) == 2 and pair[0] in at and pair[1] in at:
            table[label][at[pair[0]]][at[pair[1]]] += n
    if not any(label == "ordinary" for label, _, _ in counts):
        return [0.0] * (size * size)
    return [math.log(r / sum(rr)) - math.log(o / sum(oo)) for rr, oo in zip(table["random"], table["ordinary"])
            for r, o in zip(rr, oo)]


def _random(token: Column, model: list[float], min_ratio: float) -> Column:
    """The mean ratio of the token's distinct transitions reaches ``min_ratio``, and their sum
    outweighs the odds against a random token (a repeated transition is no new evidence)."""
    size = len(ALPHABET)
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    at = F.transform(F.split(token, ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)
    steps = F.length(token) - 1
    pairs = F.array_distinct(F.zip_with(F.slice(at, F.lit(1), steps), F.slice(at, F.lit(2), steps), lambda a, b: a * size + b))
    return _let(pairs, lambda own: F.aggregate(own, F.lit(0.0), lambda s, x: s + F.get(table, x))
                >= F.greatest(min_ratio * F.size(own), F.lit(PRIOR_ODDS)))


def scan(docs: DataFrame, model: list[float], id_col: str = "doc_id", text_col: str = "text",
         min_ratio: float = MIN_RATIO) -> DataFrame:
    """Secrets of every whole text: ``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov)``.

    Base spans always stay.  The model looks at every token of ``MIN_TOKEN`` or
    more characters in the text outside the pattern hits, and adds those that
    are random by the likelihood ratio.  Null texts count as empty (no spans);
    null and repeated ids keep their rows; an empty table gives an empty result;
    extra columns are ignored; a text may hold many thousands of hits.
    """
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    either = f"{PATTERNS}|{TOKEN}"
    tokens = F.filter(_places(F.col("text"), either), lambda s: ~s["hit"].rlike(f"^{_STARTS}") & _random(s["hit"], model, min_ratio))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    more = F.when(F.col("text").rlike(TOKEN), F.transform(tokens, lambda s: F.struct(
        s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")))).otherwise(none)
    found = rows.select("doc_id", base_spans(F.col("text")).alias("base"), more.alias("more"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_render(F.col("base")), 256).alias("base_sha256"),
                        _render(F.concat("base", "more")).alias("spans"), F.size("more").cast("long").alias("n_markov"))
