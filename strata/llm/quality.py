"""Quality rules with a linear-chain CRF over the lines of a document.

Rule features (word counts, symbols, duplicate lines, repeated word windows)
reject obvious junk.  For the rest, a two-label conditional random field marks
every line as content or boilerplate by Viterbi decoding; the share of words on
content lines decides whether the document stays.  The field is trained here on
a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, filter_rows, hash_share, map_arrow, map_rows

#: About so many labelled documents fit the line model (lowest hashed ids).
MAX_TRAIN_DOCS = 2_000
EPOCHS = 4
MIN_CONTENT = 0.5
SYMBOLS = "#*$%&|<>"
WINDOW = 8
_WHITE = re.compile(r"[\x20\x09-\x0D]")
_STOPS = (b".", b"!", b"?", b":", b";", b'"')
N_FEATURES = 12


# ---------------------------------------------------------------- rule features
def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur at least twice in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)  # windows whose hash repeats; equal windows always do, so only these need a look
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    first: dict[tuple, int] = {}
    mark = np.zeros(len(words) + 1, np.int64)
    for i in np.flatnonzero(twice).tolist():
        own = tuple(words[i:i + window])
        if (j := first.setdefault(own, i)) != i:
            for at in (i, j):
                mark[at] += 1
                mark[at + window] -= 1
    return int((np.cumsum(mark) > 0).sum())


def base_features(text: str) -> tuple[int, int, int, int, int]:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)`` of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if line in seen:
            duplicates += 1
        elif _has_word(line):
            seen.add(line)
    white = sum(text.count(c) for c in " \t\n\v\f\r")
    return (len(words), len(text) - white, sum(text.count(c) for c in SYMBOLS), duplicates, repeated_words(words))


def _has_word(line: str) -> bool:
    return bool(line.strip(" \t\n\v\f\r"))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 20 or 100 * n_repeat_words > 30 * n_words


# ---------------------------------------------------------------- line features
def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature matrix and word count of every line that has a word."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        words = line.encode("utf-8", "surrogatepass").split()
        if not words:
            continue
        n, chars = len(words), max(1, len(line))
        letters = sum(map(str.isalpha, line))
        upper = sum(map(str.isupper, line))
        symbols = sum(line.count(c) for c in SYMBOLS)
        rows.append((
            1.0,
            min(np.log1p(n) / 4, 1.5),
            min(4.0 * symbols / chars, 2.0),
            min(upper / max(1, letters), 1.0),
            1.0 - letters / chars,
            min(sum(map(str.isdigit, line)) * 4 / chars, 2.0),
            float(words[-1].endswith(_STOPS)),
            float(line in seen),
            min(line.count("!") * 8 / chars, 2.0),
            1.0 - len(set(words)) / n,
            min(n, 5) / 5,
            min(chars / n / 10, 2.0),
        ))
        sizes.append(n)
        seen.add(line)
    return np.array(rows, np.float64).reshape(-1, N_FEATURES), np.array(sizes, np.int64)


# ---------------------------------------------------------------- linear-chain CRF
@dataclass
class LineField:
    """Two labels (0 boilerplate, 1 content): emission weights and label transitions."""

    weights: np.ndarray  # (features, 2)
    moves: np.ndarray    # (2, 2), from -> to

    def viterbi(self, x: np.ndarray) -> np.ndarray:
        """The most likely label of every line; ties go to content."""
        scores = (x @ self.weights).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        back, (a, b) = [], scores[0]
        for e0, e1 in scores[1:]:
            f0, f1 = b + m10 >= a + m00, b + m11 >= a + m01
            back.append((f0, f1))
            a, b = (b + m10 if f0 else a + m00) + e0, (b + m11 if f1 else a + m01) + e1
        label = int(b >= a)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return np.array(out[::-1])

    def gradient(self, x: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the log-likelihood of ``gold``: observed minus expected counts."""
        n, e = len(x), x @ self.weights
        alpha, beta = np.empty((n, 2)), np.zeros((n, 2))
        alpha[0] = e[0]
        for i in range(1, n):
            alpha[i] = np.logaddexp(*(alpha[i - 1][:, None] + self.moves)) + e[i]
        for i in range(n - 2, -1, -1):
            beta[i] = np.logaddexp(*(self.moves + e[i + 1] + beta[i + 1]).T)
        total = np.logaddexp(*alpha[-1])
        node = np.exp(alpha + beta - total)
        edge = np.zeros((2, 2))
        if n > 1:
            pair = alpha[:-1, :, None] + self.moves + (e[1:] + beta[1:])[:, None, :]
            edge = np.exp(pair - total).sum(axis=0)
            np.subtract.at(edge, (gold[:-1], gold[1:]), 1.0)
        hot = np.eye(2)[gold]
        return x.T @ (hot - node), -edge


def fit(examples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, rate: float = 0.2, decay: float = 1e-3) -> LineField:
    """Stochastic gradient ascent; a document's label is the gold label of its lines."""
    field = LineField(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)))
    share = sum(y for _, y in examples) / max(1, len(examples))
    balance = (0.5 / max(1 - share, 0.05), 0.5 / max(share, 0.05))  # rare classes weigh more
    for epoch in range(epochs):
        for x, y in examples:
            gold = np.full(len(x), y)
            w, t = field.gradient(x, gold)
            step = rate * balance[y] / (1 + epoch) / len(x)
            field.weights += step * w - rate * decay * field.weights
            field.moves += step * t - rate * decay * field.moves
    return field


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS,
          id_col: str = "doc_id", text_col: str = "text") -> LineField:
    """Fit the line field on about ``max_docs`` labelled documents (lowest hashed ids, one row an id).

    Rows without a label or text are skipped.  Without any usable row the
    weights stay zero, which marks every line as content.
    """
    own = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").alias("train_id"), "quality")
    own = own.groupBy("train_id").agg(F.max("quality").alias("quality"))
    picked = own.where(hash_share(own, ["train_id"], max_docs))
    texts = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    sample = texts.join(F.broadcast(picked), texts["id"] == picked["train_id"])  # about max_docs ids

    def make():
        def one(doc_id, text, quality):
            x, _ = line_features(text or "")
            return [(doc_id, quality, x.ravel().tolist())] if len(x) else []

        return one

    id_type = texts.schema["id"].dataType.simpleString()
    rows = map_rows(sample.select("id", "text", "quality"), make, f"id {id_type}, quality int, x array<double>")

    def learn(batches):
        import pyarrow as pa

        got = sorted((r["id"], r["quality"], r["x"]) for b in batches for r in b.to_pylist())
        examples = [(np.array(x).reshape(-1, N_FEATURES), int(y > 0)) for _, y, x in got]
        order = np.random.default_rng(1).permutation(len(examples))
        field = fit([examples[i] for i in order])
        yield pa.RecordBatch.from_pylist([{"w": field.weights.ravel().tolist(), "m": field.moves.ravel().tolist()}])

    got = map_arrow(rows.dropDuplicates(["id"]).repartition(1), learn, "w array<double>, m array<double>").first()
    return LineField(np.array(got["w"]).reshape(N_FEATURES, 2), np.array(got["m"]).reshape(2, 2))


# ---------------------------------------------------------------- documents
def judge(text: str | None, field: LineField, min_content: float = MIN_CONTENT) -> tuple:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept)``."""
    base = base_features(text or "")
    failed = base_failed(base[0], base[4])
    if base[0] == 0:
        return (*base, failed, 0.0, False)
    x, sizes = line_features(text)
    share = float(sizes[field.viterbi(x) == 1].sum() / sizes.sum())
    return (*base, failed, share, not failed and share >= min_content)


def score(docs: DataFrame, field: LineField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of rule features and the verdict per document, over whole texts.

    A null text has no words and fails the rules.  Null and repeated ids keep
    their rows; an empty table gives an empty result; extra columns are ignored.
    """
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, lambda: lambda i, text: ((i, *judge(text, field)),),
                    f"doc_id {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                    "n_repeat_words long, base_failed boolean, content_share double, kept boolean")


def keep_good(docs: DataFrame, field: LineField, text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the documents that the rules or the line model reject."""
    return filter_rows(docs, [text_col], lambda: lambda text: judge(text, field)[-1])
