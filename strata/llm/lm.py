"""Gated recurrent language model with a class-factored softmax, in numpy inside Spark tasks.

P(token | history) = P(class | h) * P(token | class, h), h the state of a gated
recurrent unit carried through the whole document.  The model's vocabulary is
the most frequent training tokens, cut by frequency into classes of equal sums
of root frequencies; classes and entries grow with the counted types.  Other tokens share one entry and
are told apart by their smoothed corpus frequency, so every text has a proper
probability.

Training: output biases start at corpus frequencies; then every task runs
truncated back-propagation over all of its training documents from the same
start, and the parameters are averaged in two levels, weighted by tokens.

Documents are spread by hash over blocks of bounded size.  Each block hands on
its distinct tokens once; the corpus counts come back with them, and block and
counts meet in one cogroup, so no corpus vocabulary is broadcast and no table
of all token positions is shuffled.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import arrow_schema, col, map_arrow, materialise, record_batches

#: The end token; words hold no white space, so it can't be one.
END = "\n"
#: Classes and class size of the smallest model; see ``side``.
CLASSES, CLASS_SIZE, HIDDEN = 32, 32, 16
VOCABULARY = CLASSES * CLASS_SIZE
#: Back-propagation is cut after this many tokens; the state goes on.
STEPS = 64
STREAMS = 128
#: Scoring changes no parameters, so more documents run side by side there.
SCORE_STREAMS = 256
#: Rows of a softmax that are worked on at once.
ROWS = 1024
RATE = 0.1
#: Start of the squared-gradient sums; logits are held within +-LIMIT.
SQUARES, LIMIT = 1e-7, 30.0
#: Documents are gathered into chunks of this many tokens at most (or one document).
CHUNK_TOKENS = 1_500_000
BLOCK_BYTES = 16 * 1024 * 1024
#: Bytes of rows a counting task holds before it hands their distinct tokens on; it takes the words of half as much at once.
COUNT_BUFFER = 4 * BLOCK_BYTES
#: Bytes of text whose words are held at once in training and scoring.
SLICE_BYTES = 8 * 1024 * 1024
ALPHA = 0.1
#: Parameters travel to their average in slices of so many numbers.
SLICE = 16_384


def side(types: int) -> int:
    """Classes of the model, and tokens of a class in the mean: the entries are 4 times the square root of
    the counted types, ``VOCABULARY`` at least."""
    return max(CLASSES, math.ceil(2 * types ** 0.25))


def class_bounds(frequencies: np.ndarray) -> np.ndarray:
    """First entries of the classes, and the end, for entries in order of frequency.

    The classes, as many as the square root of the entries, get equal sums of the roots of the frequencies:
    the mean number of entries a token is told apart from inside its class is then about the least."""
    size, parts = len(frequencies), math.isqrt(len(frequencies))
    sums = np.concatenate(([0.0], np.cumsum(np.sqrt(frequencies + ALPHA))))
    bounds = [0]
    for k in range(parts, 1, -1):  # k classes to go: one entry each at least
        at = bounds[-1]
        goal = sums[at] + (sums[-1] - sums[at]) / k
        hi = int(np.searchsorted(sums, goal))
        if goal - sums[hi - 1] < sums[hi] - goal:
            hi -= 1
        bounds.append(min(max(hi, at + 1), size - k + 1))
    return np.array([*bounds, size])


def words_of(texts: pa.Array, limit: int) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """The words of whole texts, A-Z in lower case, a slice of rows with at most ``limit`` bytes (or one row)
    at a time: ``(first row, row after the last, all words, words of each text)``."""
    texts = pc.fill_null(texts, "")
    ends, lo = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(lo, hi - lo)))
        words, bounds = lists.flatten().cast(pa.binary()), np.zeros(hi - lo + 1, np.int64)
        np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=bounds[1:])
        full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at an end of a text leaves an empty word there
        if not full.all():
            words = words.filter(pa.array(full))
        yield lo, hi, words, np.diff(np.concatenate(([0], np.cumsum(full)))[bounds])
        lo = hi


def held_out(doc_id) -> bool:
    """crc32 of the id as text is a multiple of 10; a null id counts as empty text (held out)."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


# ---------------------------------------------------------------- the network
class GatedModel:
    """Parameters: ``inputs`` (token -> gate inputs), ``rec``, and ``out``: a column for every class, then
    one for every entry, the bias below the weights.  ``bounds`` are the first entries of the classes and
    the end (by default classes of one size); ``class_w``, ``class_b`` and, by class, ``word_w``, ``word_b``
    are views of ``out``."""

    NAMES = ("inputs", "rec", "out")

    def __init__(self, frequencies: np.ndarray, seed: int = 7, bounds: np.ndarray | None = None):
        rng, h, size = np.random.default_rng(seed), HIDDEN, len(frequencies)
        self.side = n = math.isqrt(size)
        self.bounds = np.arange(0, size + 1, n) if bounds is None else bounds
        self.class_of = np.repeat(np.arange(n, dtype=_index_type(n)), np.diff(self.bounds))
        f = frequencies + 1e-9
        mass = np.add.reduceat(f, self.bounds[:-1])
        self.inputs = rng.normal(0, 0.1, (size, 3 * h)).astype(np.float32)
        self.rec = rng.normal(0, 0.3 / math.sqrt(h), (h, 3 * h)).astype(np.float32)
        self.out = rng.normal(0, 0.1, (h + 1, n + size)).astype(np.float32)
        self.out[h] = np.concatenate((np.log(mass / mass.sum()), np.log(f / mass[self.class_of])))
        #: columns of ``out``: the classes, then the entries of every class
        self.parts = [(0, n), *((n + int(lo), n + int(hi)) for lo, hi in zip(self.bounds, self.bounds[1:]))]
        self.class_w, self.class_b = self.out[:h, :n], self.out[h, :n]
        self.word_w = [self.out[:h, lo:hi] for lo, hi in self.parts[1:]]
        self.word_b = [self.out[h, lo:hi] for lo, hi in self.parts[1:]]

    def pack(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES]).astype(np.float32)

    def unpack(self, flat: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            own = getattr(self, n)
            own[...] = flat[at:at + own.size].reshape(own.shape)
            at += own.size

    def forward(self, tokens: np.ndarray, fresh: np.ndarray, state: np.ndarray, learn: bool = True):
        """Run ``tokens`` (steps, streams) from ``state``; ``fresh`` marks document starts (zero state).

        Streams lie last inside, so that every gate is one run of memory.  Without ``learn`` only the
        states of all steps are kept, not what ``backward`` needs."""
        steps, streams = tokens.shape
        h, half = HIDDEN, np.float32(0.5)
        x = np.ascontiguousarray(self.inputs[tokens].transpose(0, 2, 1))
        rec = np.ascontiguousarray(self.rec.T)
        # sigmoid through tanh: one ufunc, no overflow; its halved argument is taken beforehand
        x[:, :2 * h] *= half
        rec[:2 * h] *= half
        kept = steps if learn else 1
        backs = np.empty((kept, 3 * h, streams), np.float32)
        gates = np.empty((kept, 2 * h, streams), np.float32)
        inner = np.empty((kept, h, streams), np.float32)
        before = np.empty((kept, h, streams), np.float32)
        after = np.empty((steps, h, streams), np.float32)
        keep, starts = (~fresh).astype(np.float32), fresh.any(axis=1).tolist()
        last = np.ascontiguousarray(state.T)
        for t in range(steps):
            k = t if learn else 0
            prev = np.multiply(last, keep[t], out=before[k]) if starts[t] else last
            back, g, own, last = backs[k], gates[k], inner[k], after[t]
            np.matmul(rec, prev, out=back)
            np.add(x[t, :2 * h], back[:2 * h], out=g)
            np.tanh(g, out=g)
            g *= half
            g += half
            np.multiply(g[h:], back[2 * h:], out=own)
            own += x[t, 2 * h:]
            np.tanh(own, out=own)
            np.subtract(prev, own, out=last)
            last *= g[:h]
            last += own
            if learn and not starts[t]:
                before[t] = prev
        return last.T, (before, gates, inner, backs[:, 2 * h:], after.transpose(0, 2, 1))

    def outputs(self, hidden: np.ndarray, target: np.ndarray, gradients: bool = False):
        """Natural-log probability of every target; with ``gradients`` also the output
        gradients of the summed log-probability and its gradient in ``hidden``."""
        h, n, size = HIDDEN, self.side, len(target)
        order = np.argsort(target.astype(_index_type(len(self.inputs))), kind="stable")  # rows of one entry, and class, lie together
        target = target[order]
        classes = self.class_of[target].astype(np.int64)
        given = np.ones((size, h + 1), np.float32)
        given[:, :h] = hidden[order]
        # only columns that can leave +-LIMIT need the clip
        reach = max(1.0, np.abs(given).max(initial=0)) * np.abs(self.out[:h]).sum(axis=0) + np.abs(self.out[h])
        far = np.logical_or.reduceat(reach > LIMIT, [lo for lo, _ in self.parts]).tolist()
        grad = np.zeros_like(self.out) if gradients else None
        score, norm = np.empty(size, np.float32), np.ones(size, np.float32)
        down, own_down = np.zeros((size, h), np.float32), np.zeros((size, h), np.float32)
        ones = np.ones(max(hi - lo for lo, hi in self.parts), np.float32)
        rows, weights = np.arange(ROWS), self.out[:, :n]
        for lo in range(0, size, ROWS):  # classes, as many rows as stay in the cache
            hi = min(size, lo + ROWS)
            part, place = given[lo:hi], (rows[:hi - lo], classes[lo:hi])
            q = part @ weights
            if far[0]:
                np.clip(q, -LIMIT, LIMIT, out=q)
            chosen = q[place]
            np.exp(q, out=q)
            sums = q @ ones[:n]
            score[lo:hi] = chosen - np.log(sums)
            if gradients:
                q *= (-1 / sums)[:, None]
                q[place] += 1
                grad[:, :n] += part.T @ q
                np.matmul(q, weights[:h].T, out=down[lo:hi])
        own = np.ascontiguousarray(self.out[:, n:].T)[target]  # the column of every target
        chosen = np.clip(np.einsum("ij,ij->i", given, own), -LIMIT, LIMIT)
        bounds = np.searchsorted(target, self.bounds).tolist()
        for (left, right), lo, hi, limit in zip(self.parts[1:], bounds, bounds[1:], far[1:]):
            if right - left == 1:  # an entry alone in its class has all of its probability
                chosen[lo:hi] = 0
            elif lo < hi:
                part, weights = given[lo:hi], self.out[:, left:right]
                q = part @ weights
                if limit:
                    np.clip(q, -LIMIT, LIMIT, out=q)
                np.exp(q, out=q)
                sums = np.matmul(q, ones[:right - left], out=norm[lo:hi])
                if gradients:
                    q /= sums[:, None]
                    np.matmul(part.T, q, out=grad[:, left:right])
                    np.subtract(own[lo:hi, :h], q @ weights[:h].T, out=own_down[lo:hi])
        score += chosen - np.log(norm)
        back = np.empty_like(order)
        back[order] = np.arange(size)
        if not gradients:
            return score[back]
        np.negative(grad[:, n:], out=grad[:, n:])
        starts = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
        several = np.diff(self.bounds)[classes[starts]] > 1
        grad[:, n + target[starts[several]]] += np.add.reduceat(given, starts, axis=0)[several].T
        down += own_down
        return score[back], {"out": grad}, down[back]

    def backward(self, tokens: np.ndarray, fresh: np.ndarray, trace, down: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of ``rec`` and ``inputs`` for ``down`` = d(score)/d(hidden), cut at the window's start."""
        before, gates, inner, fed, _ = trace
        steps, streams = tokens.shape
        h = HIDDEN
        z, r = gates[:, :h], gates[:, h:]
        # local derivatives of the whole window; the loop only carries d back in time
        local = np.empty((steps, 3, h, streams), np.float32)
        rest = 1 - z
        to_inner = np.multiply(rest, 1 - inner * inner, out=local[:, 2])
        rest *= z
        np.multiply(before - inner, rest, out=local[:, 0])
        np.multiply(to_inner * fed, r * (1 - r), out=local[:, 1])
        through = local.copy()
        through[:, 2] *= r
        keep, starts = (~fresh).astype(np.float32), fresh.any(axis=1).tolist()
        d_hidden = np.ascontiguousarray(down.transpose(0, 2, 1))
        carry, kept = np.zeros((h, streams), np.float32), np.empty((h, streams), np.float32)
        for t in range(steps - 1, -1, -1):
            d = d_hidden[t]
            d += carry
            through[t] *= d
            np.matmul(self.rec, through[t].reshape(3 * h, streams), out=carry)
            carry += np.multiply(d, z[t], out=kept)
            if starts[t]:
                carry *= keep[t]
        rec = np.matmul(before, through.reshape(steps, 3 * h, streams).transpose(0, 2, 1)).sum(axis=0)
        local *= d_hidden[:, None]
        flat = tokens.ravel().astype(_index_type(len(self.inputs)))
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        d_inputs = np.zeros_like(self.inputs)
        d_inputs[flat[starts]] = np.add.reduceat(
            local.reshape(steps, 3 * h, streams).transpose(0, 2, 1).reshape(-1, 3 * h)[order], starts, axis=0)
        return {"rec": rec, "inputs": d_inputs}


def _index_type(n: int) -> type:
    """Unsigned 16 bits where ``n`` values fit: numpy sorts those by radix."""
    return np.uint16 if n <= 1 << 16 else np.int32


# ---------------------------------------------------------------- documents as streams
def streams(docs: list[np.ndarray], end_id: int, width: int = STREAMS, steps: int = STEPS) -> Iterator[tuple]:
    """Lay documents (id arrays that close with ``end_id``) side by side in streams.

    Yields windows ``(tokens, fresh, targets, doc, valid)`` of (steps, streams);
    the input of a step is the previous token, the end token at a start.
    Longest documents first onto the shortest stream; streams that have run out
    are left away, so a very long document ends up alone in narrow windows.
    """
    width = max(1, min(width, len(docs)))
    heap, lanes = [(0, k) for k in range(width)], [[] for _ in range(width)]
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        size, k = heapq.heappop(heap)
        lanes[k].append(i)
        heapq.heappush(heap, (size + len(docs[i]), k))
    lanes = sorted((lane for lane in lanes if lane), key=lambda lane: -sum(len(docs[i]) for i in lane))
    sizes = np.array([sum(len(docs[i]) for i in lane) for lane in lanes], np.int64)
    laid = [i for lane in lanes for i in lane]  # all documents, stream after stream
    lengths = np.array([len(docs[i]) for i in laid], np.int64)
    goal = np.concatenate([docs[i] for i in laid]) if laid else np.zeros(0, np.int32)
    owner = np.repeat(np.array(laid, np.int32), lengths)
    first = np.zeros(len(goal), bool)
    first[np.cumsum(lengths) - lengths] = True
    given = np.concatenate(([end_id], goal[:-1])).astype(np.int32)
    given[first] = end_id
    begin = np.cumsum(sizes) - sizes
    for at in range(0, int(sizes.max(initial=0)), steps):
        active = int((sizes > at).sum())
        n = min(steps, int(sizes[0]) - at)
        step = np.arange(at, at + n)[:, None]
        valid = step < sizes[:active]
        place = begin[:active] + np.minimum(step, sizes[:active] - 1)  # past its end a stream repeats its last step
        yield given[place], first[place] & valid, goal[place], owner[place], valid


def fit(model: GatedModel, docs: list[np.ndarray], end_id: int, squares: dict[str, np.ndarray], rate: float = RATE) -> None:
    """One pass of truncated back-propagation with Adagrad steps over whole documents."""
    state, full = None, 1
    width = max(8, min(STREAMS, sum(map(len, docs)) // (256 * STEPS)))  # small chunks take more, smaller steps
    for tokens, fresh, goal, _, valid in streams(docs, end_id, width):
        active = tokens.shape[1]
        if state is None:
            state, full = np.zeros((active, HIDDEN), np.float32), tokens.size
        start = state = state[:active]
        state, trace = model.forward(tokens, fresh, start)
        at = np.flatnonzero(valid.ravel())
        hidden = trace[-1].reshape(-1, HIDDEN)[at]
        _, grads, part = model.outputs(hidden, goal.ravel()[at], gradients=True)
        down = np.zeros((valid.size, HIDDEN), np.float32)
        down[at] = part
        grads |= model.backward(tokens, fresh, trace, down.reshape(*tokens.shape, HIDDEN))
        met = np.flatnonzero(np.bincount(tokens.ravel()))  # the other inputs have no gradient, so no step
        for name, g in grads.items():
            rows = met if name == "inputs" else slice(None)
            g = g[rows]
            g /= np.float32(full)  # windows that few streams are left in count for less
            sums = squares[name][rows]
            sums += g * g
            squares[name][rows] = sums
            g *= np.float32(rate)
            g /= np.sqrt(sums + np.float32(1e-8))
            getattr(model, name)[rows] += g


def log10_scores(model: GatedModel, docs: list[np.ndarray], end_id: int) -> np.ndarray:
    """log10 probability of every document, state carried across windows."""
    total, state = np.zeros(len(docs)), None
    for tokens, fresh, goal, doc, valid in streams(docs, end_id, SCORE_STREAMS):
        active = tokens.shape[1]
        state = np.zeros((active, HIDDEN), np.float32) if state is None else state[:active]
        state, trace = model.forward(tokens, fresh, state, learn=False)
        at = np.flatnonzero(valid.ravel())
        score = model.outputs(trace[-1].reshape(-1, HIDDEN)[at], goal.ravel()[at])
        total += np.bincount(doc.ravel()[at], score.astype(np.float64), len(docs))
    return total / math.log(10)


# ---------------------------------------------------------------- corpus counts
def count_tokens(blocked: DataFrame) -> DataFrame:
    """``(block, token, n, first)``: the distinct tokens of every block with their corpus counts.

    ``n`` counts the training rows of ``blocked(doc_id, text, block)`` over whole
    texts, ends included; a token that only held-out rows have counts 0.
    ``first`` marks one row of each token.  Blocks are counted where they lie;
    only their distinct tokens are shuffled, a token's rows being one a block.
    """
    schema = "block long, token string, n long"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        size = 0
        for batch in batches:
            blocks = batch.column(2).to_numpy()
            for block in np.unique(blocks).tolist():
                held.setdefault(block, []).append(batch.filter(pa.array(blocks == block)))
            size += batch.nbytes
            if size > COUNT_BUFFER:
                yield from _token_batches(held, out)
                held, size = {}, 0
        yield from _token_batches(held, out)

    tokens = map_arrow(blocked.select("doc_id", "text", "block"), run, schema)
    own = Window.partitionBy("token").orderBy("block")  # one window node for both
    return tokens.select("block", "token", F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                         .alias("n"), (F.row_number().over(own) == 1).alias("first"))


def _token_batches(held: dict[int, list[pa.RecordBatch]], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    for block, batches in held.items():
        own = pa.Table.from_batches(batches).combine_chunks()
        learned = np.array([not held_out(doc_id) for doc_id in own["doc_id"].to_pylist()])
        for lo, hi, words, lengths in words_of(own["text"].combine_chunks(), COUNT_BUFFER // 2):
            found = pc.dictionary_encode(words)
            n = np.bincount(found.indices.to_numpy(), np.repeat(learned[lo:hi], lengths), len(found.dictionary)).astype(np.int64)
            tokens = pa.concat_arrays([found.dictionary, pa.array([END.encode()], pa.binary())]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), block, np.int64)), tokens,
                                              pa.array(np.append(n, learned[lo:hi].sum()))], schema=out)


class Vocabulary:
    """Model entries: 0 for all other tokens, then the most frequent ones; with the corpus totals."""

    def __init__(self, top: list[tuple[str, int]], tokens: int, types: int):
        frequent = [(w, n) for w, n in top if w != END][:side(types) ** 2 - 2]
        own = dict(top).get(END, 0)
        known = sum(n for _, n in frequent) + own
        entries = sorted([(tokens - known + ALPHA, 0, None), (own + ALPHA, 0, END), *((n + ALPHA, 1, w) for w, n in frequent)],
                         key=lambda e: (-e[0], e[1], e[2] or ""))
        own_words = [(w.encode(), i) for i, (_, _, w) in enumerate(entries) if w not in (None, END)]
        self.words, self.ids = pa.array([w for w, _ in own_words], pa.binary()), np.array([i for _, i in own_words], np.int32)
        self.other = next(i for i, e in enumerate(entries) if e[2] is None)
        self.end = next(i for i, e in enumerate(entries) if e[2] == END)
        self.ids = np.append(self.ids, np.int32(self.other))
        self.frequencies = np.array([e[0] for e in entries] + [0.0] * (side(types) ** 2 - len(entries)))
        self.bounds = class_bounds(self.frequencies)
        self.tokens, self.types = tokens, types
        in_model = len(frequent) + (own > 0)
        #: normaliser of the share of one token among the others (one more type for all unseen ones)
        self.other_total = tokens - known + ALPHA * (types - in_model + 1)
        self.base_total = tokens + ALPHA * (types + 1)

    def encode(self, words: list[bytes] | pa.Array) -> np.ndarray:
        """The entries of ``words``."""
        return self.ids[places(pa.array(words, pa.binary()), self.words)]

    def documents(self, words: pa.Array, lengths: np.ndarray) -> list[np.ndarray]:
        """Entries of the documents that have ``lengths`` of ``words``, each closed by the end."""
        ends = np.cumsum(lengths)
        return np.split(np.insert(self.encode(words), ends, self.end), (ends + np.arange(1, len(ends) + 1))[:-1])


def places(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each word stands in ``among``; its length for words that are not there."""
    return pc.fill_null(pc.index_in(words, value_set=among), len(among)).to_numpy()


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the rows of ``count_tokens``; as many as the model has entries, and one, reach the driver."""
    own = counts.where(F.col("first") & (F.col("n") > 0)).select("token", "n")
    tokens, types = own.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = own.orderBy(F.desc("n"), "token").limit(side(types) ** 2).union(own.where(F.col("token") == END)).distinct()
    return Vocabulary(sorted(((r["token"], r["n"]) for r in top.collect()), key=lambda r: (-r[1], r[0])), tokens, types)


# ---------------------------------------------------------------- training over all documents
def train(rows: DataFrame, vocab: Vocabulary) -> GatedModel:
    """One pass over every training document of ``rows(doc_id, text)``, parameters averaged over tasks."""
    start = GatedModel(vocab.frequencies, bounds=vocab.bounds)
    shared = rows.sparkSession.sparkContext.broadcast((vocab, start.pack()))
    schema = "part int, slice int, tokens double, weights binary"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, flat = shared.value
        model = GatedModel(vocab.frequencies, bounds=vocab.bounds)
        model.unpack(flat)
        squares = {n: np.full(getattr(model, n).shape, SQUARES, np.float32) for n in model.NAMES}
        docs, size, total = [], 0, 0
        for batch in batches:
            learned = pa.array([not held_out(doc_id) for doc_id in batch.column(0).to_pylist()], pa.bool_())
            for *_, words, lengths in words_of(batch.column(1).filter(learned), SLICE_BYTES):
                for doc in vocab.documents(words, lengths):
                    docs.append(doc)
                    size += len(doc)
                    if size >= CHUNK_TOKENS:
                        fit(model, docs, vocab.end, squares)
                        total, docs, size = total + size, [], 0
        if docs:
            fit(model, docs, vocab.end, squares)
            total += size
        if total:
            part, flat = TaskContext.get().partitionId(), model.pack()
            for k, lo in enumerate(range(0, len(flat), SLICE)):
                yield record_batches([(part, k, float(total), flat[lo:lo + SLICE].tobytes())], out)

    parts = map_arrow(rows, run, schema)
    for share in (64, None):  # two levels: no task averages more than the square root of the parts
        key = F.lit(0) if share is None else (F.col("part") / share).cast("int")
        parts = parts.withColumn("part", key.cast("int")).groupBy("part", "slice").applyInArrow(_average, parts.schema)
    got = sorted((r["slice"], r["weights"]) for r in parts.collect())
    if got:
        start.unpack(np.frombuffer(b"".join(w for _, w in got), np.float32))
    return start


def _average(group: pa.Table) -> pa.Table:
    total, flat = 0.0, None
    for n, weights in sorted(zip(group["tokens"].to_pylist(), group["weights"].to_pylist())):
        own = np.frombuffer(weights, np.float32).astype(np.float64) * n
        flat, total = own if flat is None else flat + own, total + n
    return pa.table({"part": pa.array([group["part"][0].as_py()], pa.int32()),
                     "slice": pa.array([group["slice"][0].as_py()], pa.int32()), "tokens": pa.array([total], pa.float64()),
                     "weights": pa.array([(flat / total).astype(np.float32).tobytes()], pa.binary())})


# ---------------------------------------------------------------- scoring
def _score_block(vocab: Vocabulary, model: GatedModel, docs: pa.Table, known: pa.Table, out: pa.Schema) -> pa.Table:
    tokens = known["token"].cast(pa.binary()).combine_chunks()  # entries repeat if a task handed a token on twice
    count = np.append(known["n"].to_numpy().astype(np.float64), 0.0)
    entry = np.append(vocab.encode(tokens), np.int32(vocab.other))
    end = int(places(pa.array([END.encode()], pa.binary()), tokens)[0])
    logs = np.log10(count + ALPHA)
    columns: list[list] = [[] for _ in out]
    ids = docs["doc_id"].to_pylist()
    for first, _, words, lengths in words_of(docs["text"].combine_chunks(), SLICE_BYTES):
        at = np.insert(places(words, tokens), np.cumsum(lengths), end)
        lengths = lengths + 1
        rows = np.split(at, np.cumsum(lengths)[:-1])
        lo = 0
        while lo < len(rows):
            hi = max(lo + 1, int(np.searchsorted(np.cumsum(lengths[lo:]), CHUNK_TOKENS, "right")) + lo)
            encoded, extra, base = [], [], []
            for at in rows[lo:hi]:
                own, each = entry[at], logs[at]
                own[-1] = vocab.end
                others = own == vocab.other
                base.append((len(own), int((count[at] > 0).sum()), float(each.sum() - len(own) * math.log10(vocab.base_total))))
                extra.append(float(each[others].sum() - others.sum() * math.log10(vocab.other_total)))
                encoded.append(own)
            scores = log10_scores(model, encoded, vocab.end)
            for k, (n, known_tokens, log10) in enumerate(base):
                doc_id = ids[first + lo + k]
                row = (doc_id, held_out(doc_id), n, known_tokens, vocab.tokens, log10, float(scores[k] + extra[k]))
                for column, value in zip(columns, row):
                    column.append(value)
            lo = hi
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per document.

    Counts, vocabulary and network are learned from all documents that are not
    held out.  A null text is empty (its end token alone); null ids count as
    empty text and are held out; repeated rows keep their rows; an empty table
    gives an empty result; extra columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long")).repartition(
        max(1, min(blocks, 100_000)), "block")
    counts = materialise(count_tokens(blocked), "token-counts")
    vocab = vocabulary(counts)
    shared = spark.sparkContext.broadcast((vocab, train(rows, vocab).pack()))
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, "
              "train_tokens long, base_score double, score double")
    out = arrow_schema(schema)

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        vocab, flat = shared.value
        model = GatedModel(vocab.frequencies, bounds=vocab.bounds)
        model.unpack(flat)
        return _score_block(vocab, model, docs, known, out)

    known = counts.select("block", "token", "n")
    return blocked.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, schema)
