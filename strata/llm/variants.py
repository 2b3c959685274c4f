"""Groups of spelling variants: words of a corpus one edit apart, found in a frequency-vector trie.

Every word has a vector of counts: of all its letters, then of each letter
group.  One inserted, deleted or replaced character changes the vector by at
most one surplus and one deficit of one.  The trie arranges the words by their
successive counts, so the words near a given one lie on paths that a
depth-first search reaches with a budget of one surplus and one deficit; the
words of the leaves it reaches are verified character by character.

The top of the trie is walked in Spark, a few levels at a time, by joins between
the branches each query can still reach and the trie's nodes; a node with at
most ``CELL_WORDS`` words becomes a cell, and its part of the trie is built and
searched in a task: queries with a common path share the search, blocks of
branches at a time, deepest first.  Cells with more queries, and nodes of the last level with
more words, are dealt out in blocks, so no task holds more than a block of
words and a block of queries.  No pair of words is listed: a task returns each
query's number of near words and its best one.

Defined results: NULL and empty texts hold no words; a NULL id takes part and
its runs stay as they are (their hash is NULL); repeated rows count again; ties
of frequency go to the smaller word in code-point order; an empty table gives an
empty result.  Only the two named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, col, map_arrow, materialise, record_batches, ship_package

# What a run of letters is, and how runs become words.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CUT_EVERY, MIN_LENGTH, MIN_COUNT = 97, 5, 3
#: A form is at least so many times as frequent as its variant.
FORM_RATIO = 2

#: Letter groups, that is levels of the trie below the first, and the levels at which Spark's part of the walk looks at the nodes.
GROUPS = 16
STEPS = (2, 4, 7, 10, 13, 17)
#: Words of a cell, and queries of a block, that one task takes at a time.
CELL_WORDS = 20_000
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000
#: Branches that the search in a task follows at a time.
BRANCHES = 300_000


def _counted(doc_id: str | None, text: str | None, counts: Counter) -> None:
    """Add the words of one text to ``counts``."""
    runs = Counter(_RUN.findall(text or ""))
    start = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        if len(run) < MIN_LENGTH:
            continue
        run = run.lower() if run.isascii() else run.translate(_LOWER)
        h = 1 if start is None else zlib.crc32(run.encode(), start)
        if h % CUT_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        counts[run] += n


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``: the distinct words of the corpus with their number of occurrences.

    Tasks count a bounded number of distinct words at a time before anything is shuffled.
    """
    out = arrow_schema("word string, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            rows = [(w, n) for w, n in counts.items() if len(w) >= MIN_LENGTH]
            counts.clear()
            return record_batches(rows, out)

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                _counted(doc_id, text, counts)
                if len(counts) > HELD_WORDS:
                    yield flush()
        yield flush()

    rows = docs.select(col(id_col).cast("string").alias("id"), col(text_col).alias("text"))
    return map_arrow(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def letter_groups(found: DataFrame, n: int = GROUPS) -> list[str]:
    """The letters of all words in ``n`` groups of about equal frequency, the most telling (most frequent) first.

    Only one count a letter of the alphabet reaches the driver; groups steer the
    search, never its result.
    """
    letters = found.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count()
    groups = [[0, ""] for _ in range(n)]
    for c, k in sorted(((r["c"], r["count"]) for r in letters.collect()), key=lambda x: (-x[1], x[0])):
        least = min(groups, key=lambda g: g[0])
        least[0] += k
        least[1] += c
    return [g for _, g in sorted(groups, key=lambda g: -g[0])]


def vector(word: Column, groups: list[str]) -> Column:
    """The counts of all letters and of each letter group in ``word``."""
    return F.array(F.length(word), *[F.length(word) - F.length(F.translate(word, g, "")) if g else F.lit(0) for g in groups])


def _moves(levels: int, first: bool = False) -> list[tuple[list[int], int, int]]:
    """What one surplus and one deficit can do to ``levels`` counts: (changes, surplus spent, deficit spent).

    The first count is that of all letters: if it stays, both are left, if it
    grows or shrinks, the letter groups have only a surplus or only a deficit.
    """
    if first:
        rest = _moves(levels - 1)
        return [([0, *m], s, d) for m, s, d in rest] + [([1, *m], s, 1) for m, s, d in rest if not d] \
            + [([-1, *m], 1, d) for m, s, d in rest if not s]
    out = []
    for up in range(-1, levels):
        for down in range(-1, levels):
            if up != down or up < 0:
                out.append(([(i == up) - (i == down) for i in range(levels)], int(up >= 0), int(down >= 0)))
    return out


def _reached(queries: DataFrame, lo: int, hi: int) -> DataFrame:
    """``queries`` moved on from trie level ``lo`` to ``hi``: one row a branch within the budget."""
    moves = F.array(*[F.struct(F.array(*map(F.lit, m)).alias("m"), F.lit(s).alias("s"), F.lit(d).alias("d")) for m, s, d in _moves(hi - lo, lo == 0)])
    counts = F.slice("vec", lo + 1, hi - lo)
    # only the moves that the budget and the counts allow become rows
    allowed = F.filter(moves, lambda m: (m["s"] <= F.col("surplus")) & (m["d"] <= F.col("deficit"))
                       & ~F.exists(F.zip_with(counts, m["m"], lambda a, b: a + b), lambda x: x < 0))
    grown = queries.withColumn("move", F.explode(allowed))
    return grown.withColumn("part", F.zip_with(counts, "move.m", lambda a, b: a + b)).select(
        "word", "vec", F.concat("path", "part").alias("path"),
        (F.col("surplus") - F.col("move.s")).alias("surplus"), (F.col("deficit") - F.col("move.d")).alias("deficit"))


def cells(found: DataFrame, cell_words: int = CELL_WORDS, steps: tuple[int, ...] = STEPS) -> tuple[DataFrame, DataFrame]:
    """The top of the trie: ``(members, queries)``.

    ``members(path, word, n, vec)`` puts every word into the cell of its trie
    node, ``queries(path, word, vec, surplus, deficit)`` every word into the cells
    its budget reaches, with what is left of it.
    """
    open_words = found.select("word", "n", "vec")
    open_queries = found.select("word", "vec", F.array().cast("array<int>").alias("path"), F.lit(1).alias("surplus"), F.lit(1).alias("deficit"))
    members, queries, lo = [], [], 0
    for hi in steps:
        last = hi == steps[-1]
        at = open_words.withColumn("path", F.slice("vec", 1, hi))
        nodes = materialise(at.groupBy("path").agg(F.count("*").alias("n_words")), "variants-nodes")
        cell = F.lit(True) if last else F.col("n_words") <= cell_words
        reached = materialise(_reached(open_queries, lo, hi).join(nodes, "path").withColumn("cell", cell), "variants-reached")
        placed = at.join(nodes.select("path", cell.alias("cell")), "path")
        members.append(placed.where("cell").select("path", "word", "n", "vec"))
        queries.append(reached.where("cell").select("path", "word", "vec", "surplus", "deficit"))
        if last or nodes.where(~cell).isEmpty():
            break
        open_words = materialise(placed.where("not cell").select("word", "n", "vec"), "variants-open")
        open_queries = reached.where("not cell").select("word", "vec", "path", "surplus", "deficit")
        lo = hi
    for more in members[1:]:
        members[0] = members[0].union(more)
    for more in queries[1:]:
        queries[0] = queries[0].union(more)
    return members[0], queries[0]


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    for x, y in zip(a, b):
        if x != y:
            break
        i += 1
    else:
        i = len(a)
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


class Trie:
    """Rows of counts, sorted, with the nodes of every level: runs of rows that agree on the counts so far.

    ``first[l]`` is each node's first row, ``count[l]`` its last count,
    ``child[l]`` its first child (with one entry more), ``key[l]`` its parent and
    count in one ascending number.
    """

    def __init__(self, counts: np.ndarray) -> None:
        n, self.levels = counts.shape
        self.width = int(counts.max(initial=0)) + 3
        self.order = np.lexsort(counts.T[::-1]) if self.levels else np.arange(n)
        rows = counts[self.order]
        split = np.zeros(max(n - 1, 0), bool)
        self.first = [np.zeros(1, np.int64)]
        self.count, self.child, self.key = [np.zeros(1, np.int64)], [], [np.zeros(1, np.int64)]
        for level in range(self.levels):
            split |= rows[1:, level] != rows[:-1, level]
            first = np.r_[0, np.flatnonzero(split) + 1]
            parent = np.searchsorted(self.first[-1], first, "right") - 1
            self.child.append(np.searchsorted(parent, np.arange(len(self.first[-1]) + 1)))
            self.first.append(first)
            self.count.append(rows[first, level].astype(np.int64))
            self.key.append(parent * self.width + self.count[-1] + 1)
        self.end = np.r_[self.first[-1][1:], n]

    def find(self, level: int, parent: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of ``parent`` nodes with these counts: (node, whether there is one)."""
        key = parent * self.width + count + 1
        at = np.minimum(np.searchsorted(self.key[level], key), len(self.key[level]) - 1)
        return at, (self.key[level][at] == key) & (count < self.width - 1)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [lo, hi), and for each the range it comes from."""
    size = hi - lo
    of = np.repeat(np.arange(len(lo)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + lo[of], of


def candidates(asked: Trie, trie: Trie, surplus: int, deficit: int, branches: int = BRANCHES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (of ``asked``, of ``trie``) whose counts differ within the budget, some at a time.

    The rows of one ``asked`` node are searched for together; the deepest
    branches come first, so at most ``branches`` a level wait.
    """
    one = np.zeros(1, np.int64)
    todo = [(0, one, one, one + surplus, one + deficit)]
    while todo:
        level, a, b, s, d = todo.pop()
        if len(a) > branches:
            half = len(a) // 2
            todo += [(level, a[half:], b[half:], s[half:], d[half:]), (level, a[:half], b[:half], s[:half], d[:half])]
            continue
        if level == asked.levels:
            # rows of equal counts: the leaf's words meet those asked for, a part of the leaf at a time
            mine, of = _ranges(asked.first[level][a], asked.end[a])
            size = (trie.end[b] - trie.first[level][b])[of]
            parts = np.cumsum(size) // branches
            for part in range(int(parts[-1]) + 1 if len(parts) else 0):
                here = parts == part
                theirs, k = _ranges(trie.first[level][b[of[here]]], trie.end[b[of[here]]])
                yield asked.order[mine[here][k]], trie.order[theirs]
            continue
        child, of = _ranges(asked.child[level][a], asked.child[level][a + 1])
        c, b, s, d = asked.count[level + 1][child], b[of], s[of], d[of]
        for change, may in ((0, None), (1, s > 0), (-1, d > 0)):
            k = np.arange(len(child)) if may is None else np.flatnonzero(may)
            node, there = trie.find(level + 1, b[k], c[k] + change)
            k, node = k[there], node[there]
            if len(k):
                todo.append((level + 1, child[k], node, s[k] - (change > 0), d[k] - (change < 0)))


def _letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points (all below 256)."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _verified(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``one_edit`` for rows of letters."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    n = a.shape[1]
    front = np.logical_and.accumulate(a == b[:, :n], 1).sum(1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], 1).sum(1)
    return front + back >= n


def search(members: list[tuple[str, int]], counts: np.ndarray, queries: list[str], wanted: np.ndarray, budget: np.ndarray) -> list[tuple]:
    """``(query, n_near, best n, best word)`` of the queries with near words among ``members`` (word, n) of one length.

    ``counts`` and ``wanted`` hold the remaining counts of both, ``budget`` the
    surplus and deficit a query has left.
    """
    if not members or not queries:
        return []
    trie, letters = Trie(counts), _letters([w for w, _ in members])
    rank = np.empty(len(members), np.int64)  # place of each member from best to worst
    rank[sorted(range(len(members)), key=lambda i: (-members[i][1], members[i][0]))] = np.arange(len(members))
    size = np.array([len(q) for q in queries])
    near, best = np.zeros(len(queries), np.int64), np.full(len(queries), len(members))
    kinds = np.column_stack([size, budget])
    for kind in np.unique(kinds, axis=0):
        mine = np.flatnonzero((kinds == kind).all(1))
        own = _letters([queries[i] for i in mine])
        for i, j in candidates(Trie(wanted[mine]), trie, int(kind[1]), int(kind[2])):
            step = max(1, 20_000_000 // (own.shape[1] + 1))
            for at in range(0, len(i), step):
                a, b = i[at:at + step], j[at:at + step]
                ok = _verified(own[a], letters[b])
                a, b = mine[a[ok]], b[ok]
                np.add.at(near, a, 1)
                np.minimum.at(best, a, rank[b])
    by_rank = np.argsort(rank)
    return [(queries[q], int(near[q]), members[by_rank[best[q]]][1], members[by_rank[best[q]]][0]) for q in np.flatnonzero(near)]


def _search(members: DataFrame, queries: DataFrame, block: int) -> DataFrame:
    """``(word, n_near, best(n, word))`` of the queries of every cell, block by block."""
    sizes = members.groupBy("path").agg(F.count("*").alias("m")).join(
        queries.groupBy("path").agg(F.count("*").alias("q")), "path").select(
        "path", F.ceil(F.col("m") / block).cast("int").alias("mb"), F.ceil(F.col("q") / block).cast("int").alias("qb"))
    sizes = materialise(sizes, "variants-sizes")

    def spread(rows: DataFrame, own: str, other: str) -> DataFrame:
        # a row goes to one block of its own kind and meets every block of the other
        return rows.join(sizes, "path").withColumn(own, F.pmod(F.xxhash64("word"), F.col(own))) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))

    both = spread(members, "mb", "qb").select("path", "mb", "qb", "word", "vec", F.col("n"), F.lit(0).alias("s"), F.lit(0).alias("d")).union(
        spread(queries, "qb", "mb").select("path", "mb", "qb", "word", "vec", F.lit(None).cast("long"), "surplus", "deficit"))
    schema = "word string, n_near long, best_n long, best string"
    out = arrow_schema(schema)

    def run(group: pa.Table) -> pa.Table:
        done = len(group["path"][0])  # counts that the cell's words share are spent already
        vec = group["vec"].combine_chunks()
        counts = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(vec), -1)[:, done:].astype(np.int64)
        n = group["n"].combine_chunks()
        asked = n.is_null().to_numpy(zero_copy_only=False)
        word, n = group["word"].to_pylist(), n.to_pylist()
        budget = np.column_stack([group["s"].to_numpy(), group["d"].to_numpy()])[asked]
        found = search([(word[i], n[i]) for i in np.flatnonzero(~asked)], counts[~asked],
                       [word[i] for i in np.flatnonzero(asked)], counts[asked], budget)
        return pa.Table.from_batches([record_batches(found, out)])

    ship_package(members.sparkSession)
    return both.groupBy("path", "mb", "qb").applyInArrow(run, schema)


def near_words(found: DataFrame, cell_words: int = CELL_WORDS, groups: int = GROUPS, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """``(word, n_near, best_n, best)`` of every word with a near word; ``found(word, n)`` must be written or cheap."""
    letters = letter_groups(found, groups)
    vectors = materialise(found.select("word", "n", vector(F.col("word"), letters).alias("vec")), "variants-words")
    members, queries = cells(vectors, cell_words, steps)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return _search(members, queries, cell_words).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for every word of ``forms(word, form)``: forms followed to the last, by pointer doubling.

    A form is at least twice as frequent as its word, so chains have at most
    log2 of the largest count steps and the loop at most log2 of that.
    """
    state = materialise(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        after = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(state.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                     F.col("next").isNotNull().alias("moved")), "variants-roots")
        state = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return state


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cell_words: int = CELL_WORDS) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every word of the corpus."""
    found = materialise(words(docs, id_col, text_col), "variants-counts")
    near = near_words(found, cell_words)
    form = F.col("best_n") >= FORM_RATIO * F.col("n")
    known = materialise(found.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(form, F.col("best")).alias("form"), F.when(form, F.col("best_n")).alias("form_n")), "variants-known")
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
