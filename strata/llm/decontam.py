"""Benchmark decontamination: BM25 retrieval with block-max WAND, then overlap checks.

Test items are cut into segments of at most ``SEGMENT`` words and indexed with
BM25 impacts divided by the segment's own score, so 1.0 means "every term of
the segment".  Every passage (a window of ``2 * SEGMENT`` words, one per
``SEGMENT`` words, so any segment lies whole inside some passage) is a query;
all segments scoring at least ``min_score`` are retrieved.  Postings are kept
in blocks with their largest impact: a vectorised pass drops passages none of
whose blocks can reach the threshold, and a document-at-a-time WAND with block
skipping scores the rest.  A retrieved item counts only when its question and
its answer overlap the text around the passage.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import arrow_schema, col, map_arrow, map_rows, materialise, open_folder, record_batches, ship_package
from strata.session import scratch_path

SEGMENT = 32
BLOCK = 4
MIN_SCORE = 0.6
SHINGLE = 5
MIN_OVERLAP = 0.8
#: Text of test items held by one index (characters); more items mean more indexes.
SHARD_CHARS = 4_000_000
#: Cells (slots times blocks) that the screen bounds at a time.
SCREEN_CELLS = 250_000
#: Documents gathered before the indexes are gone through.
HELD_BYTES = 32 * 1024 * 1024
K1, B = 1.2, 0.75
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Question and answer words of a test item: the answer follows the last
    question mark, else it is the last sentence, else the last third of the words."""
    head, mark, tail = text.rpartition("?")
    if mark and words_of(head) and words_of(tail):
        return words_of(head), words_of(tail)
    parts = [p for p in _SENTENCE.split(text) if words_of(p)]
    if len(parts) > 1:
        return words_of(" ".join(parts[:-1])), words_of(parts[-1])
    words = words_of(text)
    at = len(words) - len(words) // 3
    return words[:at], words[at:]


def shingles(words: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    """Word shingles; a shorter sequence is one shingle, an empty one has none."""
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def segments_of(words: list[str], segment: int = SEGMENT) -> list[list[str]]:
    """Segments of an item's words; the last one is as long as the others where the item allows."""
    return [words[max(0, min(at, len(words) - segment)):at + segment] for at in range(0, len(words), segment)]


@dataclass
class Statistics:
    """What BM25 takes from all segments: their number, their words, and in how many of them each term stands."""

    segments: int
    length: int
    frequency: dict[str, int]

    @classmethod
    def of(cls, segments: list[list[str]]) -> Statistics:
        return cls(len(segments), sum(map(len, segments)), Counter(w for s in segments for w in set(s)))


@dataclass
class Item:
    item_id: object
    length: int
    question: set = field(default_factory=set)
    answer: set = field(default_factory=set)

    def overlap(self, around: list[str]) -> tuple[float, float]:
        """Share of the question's shingles and of the answer's words found in ``around``."""
        sizes = {len(s) for s in self.question}
        near = set().union(*(shingles(around, n) for n in sizes)) if sizes else set()
        question = len(self.question & near) / len(self.question) if self.question else 1.0
        answer = len(self.answer & set(around)) / len(self.answer) if self.answer else 1.0
        return question, answer


class BlockMaxIndex:
    """Inverted index of item segments with normalised BM25 impacts."""

    def __init__(self, rows: list[tuple], stats: Statistics | None = None, segment: int = SEGMENT, block: int = BLOCK):
        """Index of the items ``(item_id, text)``; ``stats`` are those of all items (default: of ``rows`` alone)."""
        self.segment, self.block = segment, block
        self.items: list[Item] = []
        self.owner: list[int] = []
        segments: list[list[str]] = []
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue  # an item without words can't be matched
            question, answer = question_answer(text)
            self.items.append(Item(item_id, len(words), shingles(question), set(answer)))
            parts = segments_of(words, segment)
            segments += parts
            self.owner += [len(self.items) - 1] * len(parts)
        self._index(segments, stats or Statistics.of(segments))

    def _index(self, segments: list[list[str]], stats: Statistics) -> None:
        n = len(segments)
        mean = stats.length / max(1, stats.segments)
        tf: dict[str, dict[int, int]] = {}
        for s, words in enumerate(segments):
            for w in words:
                own = tf.setdefault(w, {})
                own[s] = own.get(s, 0) + 1
        self.terms = {w: i for i, w in enumerate(sorted(tf))}
        postings, total = [], np.zeros(n)
        for w in sorted(tf):
            docs = np.array(sorted(tf[w]), np.int64)
            f = np.array([tf[w][d] for d in docs.tolist()], np.float64)
            size = np.array([len(segments[d]) for d in docs.tolist()], np.float64)
            df = stats.frequency[w]
            idf = np.log(1 + (stats.segments - df + 0.5) / (df + 0.5))
            impact = idf * f * (K1 + 1) / (f + K1 * (1 - B + B * size / mean))
            np.add.at(total, docs, impact)
            postings.append((docs, impact))
        self.postings = [(docs.tolist(), (impact / total[docs]).tolist()) for docs, impact in postings]
        self.blocks: list[tuple[list[int], list[float]]] = []
        for docs, impacts in self.postings:
            own: dict[int, float] = {}
            for d, x in zip(docs, impacts):
                own[d // self.block] = max(own.get(d // self.block, 0.0), x)
            self.blocks.append((list(own), list(own.values())))
        self.upper = [max(x) for _, x in self.blocks]
        counts = np.array([len(b) for b, _ in self.blocks], np.int64)
        self._from = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        self._block = np.array([b for own, _ in self.blocks for b in own], np.int64)
        self._max = np.array([x for _, own in self.blocks for x in own], np.float64)
        self.n_blocks = -(-n // self.block) if n else 0

    def screen(self, ids: np.ndarray, min_score: float) -> list[int]:
        """Start slots (one per ``segment`` words) of passages in which some block can reach the threshold.

        Slots are taken in chunks, so the bounds held at a time do not grow with the text.
        """
        if not self.n_blocks:
            return []
        chunk, out = max(1, SCREEN_CELLS // self.n_blocks), []
        slots = max(1, -(-len(ids) // self.segment))
        for lo in range(0, slots, chunk):
            n = min(chunk, slots - lo)
            # a passage is two slots: the first one of the next chunk belongs to the last passage here
            part = ids[lo * self.segment:(lo + n + 1) * self.segment]
            known = np.flatnonzero(part >= 0)
            if not len(known):
                continue
            # every term once a slot: a passage scores its distinct terms
            pairs = np.unique(known // self.segment * len(self.terms) + part[known])
            terms, slot = pairs % len(self.terms), pairs // len(self.terms)
            size = self._from[terms + 1] - self._from[terms]
            at = np.repeat(self._from[terms] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            cell = np.repeat(slot, size) * self.n_blocks + self._block[at]
            bound = np.bincount(cell, self._max[at], (n + 1) * self.n_blocks).reshape(n + 1, self.n_blocks)
            reach = (bound[:-1] + bound[1:]).max(axis=1) >= min_score - 1e-9
            out += (lo + np.flatnonzero(reach)).tolist()
        return out

    def search(self, terms: list[int], min_score: float) -> list[tuple[int, float]]:
        """All ``(segment, score)`` with score >= ``min_score`` for a set of query terms.

        Document-at-a-time block-max WAND: cursors sorted by their document;
        the pivot is the first one up to which the terms' bounds reach the
        threshold; if the blocks around it cannot, the cursors skip the block.
        """
        floor, out = min_score - 1e-9, []
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for k, (doc, _, t) in enumerate(cursors):
                bound += self.upper[t]
                if bound >= floor:
                    pivot = doc
                    break
            if pivot is None:
                break
            while k + 1 < len(cursors) and cursors[k + 1][0] == pivot:
                k += 1
            block = pivot // self.block
            near = sum(self._block_max(t, block) for _, _, t in cursors[:k + 1])
            if near >= floor:
                if cursors[0][0] == pivot:
                    score = sum(self.postings[t][1][i] for doc, i, t in cursors[:k + 1])
                    if score >= floor:
                        out.append((pivot, score))
                    target = pivot + 1
                else:
                    target = pivot
            else:
                target = (block + 1) * self.block
                if k + 1 < len(cursors):
                    target = min(target, max(cursors[k + 1][0], pivot + 1))
            moved = []
            for n, cursor in enumerate(cursors):
                if n <= k and cursor[0] < target:
                    docs = self.postings[cursor[2]][0]
                    i = bisect_left(docs, target, cursor[1])
                    if i == len(docs):
                        continue
                    cursor[0], cursor[1] = docs[i], i
                moved.append(cursor)
            cursors = moved
        return out

    def _block_max(self, term: int, block: int) -> float:
        own, values = self.blocks[term]
        i = bisect_left(own, block)
        return values[i] if i < len(own) and own[i] == block else 0.0

    def matches(self, text: str | None, min_score: float = MIN_SCORE,
                min_overlap: float = MIN_OVERLAP) -> dict[int, tuple[float, int, float, float]]:
        """Item -> ``(score, first word of the passage, question overlap, answer overlap)`` of its best passage."""
        words = words_of(text)
        ids = np.fromiter(map(self.terms.get, words, repeat(-1)), np.int64, len(words))
        found: dict[int, tuple[float, int, float, float]] = {}
        for slot in self.screen(ids, min_score):
            at = slot * self.segment
            terms = set(ids[at:at + 2 * self.segment].tolist()) - {-1}
            best: dict[int, float] = {}
            for segment, score in self.search(sorted(terms), min_score):
                best[self.owner[segment]] = max(score, best.get(self.owner[segment], 0.0))
            for k, score in best.items():
                item = self.items[k]
                around = words[max(0, at - item.length):at + 2 * self.segment + item.length]
                question, answer = item.overlap(around)
                if question >= min_overlap and answer >= min_overlap and (k not in found or score > found[k][0] + 1e-12):
                    found[k] = (score, at, question, answer)
        return found


def write_indexes(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                  shard_chars: int = SHARD_CHARS) -> str:
    """Folder of a table ``(shard, index)`` over all distinct test items, below ``spark.checkpoint.dir``.

    Items are spread by hash over as many shards as their total size needs, so a
    shard holds about ``shard_chars`` characters.  Document frequencies and mean
    length are aggregated over all items first, so a score does not depend on
    the shards.  Tasks build the indexes; nothing but the three totals reaches
    the driver.
    """
    spark = benchmark.sparkSession
    rows = benchmark.select(col(item_col).alias("item_id"), col(text_col).cast("string").alias("text")) \
        .where("text is not null").distinct()
    total = rows.agg(F.sum(F.length("text") + 32)).first()[0] or 0
    shards = 1 + int(total // shard_chars)
    items = materialise(rows.select(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).alias("shard"), "item_id", "text"),
                        "test-items")

    def make():
        def one(shard, text):
            parts = segments_of(words_of(text))
            counts = Counter(w for part in parts for w in set(part))
            return [(shard, None, len(parts), sum(map(len, parts))), *((shard, w, n, 0) for w, n in counts.items())]

        return one

    counted = map_rows(items.select("shard", "text"), make, "shard long, term string, n long, words long") \
        .groupBy("shard", "term").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    counted = materialise(counted, "test-terms")
    totals = counted.where("term is null").agg(F.sum("n"), F.sum("words")).first()
    segments, length = totals[0] or 0, totals[1] or 0
    terms = counted.where("term is not null").select("shard", "term", "n")
    everywhere = terms.groupBy("term").agg(F.sum("n").alias("df"))
    known = terms.join(everywhere, "term").select("shard", "term", "df")

    def build(items: pa.Table, known: pa.Table) -> pa.Table:
        stats = Statistics(segments, length, dict(zip(known["term"].to_pylist(), known["df"].to_pylist())))
        own = sorted(zip(items["item_id"].to_pylist(), items["text"].to_pylist()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        index = BlockMaxIndex(own, stats)
        return pa.table({"shard": items["shard"][:1].cast(pa.int64()) if len(items) else pa.array([-1], pa.int64()),
                         "index": pa.array([pickle.dumps(index)], pa.binary())})

    ship_package(spark)
    built = items.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(build, "shard long, index binary")
    path = scratch_path(spark, "llm-test-indexes")
    built.write.parquet(path)
    return path


def read_indexes(path: str) -> Iterator[BlockMaxIndex]:
    """The indexes of ``write_indexes`` one after the other; for use in tasks."""
    filesystem, root = open_folder(path)
    files = sorted(f.path for f in filesystem.get_file_info(fs.FileSelector(root)) if f.path.endswith(".parquet"))
    for file in files:
        with filesystem.open_input_file(file) as source:
            for batch in pq.ParquetFile(source).iter_batches(batch_size=1, columns=["index"]):
                for data in batch.column(0):
                    yield pickle.loads(data.as_py())


def _search(rows: DataFrame, text_at: int, path: str, emit, schema: StructType, min_score: float, min_overlap: float) -> DataFrame:
    """``emit(batch, hits)`` for every batch of ``rows``; ``hits`` are ``(row, index, found items)``.

    Batches are gathered up to ``HELD_BYTES``, and every index is read once for
    them: the rows are read once whatever the number of indexes, and a task
    holds one index beside its batches (the only one there is stays loaded).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[BlockMaxIndex] = []
        several = False

        def indexes():
            nonlocal several
            if kept and not several:
                yield kept[0]
                return
            for k, index in enumerate(read_indexes(path)):
                several = k > 0
                kept[:] = [index]
                yield index

        def flush(held):
            hits: list[list] = [[] for _ in held]
            for index in indexes():
                for own, batch in zip(hits, held):
                    for row, text in enumerate(batch.column(text_at)):
                        if found := index.matches(text.as_py(), min_score, min_overlap):
                            own.extend((row, index.items[k].item_id, hit) for k, hit in sorted(found.items()))
            for own, batch in zip(hits, held):
                yield from emit(batch, own)

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= HELD_BYTES:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    return map_arrow(rows, run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """``(doc_id, item_id, passage_start, score, question_overlap, answer_overlap)``.

    One row per document row and distinct test item found in it (its best
    passage, the first on ties).  Null texts and items without words match
    nothing; null and repeated ids keep their rows; empty tables give an empty
    result; the memory of a long text is its words and a bounded screen.
    """
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.select(col("item_id")).schema[0].dataType.simpleString()
    schema = StructType.fromDDL(f"doc_id {id_type}, item_id {item_type}, passage_start long, score double, "
                                "question_overlap double, answer_overlap double")
    out = arrow_schema(schema)

    def emit(batch: pa.RecordBatch, hits: list) -> Iterator[pa.RecordBatch]:
        if hits:
            ids = batch.column(0).take(pa.array([row for row, _, _ in hits], pa.int64()))
            rest = record_batches([(item, at, score, q, a) for _, item, (score, at, q, a) in hits], pa.schema(list(out)[1:]))
            yield pa.RecordBatch.from_arrays([ids.cast(out.field(0).type), *rest.columns], schema=out)

    return _search(rows, 1, write_indexes(benchmark), emit, schema, min_score, min_overlap)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """``docs`` (all columns) without the rows that hold a test item."""

    def emit(batch: pa.RecordBatch, hits: list) -> Iterator[pa.RecordBatch]:
        dropped = {row for row, _, _ in hits}
        yield batch.filter(pa.array([i not in dropped for i in range(batch.num_rows)], pa.bool_()))

    return _search(docs, docs.columns.index(text_col), write_indexes(benchmark), emit, docs.schema, min_score, min_overlap)
