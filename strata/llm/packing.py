"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Only lengths matter to best fit, and they are bounded by the sequence length,
so the packing plan is made on the histogram of piece lengths (at most
``capacity`` numbers, whatever the corpus size): runs of equal pieces go into
runs of equally full bins.  A segment tree over remaining capacities finds the
tightest open bins in O(log capacity).  The plan is a bounded table of
(length, rank range -> bin range, offset); every piece finds its place from its
rank among the pieces of its length: its number within the task that cut it plus
the pieces of earlier tasks.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import arrow_schema, col, map_arrow, map_rows, materialise


# ---------------------------------------------------------------- tokens
def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE spells bytes as printable characters: printable ones as
    themselves, the rest as the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        spelled[chr(256 + i)] = b
    return spelled


@lru_cache(maxsize=2)
def encoder(vocab_path: str):
    """Text -> list of ids for a byte-level BPE tokenizer file.

    The ids equal those of ``tokenizers.Tokenizer.from_file(vocab_path)`` with
    ``add_special_tokens=False`` (checked in tests); the merges run in tiktoken
    because it needs about a quarter of the CPU time on the same vocabulary.
    Texts its pattern gives up on (runs of about a million white-space
    characters) are encoded by ``tokenizers`` itself.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    with open(vocab_path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    spelled = _byte_alphabet()
    ranks = {bytes(spelled[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    own = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    exact = Tokenizer.from_file(vocab_path)

    def encode(text: str) -> list[int]:
        try:
            return own.encode(text, allowed_special="all")
        except ValueError:
            return exact.encode(text, add_special_tokens=False).ids

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full pieces, only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocab_path: str, end_id: int = 2, capacity: int = 1024,
           id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, part, nth[, ids])`` for every document.

    ``nth`` numbers the pieces of one length within the task ``part`` that made
    them; once the table is written these numbers are stable.
    """
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def make():
        encode, part, seen = encoder(vocab_path), TaskContext.get().partitionId(), Counter()

        def one(doc_id, text):
            ids = np.array([*encode(text or ""), end_id], "<u4")
            for k, (start, length) in enumerate(cut(len(ids), capacity)):
                own = ids[start:start + length]
                row = (doc_id, k, start, length, zlib.crc32(own.tobytes()), part, seen[length])
                seen[length] += 1
                yield (*row, own.astype("i4").tolist()) if keep_ids else row

        return one

    return map_rows(rows, make, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, part int, nth long"
                    + (", ids array<int>" if keep_ids else ""), batch_rows=2_000 if keep_ids else 20_000)


# ---------------------------------------------------------------- best fit on the histogram
class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: which have open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, room: int, is_open: bool) -> None:
        i = room + self.size
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """Smallest capacity >= need that has an open bin."""
        i = need + self.size
        if self.open[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit(histogram: dict[int, int], capacity: int = 1024) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over ``{length: count}``.

    Returns runs ``(length, first rank, count, first bin, offset)``: the pieces
    of that length with ranks first..first+count-1 go, in order, to the bins
    from ``first bin`` on, at that offset.  The number of runs depends on the
    capacity, not on the counts.
    """
    tree, rooms, plan, bins = CapacityTree(capacity), {}, [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:  # nothing fits: as many new bins as needed
                room = capacity
                first, count = bins, max(1, left // (room // length))
                bins += count
            else:
                first, count = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            # a bin just used is the tightest for the next equal piece, so bins are filled one after the other
            per_bin = room // length
            used = min(count, left // per_bin)
            if not used:  # fewer pieces left than one bin takes
                used, per_bin = 1, left
            for k in range(per_bin):
                plan.append((length, rank, used, first, capacity - room + k * length))
                rank += used
            left -= used * per_bin
            _give(tree, rooms, room - per_bin * length, first, used)
            if used < count:
                _give(tree, rooms, room, first + used, count - used)
    return plan


def _give(tree: CapacityTree, rooms: dict[int, list[tuple[int, int]]], room: int, first: int, count: int) -> None:
    rooms.setdefault(room, []).append((first, count))
    tree.set(room, True)


def pack(docs: DataFrame, vocab_path: str, end_id: int = 2, capacity: int = 1024,
         id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids.

    Returns per piece ``(doc_id, piece, start, length, ids_crc32, sequence_id,
    offset[, ids])``.  A null text counts as empty (its end id alone); null and
    repeated ids are packed like others, row by row; an empty table gives an
    empty result.  Extra columns are ignored.  Sequences are gapless from 0.
    """
    spark = docs.sparkSession
    found = materialise(pieces(docs, vocab_path, end_id, capacity, id_col, text_col, keep_ids), "pieces")
    tasks = materialise(
        found.groupBy("length", "part").agg(F.count("*").alias("n")).withColumn(
            "base", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    by_length: dict[int, list] = {}
    for length, rank, _, first, offset in best_fit(histogram, capacity):
        by_length.setdefault(length, []).append((rank, first, offset))
    by_length = {length: np.array(sorted(runs), np.int64).T for length, runs in by_length.items()}
    shared = spark.sparkContext.broadcast(by_length)
    names = [c for c in found.columns if c not in ("part", "nth")]
    rows = found.join(tasks, ["length", "part"]).select(*names, (F.col("base") + F.col("nth")).alias("rank"))
    schema = rows.select(*names, F.col("rank").alias("sequence_id"), F.col("rank").alias("offset")).schema
    out = arrow_schema(schema)

    def place(batches):
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            length, rank = (column[n].to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for own in np.unique(length).tolist():
                at = np.flatnonzero(length == own)
                first, bins, offsets = shared.value[own]
                run = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at], offset[at] = bins[run] + rank[at] - first[run], offsets[run]
            column |= {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays([column[f.name].cast(f.type) for f in out], schema=out)

    return map_arrow(rows, place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` from ``pack(..., keep_ids=True)``; a sequence holds at most ``capacity`` ids."""
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")) \
        .select("sequence_id", F.flatten("parts.ids").alias("ids"))
