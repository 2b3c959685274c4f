"""Alignment of two tokenizers: which tokens of one cover which of the other.

A text is encoded twice, by a ``tokenizers`` file (A) and by a sentencepiece
model (B).  Both libraries say which characters a token covers; these spans are
the coarse cuts.  Where a token covers no whole characters of its own (pieces of
one multibyte character, byte-fallback tokens), the bytes it decodes to refine
the cut.  Byte offsets at which a token of A and one of B both end cut the
tokens into groups; tokens whose byte ranges overlap are linked.

Words repeat, so the work is done once a *chunk*: the text is cut before
spaces that follow a non-space.  Neither tokenizer has tokens across such a cut
(A splits there by its byte-level pattern, B has no piece with a space inside;
both are looked up in the files, else the whole text is one chunk), so tokens,
groups and links of a text are those of its chunks one after the other.  Tasks
remember a bounded number of chunks.

Corpus-wide counts of linked id pairs: texts are gathered in blocks of bounded
size, each block adds its distinct pairs with their documents once, and gets
back the counts of these pairs only; no pair is sent once a document.

Defined results: texts that are NULL or empty, or whose decoded tokens differ
from space + text (a literal U+2581, say), have no tokens: zeros and an empty
digest; repeated rows are documents of their own and count as such; an empty
table gives an empty result.  Only the two named columns are read.  A text
must fit in a task's memory.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, col, map_arrow, materialise, record_batches, ship_package

#: Distinct links of the documents of a block.
BLOCK_LINKS = 500_000
#: Chunks that a task remembers (twice as many at most), and the longest ones it does.
HELD_CHUNKS, HELD_LENGTH = 120_000, 48
#: Texts whose chunks are looked up together, and chunks that are encoded in one call.
LOOKED_UP, ENCODED = 256, 1_000

_SPACE = "▁"
_CUT = re.compile(r"(?<=\S)(?= )")
_GLUED = re.compile(r"\s ")


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the others for 256, 257, ... in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ends(spans: list[tuple[int, int]], tokens: list[bytes], at: list[int]) -> list[int]:
    """The byte offset at which each token ends.

    ``spans`` are character spans, ``at[c]`` the bytes before character ``c``.  A
    token with whole characters of its own ends where its span does; the
    others share a character and are measured by the bytes they decode to.
    """
    out, byte, char = [], 0, 0
    for k, (start, end) in enumerate(spans):
        own = end > char and start == char and (k + 1 == len(spans) or spans[k + 1][0] == end) \
            and (k + 1 == len(spans) or spans[k + 1][1] > end)
        byte = at[end] if own else byte + len(tokens[k])
        char = max(char, end)
        out.append(byte)
    return out


def align(a: list[int], a_ends: list[int], b: list[int], b_ends: list[int]) -> tuple[list[str], list[int]]:
    """Groups as ``a1,a2|b1`` texts and links as ``a << 32 | b`` numbers of two token sequences over the same bytes."""
    if a_ends == b_ends:
        return [f"{x}|{y}" for x, y in zip(a, b)], [x << 32 | y for x, y in zip(a, b)]
    groups, links = [], []
    i = j = i0 = j0 = 0
    while i < len(a):
        links.append(a[i] << 32 | b[j])
        x, y = a_ends[i], b_ends[j]
        if x == y:
            groups.append(f"{a[i]}|{b[j]}" if i == i0 and j == j0 else
                          ",".join(map(str, a[i0:i + 1])) + "|" + ",".join(map(str, b[j0:j + 1])))
            i = i0 = i + 1
            j = j0 = j + 1
        elif x < y:
            i += 1
        else:
            j += 1
    return groups, links


class Aligner:
    """Tokens, groups and links of texts, chunk by chunk."""

    def __init__(self, tokenizer: str, model: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(tokenizer)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        alphabet = byte_alphabet()
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        self.a_bytes = {i: bytes(alphabet[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items() if i not in special}
        self.b_bytes = []
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for i, piece in enumerate(pieces):
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(_SPACE, " ").encode())
        with open(tokenizer, encoding="utf-8") as f:
            kind = json.load(f)
        pattern = kind.get("pre_tokenizer") or {}
        self.by_chunk = (pattern.get("type") == "ByteLevel" and pattern.get("use_regex", True) and not kind.get("normalizer")
                         and not any(_SPACE in p.lstrip(_SPACE) for p in pieces))
        self.young: dict = {}
        self.old: dict = {}

    def chunks(self, text: str) -> list[str]:
        """``text`` cut into the chunks of space + text, each without its first space."""
        if not self.by_chunk:
            return [text]
        if text[0] != " " and text[-1] != " " and not _GLUED.search(text):
            return text.split(" ")
        parts = _CUT.split(" " + text)
        if len(parts) > 1 and not parts[-1].strip(" "):
            parts[-2:] = ["".join(parts[-2:])]  # spaces at the end belong to what is before them
        return [p[1:] for p in parts]

    def _encode(self, chunks: list[str]) -> Iterator[tuple | None]:
        """``(n_a, groups, links)`` of each chunk, groups and links as they are joined; None where bytes are not kept."""
        encoded = self.a.encode_batch([" " + c for c in chunks], add_special_tokens=False)
        pieces = self.b.encode(chunks, num_threads=1, return_type="offset_mapping")
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for chunk, x, y in zip(chunks, encoded, pieces):
            a, b, data = x.ids, y["ids"], (" " + chunk).encode()
            if not chunk or b"".join(map(a_bytes, a)) != data or b"".join(map(b_bytes, b)) != data:
                yield None
                continue
            a_spans, b_spans = x.offsets, y["offsets"]  # B's do not know the first space
            if len(data) == len(chunk) + 1:  # one byte a character: the coarse cuts are final
                a_ends, b_ends = [e for _, e in a_spans], [e + 1 for _, e in b_spans]
            else:
                at = [0, *accumulate(1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4 for c in " " + chunk)]
                a_ends = ends(a_spans, list(map(a_bytes, a)), at)
                b_ends = ends([(start + 1 if start else 0, end + 1 if end else 0) for start, end in b_spans], list(map(b_bytes, b)), at)
            groups, links = align(a, a_ends, b, b_ends)
            yield len(a), ";".join(groups), array("q", links).tobytes()

    def read(self, texts: list[str | None]) -> Iterator[list[tuple] | None]:
        """The entries of each text's chunks; None for a text without tokens."""
        cut = [self.chunks(t) if t else () for t in texts]
        known, old = self.young, self.old
        new = set().union(*(set(parts).difference(known) for parts in cut))
        known.update((c, old[c]) for c in new.intersection(old))
        new = [c for c in new if c not in known]
        for at in range(0, len(new), ENCODED):
            known.update(zip(new[at:at + ENCODED], self._encode(new[at:at + ENCODED])))
        for parts in cut:
            entries = list(map(known.__getitem__, parts))
            yield entries if entries and all(entries) else None
        for c in new:
            if len(c) > HELD_LENGTH:
                del known[c]
        if len(known) > HELD_CHUNKS:
            self.old, self.young = known, {}


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(tokenizer: str, model: str) -> Aligner:
    """One aligner a worker process, with its remembered chunks."""
    if (tokenizer, model) not in _ALIGNERS:
        _ALIGNERS[tokenizer, model] = Aligner(tokenizer, model)
    return _ALIGNERS[tokenizer, model]


def _forget() -> None:
    """Give the memory of this worker's tokenizers and remembered chunks back."""
    if _ALIGNERS:
        _ALIGNERS.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


class _Block:
    """Documents until their distinct links fill a block."""

    def __init__(self) -> None:
        self.docs: list[tuple] = []
        self.links: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, entries: list[tuple] | None) -> None:
        if entries is None:
            row, links, times = (doc_id, 0, 0, 0, 0, ""), np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            n_a, groups, links = zip(*entries)
            groups, links, n_a = ";".join(groups), np.frombuffer(b"".join(links), np.int64), sum(n_a)
            # every step along both sequences ends a group or links one more pair
            n_groups = groups.count(";") + 1
            row = doc_id, n_a, len(links) + n_groups - n_a, n_groups, len(links), hashlib.sha256(groups.encode()).hexdigest()
            links, times = np.unique(links, return_counts=True)
        self.docs.append(row)
        self.links.append(links)
        self.times.append(times.astype(np.int32))
        self.size += len(links) + 16

    def rows(self, block: int, schema: pa.Schema) -> pa.RecordBatch:
        """One row a document, with the places of its links in the block's list of pairs, and one row a pair."""
        pairs, place, docs = np.unique(np.concatenate(self.links), return_inverse=True, return_counts=True)
        place, at, docs_rows = place.astype(np.int32), 0, []
        for row, links, times in zip(self.docs, self.links, self.times):
            docs_rows.append((block, *row, place[at:at + len(links)].tobytes(), times.tobytes(), None, None, None))
            at += len(links)
        first = record_batches(docs_rows, schema)
        n = len(pairs)
        columns = {"block": pa.array(np.full(n, block)), "pair": pa.array(pairs), "place": pa.array(np.arange(n, dtype=np.int32)),
                   "docs": pa.array(docs.astype(np.int64))}
        second = pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)
        return pa.concat_batches([first, second])


def _pass_over(docs: DataFrame, tokenizer: str, model: str) -> DataFrame:
    """Every document aligned, and the distinct pairs of every block, as one written table."""
    kind = docs.schema[0].dataType.simpleString()
    schema = (f"block long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "links binary, times binary, pair long, place int, docs long")
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block, number = _aligner(tokenizer, model), _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, LOOKED_UP):
                ids, texts = (c.to_pylist() for c in batch.slice(at, LOOKED_UP).columns)
                for doc_id, entries in zip(ids, aligner.read(texts)):
                    block.add(doc_id, entries)
                    if block.size >= BLOCK_LINKS:
                        yield block.rows(number, out)
                        block, number = _Block(), number + 1
        if block.docs:
            yield block.rows(number, out)
        pa.default_memory_pool().release_unused()

    return materialise(map_arrow(docs, run, schema), "alignment")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: documents that hold each linked id pair, and whether no pair of its A id is in more."""
    counts = aligned.where("pair is not null").groupBy("pair").agg(F.sum("docs").alias("n"))
    # at most as many rows an A id as B has ids
    top = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return materialise(counts.select("pair", "n", (F.col("n") == top).alias("best")), "alignment-counts")


def align_corpus(docs: DataFrame, tokenizer: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every document."""
    aligned = _pass_over(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")), tokenizer, model)
    kind = aligned.schema["doc_id"].dataType.simpleString()
    known = aligned.where("pair is not null").select("block", "pair", "place").join(pair_counts(aligned), "pair") \
        .select(F.col("block").alias("of_block"), "place", "n", "best")
    texts = aligned.where("pair is null").drop("pair", "place", "docs")
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    out = arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        _forget()  # the first pass is over
        n, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, bool)
        place = right["place"].to_numpy()
        n[place], best[place] = right["n"].to_numpy(), right["best"].to_numpy()
        n_best, count_sum = [], []
        for links, times in zip(left["links"].to_pylist(), left["times"].to_pylist()):
            at, times = np.frombuffer(links, np.int32), np.frombuffer(times, np.int32)
            n_best.append(int(times[best[at]].sum()))
            count_sum.append(int((n[at] * times).sum()))
        sums = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.Table.from_arrays([sums[f.name] if f.name in sums else left[f.name].cast(f.type) for f in out], schema=out)

    ship_package(docs.sparkSession)
    return texts.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(run, schema)


def groups_of(docs: DataFrame, tokenizer: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, groups)``: the aligned groups of every document, each ``a1,a2|b1``, in order (none without tokens)."""
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, groups array<string>"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(tokenizer, model)
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            for doc_id, entries in zip(ids, aligner.read(texts)):
                yield record_batches([(doc_id, [g for e in entries or () for g in e[1].split(";")])], out)

    return map_arrow(rows, run, schema)
