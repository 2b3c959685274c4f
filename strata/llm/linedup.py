"""Repeated line runs found by winnowing over line hashes.

A *gram* is the shortest run of lines from a position that holds
``gram_words`` words.  For every start, the lines up to ``window_words`` words
form a window; the gram of least hash inside it (rightmost on ties) becomes a
fingerprint.  Windows depend on their lines alone, so two documents that share
a run of ``window_words`` words share a fingerprint (a line that long is always
one).  Every occurrence of a fingerprint is joined with its first occurrence in
(id, position) order, the match is extended line by line in both directions,
and the later run is deleted.  A fingerprint may stand alone in an earlier
document than the run around it, so every window that holds a repeated
fingerprint is also joined as a whole with its own first occurrence; windows
reach ``window_words`` words forward from every line and back from every line,
so they cover any repeated run of that length.  The earliest copy of a line is
never deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, fresh, map_rows, materialise

GRAM_WORDS = 25
WINDOW_WORDS = 50


def lines_of(text: str | None) -> list[tuple[int, bytes, int]]:
    """``(line number, words joined by single spaces, word count)`` of the lines with a word."""
    out = []
    for i, line in enumerate((text or "").split("\n")):
        words = line.encode("utf-8", "surrogatepass").split()
        if words:
            out.append((i, b" ".join(words), len(words)))
    return out


def winnow(lines: list[bytes], sizes: list[int], gram_words: int = GRAM_WORDS,
           window_words: int = WINDOW_WORDS) -> list[tuple[int, int, bytes]]:
    """Selected ``(first line, last line, gram hash)``, in order."""
    from xxhash import xxh3_128_digest

    def reach(words: int) -> list[int | None]:
        ends, j, total = [], -1, 0
        for i in range(len(lines)):
            while total < words and j + 1 < len(lines):
                j += 1
                total += sizes[j]
            ends.append(j if total >= words else None)
            total -= sizes[i]
        return ends

    ends, limits = reach(gram_words), reach(window_words)
    hashes: dict[int, bytes] = {}
    chosen: dict[int, None] = {}
    for i, limit in enumerate(limits):
        if limit is None:
            break
        best = None
        for p in range(i, limit + 1):
            if ends[p] is None or ends[p] > limit:
                break
            if p not in hashes:
                hashes[p] = xxh3_128_digest(b"\n".join(lines[p:ends[p] + 1]))
            if best is None or hashes[p] <= hashes[best]:
                best = p
        chosen[best] = None
    return [(p, ends[p], hashes[p]) for p in sorted(chosen)]


def extend(own: list[int], other: list[int], at: int, end: int, there: int) -> tuple[int, int] | None:
    """The maximal matching run around ``own[at..end] == other[there..]`` (None if the lines differ)."""
    n = end - at + 1
    if own[at:end + 1] != other[there:there + n]:
        return None
    lo, hi, shift = at, end, there - at
    while lo > 0 and lo + shift > 0 and own[lo - 1] == other[lo - 1 + shift]:
        lo -= 1
    while hi + 1 < len(own) and hi + 1 + shift < len(other) and own[hi + 1] == other[hi + 1 + shift]:
        hi += 1
    return lo, hi


def windows(sizes: list[int], marks: list[tuple[int, int]], window_words: int = WINDOW_WORDS) -> list[tuple[int, int]]:
    """``(first line, last line)`` of the least runs of ``window_words`` words from and up to every line that hold a mark."""
    from bisect import bisect_left

    sums = [0]
    for n in sizes:
        sums.append(sums[-1] + n)
    out = set()
    for i in range(len(sizes)):
        end = bisect_left(sums, sums[i] + window_words)
        if end < len(sums):
            out.add((i, end - 1))
    at = 0
    for j in range(len(sizes)):
        while at < j and sums[j + 1] - sums[at + 1] >= window_words:
            at += 1
        if sums[j + 1] - sums[at] >= window_words:
            out.add((at, j))
    marks = sorted(marks)
    starts = [m[0] for m in marks]
    held = lambda lo, hi: (k := bisect_left(starts, lo)) < len(marks) and marks[k][1] <= hi  # noqa: E731  ends rise with starts
    return sorted(w for w in out if held(*w))


def _merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for lo, hi in sorted(runs):
        if merged and lo <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return [(lo, hi) for lo, hi in merged]


def _runs(own, numbers, other, marks):
    """Merged ``(from, to)`` line numbers that the marks' matches cover."""
    found, done = [], {}
    for at, end, there in sorted(marks):
        if there - at in done and done[there - at] >= end:
            continue  # inside the run found for an earlier mark of the same shift
        run = extend(own, other, at, end, there)
        if run:
            found.append(run)
            done[there - at] = run[1]
    return [(numbers[lo], numbers[hi]) for lo, hi in _merge(found)]


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> DataFrame:
    """``(doc, runs)``: line-number ranges to delete, for documents that have any; ``doc`` is the key of ``_doc``.

    Documents are told apart by id and text, so rows that repeat both count as
    one; null ids come last.  Null and empty texts have no lines.
    """
    rows = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("text_hash"),
                       col(text_col).cast("string").alias("text"))
    rows = rows.select("id", "text_hash", _doc(F.col("id"), F.col("text_hash")).alias("doc"), "text")
    id_type = rows.schema["id"].dataType.simpleString()

    def make():
        from xxhash import xxh3_64_intdigest

        def one(i, text_hash, doc, text):
            lines = lines_of(text)
            marks = winnow([t for _, t, _ in lines], [n for _, _, n in lines], gram_words, window_words)
            if marks:
                hashes = [xxh3_64_intdigest(t) - (1 << 63) for _, t, _ in lines]
                yield i, text_hash, doc, hashes, [n for n, _, _ in lines], [n for _, _, n in lines], marks

        return one

    lines = materialise(
        map_rows(rows, make, f"id {id_type}, text_hash long, doc string, hashes array<long>, numbers array<int>, sizes array<int>, "
                             "marks array<struct<at:int,end:int,gram:binary>>", batch_rows=2_000), "lines")
    grams = lines.select("id", "text_hash", "doc", F.explode("marks").alias("m")).select("id", "text_hash", "doc", "m.*")
    place = F.struct(F.isnull("id").alias("none"), "id", "text_hash", "at", "doc")
    first = materialise(
        grams.groupBy("gram").agg(F.min(place).alias("p"), F.count("*").alias("n")).where("n > 1").select(
            "gram", F.col("p.doc").alias("doc0"), F.col("p.at").alias("at0")), "first")
    # sort-merge joins at every size: their cost grows evenly and AQE splits hot keys
    pairs = grams.select("gram", "doc", "at", "end").join(first.hint("merge"), "gram").where(
        (F.col("doc") != F.col("doc0")) | (F.col("at") != F.col("at0"))).groupBy("doc", "doc0").agg(
        F.collect_set(F.struct("at", "end", "at0")).alias("marks"))
    pairs = materialise(pairs, "pairs")
    once = lines.dropDuplicates(["doc"])  # rows that repeat id and text are one document
    source = once.select(F.col("doc").alias("doc0"), F.col("hashes").alias("other"))
    own = once.select("doc", "hashes", "numbers")
    matched = pairs.join(source.hint("merge"), "doc0").join(own.hint("merge"), "doc").select(
        "doc", "hashes", "numbers", "other", "marks")

    def make_runs():
        def one(doc, hashes, numbers, other, marks):
            runs = _runs(hashes, numbers, other, [(m["at"], m["end"], m["at0"]) for m in marks])
            return [(doc, runs)] if runs else []

        return one

    run_schema = "doc string, runs array<struct<lo:int,hi:int>>"
    found = map_rows(matched, make_runs, run_schema, batch_rows=2_000)

    # whole windows around the repeated fingerprints
    held = grams.select("gram", "doc", "at", "end").join(first.select("gram").hint("merge"), "gram").groupBy("doc").agg(
        F.collect_set(F.struct("at", "end")).alias("held"))
    around = once.select("id", "text_hash", "doc", "hashes", "numbers", "sizes").join(held.hint("merge"), "doc").select(
        "id", "text_hash", "doc", "hashes", "numbers", "sizes", "held")

    def make_windows():
        from array import array

        from xxhash import xxh3_128_digest

        def one(i, text_hash, doc, hashes, numbers, sizes, held):
            for lo, hi in windows(sizes, [(m["at"], m["end"]) for m in held], window_words):
                yield i, text_hash, doc, lo, numbers[lo], numbers[hi], xxh3_128_digest(array("q", hashes[lo:hi + 1]).tobytes())

        return one

    whole = materialise(map_rows(around, make_windows, f"id {id_type}, text_hash long, doc string, at int, lo int, hi int, "
                                                       "lines binary"), "windows")
    earliest = whole.groupBy("lines").agg(F.min(place).alias("p"), F.count("*").alias("n")).where("n > 1").select(
        "lines", F.col("p.doc").alias("doc0"), F.col("p.at").alias("at0"))
    later = whole.join(earliest.hint("merge"), "lines").where((F.col("doc") != F.col("doc0")) | (F.col("at") != F.col("at0")))
    cut = later.groupBy("doc").agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))

    def make_merged():
        return lambda doc, runs: [(doc, _merge([(r["lo"], r["hi"]) for r in runs]))]

    every = found.union(cut).groupBy("doc").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    return map_rows(every, make_merged, run_schema, batch_rows=2_000)


def _doc(id_column: Column, text_hash: Column) -> Column:
    """Key that tells documents apart by id (null is an id of its own) and text."""
    return F.concat_ws(":", F.isnull(id_column).cast("string"), id_column.cast("string"),
                       F.coalesce(text_hash.cast("string"), F.lit("")))


def _without(text: Column, runs: Column) -> Column:
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.exists(runs, lambda r: (i >= r["lo"]) & (i <= r["hi"])))
    return F.array_join(kept, "\n")


def drop_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS,
                       report: str | None = None) -> DataFrame:
    """``docs`` (all columns, every row) with later repeated runs cut from the text.

    A text that loses all lines becomes empty; null texts stay null; blank
    lines inside a deleted run go with it.  ``report`` names an extra column
    with the deleted ``(lo, hi)`` line ranges (null: none).
    """
    runs = materialise(repeated_runs(docs, id_col, text_col, gram_words, window_words), "runs")
    mark, k_doc, k_runs = fresh(docs, "doc", "run_doc", "runs")
    cuts = runs.select(F.col("doc").alias(k_doc), F.col("runs").alias(k_runs)).hint("merge")
    joined = docs.withColumn(mark, _doc(col(id_col), F.xxhash64(col(text_col)))).join(cuts, col(mark) == col(k_doc), "left")
    text = F.when(col(k_runs).isNull(), col(text_col)).otherwise(_without(col(text_col), col(k_runs)))
    out = [text.alias(c) if c == text_col else col(c) for c in docs.columns]
    return joined.select(*out, *([col(k_runs).alias(report)] if report else []))
