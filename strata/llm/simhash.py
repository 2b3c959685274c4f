"""SimHash near-duplicates with a generalised pigeonhole index.

Fingerprint: 64 majority bits over the XXH64 hashes of word shingles.  Two
fingerprints link when they differ in at most ``max_distance`` bits.

Search (generalised pigeonhole): split the 64 bits into m groups and give
group i a threshold t_i >= -1 with sum(t_i) = max_distance - m + 1.  Two
fingerprints within ``max_distance`` then agree within t_i bits on at least one
group, whatever the split, so the candidate search loses nothing.  Correlated
bits share a group; m and the thresholds come from a dynamic programme over
candidate counts estimated on a bounded sample of fingerprints (the sample
steers cost only, never the result).
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, fresh, hash_share, map_rows, materialise
from strata.llm.graph import components

BITS = 64
SEED = 42
#: About so many fingerprints are looked at when groups and thresholds are planned.
PLAN_SAMPLE = 2_000
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Signed 64-bit SimHash of a whole text; 0 when it has no word.

    A-Z are lower-cased, words are maximal runs without ASCII white space,
    shingles are space-joined and counted with repeats; a text of fewer words
    is one shingle.  A bit is set when over half the shingle hashes set it.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], spaces + 1))[:n].tolist()
    ends = np.concatenate((spaces, [len(joined)]))[-n:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for lo in range(0, n, _CHUNK):
        part = range(lo, min(n, lo + _CHUNK))
        hashes = np.fromiter((digest(joined[starts[i]:ends[i]], SEED) for i in part), np.uint64, len(part))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``(id, text_hash, fp)`` per row; ``text_hash`` tells rows that repeat an id apart."""
    rows = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("text_hash"),
                       col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def make():
        return lambda i, h, text: ((i, h, fingerprint(text, shingle)),)

    return map_rows(rows, make, f"id {id_type}, text_hash long, fp long")


# ---------------------------------------------------------------- planning
def group_bits(bits: np.ndarray, m: int) -> list[list[int]]:
    """Split the bit positions into m groups of near-equal size, correlated bits together."""
    x = bits.astype(np.float64) - bits.mean(axis=0)
    norm = np.sqrt((x * x).sum(axis=0))
    corr = np.abs(x.T @ x) / np.maximum(np.outer(norm, norm), 1e-9)
    np.fill_diagonal(corr, -1.0)
    left, groups = list(range(bits.shape[1])), []
    for part in np.array_split(np.arange(bits.shape[1]), m):
        # start from the most correlated bits left, then follow the strongest link into the group
        group = [max(left, key=lambda b: (corr[b, left].max(), -b))]
        left.remove(group[0])
        while len(group) < len(part):
            group.append(max(left, key=lambda b: (corr[b, group].max(), -b)))
            left.remove(group[-1])
        groups.append(sorted(group))
    return groups


def _close_share(bits: np.ndarray, group: list[int], max_distance: int) -> np.ndarray:
    """Estimated share of pairs within t bits on ``group``, t = 0..max_distance.

    Sample pairs are counted without those that are links anyway; a random-bit
    floor keeps the estimate positive where the sample sees no pair."""
    part = bits[:, group].astype(np.float32)
    ones = part.sum(axis=1)
    near = ones[:, None] + ones[None, :] - 2 * (part @ part.T)
    full = bits.astype(np.float32)
    ones = full.sum(axis=1)
    distinct = np.triu(ones[:, None] + ones[None, :] - 2 * (full @ full.T) > max_distance + 0.5, 1)
    pairs = max(1, int(distinct.sum()))
    seen = np.array([(near[distinct] <= t + 0.5).sum() / pairs for t in range(max_distance + 1)])
    width = len(group)
    floor = np.cumsum([comb(width, t) for t in range(max_distance + 1)]) / 2.0 ** width
    return np.maximum(seen, floor)


def plan(sample: np.ndarray, n: int, max_distance: int = 4) -> list[tuple[list[int], int]]:
    """Groups with thresholds: ``[(bit positions, threshold)]``, thresholds of -1 left out.

    ``sample`` is an (s, 64) 0/1 array of fingerprints, ``n`` the number of
    distinct fingerprints.  For each m the thresholds are allocated by dynamic
    programming over sum(t_i) = max_distance - m + 1 on the estimated number
    of probes plus candidates; the cheapest m wins.
    """
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(1, max_distance + 2):
        groups, budget = group_bits(sample, m), max_distance - m + 1
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            share = _close_share(sample, group, max_distance)
            step: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, chosen) in table.items():
                for t in range(-1, max_distance + 1):
                    probes = 0 if t < 0 else sum(comb(len(group), d) for d in range(t + 1))
                    more = cost + (0 if t < 0 else n * probes + 0.2 * float(n) * n * share[t])
                    key = used + t
                    if key not in step or more < step[key][0]:
                        step[key] = (more, [*chosen, t])
            table = step
        cost, chosen = table[budget]
        if best is None or cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, chosen) if t >= 0])
    return best[1]


# ---------------------------------------------------------------- search
def _mask(bits) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _flips(group: list[int], threshold: int) -> list[int]:
    return [_mask(c) for d in range(threshold + 1) for c in combinations(group, d)]


def _keys(fps: DataFrame, groups: list[tuple[list[int], int]], probe: bool) -> DataFrame:
    """One row per (group, value) that a fingerprint is filed under or probes."""
    out = None
    for g, (bits, threshold) in enumerate(groups):
        value = F.col("fp").bitwiseAND(F.lit(_mask(bits)).cast("long"))
        flips = _flips(bits, threshold) if probe else [0]
        part = fps.select(F.lit(g).alias("g"), F.explode(F.transform(
            F.lit(flips).cast("array<long>"), lambda x: value.bitwiseXOR(x))).alias("value"), "fp", "label")
        out = part if out is None else out.union(part)
    return out


def _distance(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def link(classes: DataFrame, max_distance: int = 4) -> DataFrame:
    """``(fp, root)`` for distinct fingerprints ``classes(fp)``: the components of
    "differs in at most ``max_distance`` bits".

    First every fingerprint is compared with the smallest of its exact-value
    bucket (linear), which joins most of a dense group of near copies; then the
    full pigeonhole probe runs for pairs whose components still differ, so a
    dense group does not emit its links pair by pair.
    """
    n = classes.count()
    rows = classes.where(hash_share(classes, ["fp"], PLAN_SAMPLE, n)).collect()
    packed = np.array([r["fp"] for r in rows], np.int64).view(np.uint8).reshape(-1, 8)
    sample = np.unpackbits(packed, axis=1, bitorder="little") if rows else np.zeros((1, BITS), np.uint8)
    groups = plan(sample, max(n, 1), max_distance)

    filed = _keys(classes.select("fp", F.col("fp").alias("label")), groups, probe=False)
    hubs = filed.groupBy("g", "value").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).where("n > 1")
    stars = filed.join(hubs.drop("n"), ["g", "value"]).where(
        (F.col("fp") != F.col("hub")) & (_distance("fp", "hub") <= max_distance))
    first = materialise(components(stars.select(F.col("fp").alias("u"), F.col("hub").alias("v"))), "hubs")
    labelled = materialise(classes.join(first, classes["fp"] == first["node"], "left").select(
        classes["fp"], F.coalesce("root", classes["fp"]).alias("label")), "labelled")

    index = _keys(labelled, groups, probe=False).alias("a")
    probes = _keys(labelled, groups, probe=True).alias("b")
    links = index.join(probes, (F.col("a.g") == F.col("b.g")) & (F.col("a.value") == F.col("b.value"))
                       & (F.col("a.label") != F.col("b.label")) & (F.col("a.fp") < F.col("b.fp"))
                       & (_distance("a.fp", "b.fp") <= max_distance))
    merged = components(links.select(F.col("a.label").alias("u"), F.col("b.label").alias("v")).distinct())
    return labelled.join(merged, labelled["label"] == merged["node"], "left").select(
        "fp", F.coalesce("root", "label").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """``(id, text_hash, fp, root, component)`` per row of ``docs``.

    ``root`` names the group (one of its fingerprints); ``component`` is the
    smallest id reachable through links (null ids count last; null only if all
    ids are null).  Null and empty texts have fingerprint zero and link like any
    other.  Rows that repeat an id keep their own fingerprint, so two groups
    may share a component but never a root.  An empty table gives an empty result.
    """
    fps = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = materialise(fps.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = link(classes.select("fp"), max_distance)
    member = classes.join(roots, "fp").select("fp", "root", "least")
    least = member.groupBy("root").agg(F.min("least").alias("component"))
    named = materialise(member.join(least, "root").select("fp", "root", "component"), "components")
    return fps.join(named, "fp").select("id", "text_hash", "fp", "root", "component")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """``docs`` (all columns) with one row of each near-duplicate group.

    The row with the smallest id stays (null ids last); rows that agree in id
    and text count once, rows that repeat an id with unlike texts are groups of
    their own.  Extra columns pass through.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, max_distance)
    first = found.groupBy("root").agg(F.min(F.struct(
        F.isnull("id").alias("none"), F.col("id"), F.col("text_hash"))).alias("first"))
    keep = first.select(F.col("first.id").alias("keep_id"), F.col("first.text_hash").alias("keep_hash"))
    (mark,) = fresh(docs, "text_hash")
    hashed = docs.withColumn(mark, F.xxhash64(col(text_col)))
    kept = hashed.join(keep, hashed[mark].eqNullSafe(keep["keep_hash"])
                       & col(id_col).eqNullSafe(keep["keep_id"]), "left_semi")
    return kept.dropDuplicates([mark, id_col]).drop(mark)
