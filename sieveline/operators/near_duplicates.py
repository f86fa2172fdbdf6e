"""Near-duplicate texts by word shingles: pairs of class representatives with their exact Jaccard, and membership.

Equal normalised texts form a class, so copies are never compared. Between representatives the join is exact: two sets
of Jaccard at least theta share one of the first ``n - ceil(theta n) + 1`` shingles of either, in any common order.
The order is by document frequency, rarest first, so common shingles hardly ever lead a candidate. No cap is set and no
link is lost. Texts too short for a shingle have no pairs but still a class. Null and empty texts belong to no class.

Shingles are never moved: a pass counts them in a table of hashed counters, which only fixes the order, a second one
keeps the leading ones of each text, and only the texts of candidates are read once more and compared. Candidates are
refused where no pair at theta can be: by the shingles left after the first shared one, and by the bits in which the
parities of both sets differ, which are never more than the shingles in which they do.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.text import jaccard
from ..functions.text_udf import nfkc_words, words_of
from ..runtime import written

#: Texts that a shingle may lead in one part.
PART = 2_000
#: Counters of shingles for each text, and the least and the most of all as powers of two (a byte each in the workers).
#: Fewer counters than shingles cost candidates, never a link.
COUNTERS, LEAST_BITS, MOST_BITS = 32, 16, 24
#: Counters in one row, and characters of text taken at once.
SLICE, CHARS = 1 << 16, 4_000_000
#: Ids up to which those to keep or to leave out are broadcast.
BROADCAST_IDS = 500_000

# Factors of the hash.
_PRIME, _CHARS_SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019)


def classes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``<id_col>, class_id``: the smallest id of the texts that are equal once normalised."""
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias(id_col), nfkc_words(F.col(text_col)).alias("t")).where(F.col("t") != "")
    keyed = written(rows.select(id_col, F.sha2("t", 256).alias("k")), "classes")
    first = keyed.groupBy("k").agg(F.min(id_col).alias("class_id"))
    return keyed.join(first, "k").select(id_col, "class_id").distinct()


# ---- shingles of batches ------------------------------------------------------------------------------------------------


def _windows(items: np.ndarray, sizes: np.ndarray, k: int, seed: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k`` neighbours within runs of ``sizes`` items, and the run of each."""
    if len(items) < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.full(len(items) - k + 1, seed, np.uint64)
    for i in range(k):
        h = (h ^ items[i : len(items) - k + 1 + i]) * _PRIME
        h ^= h >> np.uint64(29)
    own = np.repeat(np.arange(len(sizes)), sizes)
    inside = own[: len(h)] == own[k - 1 :]
    return h[inside], own[: len(h)][inside]


def _shingles(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shingles of texts given as words, as ``text.shingles`` has them but not yet distinct, and the text of each."""
    long = [i for i, w in enumerate(texts) if len(w) >= config.SHINGLE_MIN_WORDS]
    flat = {i: "".join(w) for i, w in enumerate(texts) if len(w) < config.SHINGLE_MIN_WORDS}
    short = [i for i, x in flat.items() if len(x) >= config.SHINGLE_MIN_CHARS]
    words = pd.util.hash_array(np.array([x for i in long for x in texts[i]], dtype=object)) if long else np.empty(0, np.uint64)
    letters = np.frombuffer("".join(flat[i] for i in short).encode("utf-32-le"), "<u4").astype(np.uint64)
    a, of_a = _windows(words, np.array([len(texts[i]) for i in long], int), config.SHINGLE_WORDS, np.uint64(0))
    b, of_b = _windows(letters, np.array([len(flat[i]) for i in short], int), config.SHINGLE_CHARS, _CHARS_SEED)
    return np.concatenate([a, b]), np.concatenate([np.array(long, int)[of_a], np.array(short, int)[of_b]])


def _distinct(h: np.ndarray, own: np.ndarray, rank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text by ``rank`` and hash, and the text of each. A shingle has one rank."""
    o = np.lexsort((h, own if rank is None else own << 8 | rank))
    h, own = h[o], own[o]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return h[new], own[new]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[list[str]]]]:
    """Ids and words of rows of about ``CHARS`` characters of text."""
    for b in batches:
        texts, start, size = b.column("t").to_pylist(), 0, 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= CHARS or i == len(texts) - 1:
                yield b.column("id").slice(start, i + 1 - start), [words_of(x) for x in texts[start : i + 1]]
                start, size = i + 1, 0


def _key(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()


def _lists(values: np.ndarray, own: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """``values`` as one list for each of ``n`` texts."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


# ---- passes -------------------------------------------------------------------------------------------------------------


def _rank(counts: np.ndarray) -> np.ndarray:
    """Counts as a byte that never falls as they rise: 0 for none, 1 for one alone, then eight steps for each power of two."""
    return np.where(counts > 0, np.minimum(255, 8 * np.log2(np.maximum(counts, 1)) + 1), 0).astype(np.uint8)


def _ranks(rows: DataFrame) -> np.ndarray:
    """By the low bits of a shingle, the rank of at least how many texts have it."""
    bits = min(max(LEAST_BITS, (COUNTERS * rows.select("id").count()).bit_length()), MOST_BITS)
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.uint32)
        for _, texts in _chunks(batches):
            at, n = np.unique(_shingles(texts)[0] & np.uint64(size - 1), return_counts=True)
            counts[at.astype(np.int64)] += n.astype(np.uint32)
        for i in range(0, size, SLICE):
            if (c := counts[i : i + SLICE]).any():
                # by planes of bytes, of which the upper ones are nearly all zero
                yield pa.RecordBatch.from_pydict({"slice": pa.array([i // SLICE], pa.int32()), "c": pa.array([zlib.compress(np.ascontiguousarray(c.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(SLICE, np.uint64)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"slice": pa.array([at], pa.int32()), "c": pa.array([_rank(total).tobytes()], pa.binary())})

        for b in batches:
            for i, c in zip(b.column("slice").to_pylist(), b.column("c").to_pylist()):
                if i != at:
                    if at is not None:
                        yield done()
                    at, total = i, np.zeros(SLICE, np.uint64)
                total += np.ascontiguousarray(np.frombuffer(zlib.decompress(c), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
        if at is not None:
            yield done()

    schema, ranks = "slice int, c binary", np.zeros(size, np.uint8)
    for r in rows.mapInArrow(count, schema).repartition("slice").sortWithinPartitions("slice").mapInArrow(add, schema).collect():
        ranks[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(r["c"], np.uint8)
    return ranks


def _leads(rows: DataFrame, theta: float) -> DataFrame:
    """For each text with shingles: key, number of shingles, parities, and the leading shingles that another text may have.

    ``skip`` leading ones are of this text alone; those in ``cold`` come next and lead ``PART`` texts at most, then those in ``hot``.
    """
    sent, hot_from = rows.sparkSession.sparkContext.broadcast(_ranks(rows)), int(_rank(np.array([PART]))[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = sent.value
        low = np.uint64(len(ranks) - 1)
        for ids, texts in _chunks(batches):
            h, own = _shingles(texts)
            h, own = _distinct(h, own, ranks[(h & low).astype(np.int64)])
            have, starts, n = np.unique(own, return_index=True, return_counts=True)
            if not len(have):
                continue
            bit, half = np.uint64(1) << (h >> np.uint64(40) & np.uint64(63)), h >> np.uint64(46) & np.uint64(1)
            parity = [np.bitwise_xor.reduceat(np.where(half == k, bit, np.uint64(0)), starts).view(np.int64) for k in (0, 1)]
            width = n - np.ceil(theta * n - 1e-9).astype(int) + 1
            own = np.repeat(np.arange(len(have)), n)
            lead = np.arange(len(h)) - np.repeat(starts, n) < np.repeat(width, n)
            h, own = h[lead], own[lead]
            rank, g = ranks[(h & low).astype(np.int64)], (h >> np.uint64(32)).astype(np.uint32).view(np.int32)
            alone, hot = rank == 1, rank >= hot_from
            cold = ~alone & ~hot
            yield pa.RecordBatch.from_pydict({
                "id": ids.take(pa.array(have)), "k": pa.array([_key(texts[i]) for i in have], pa.binary()), "n": pa.array(n, pa.int32()), "p": pa.array(parity[0]), "q": pa.array(parity[1]),
                "skip": pa.array(np.bincount(own[alone], minlength=len(have)), pa.int32()), "cold": _lists(g[cold], own[cold], len(have), pa.int32()), "hot": _lists(g[hot & ~alone], own[hot & ~alone], len(have), pa.int32()),
            })

    fields = [T.StructField("id", rows.schema["id"].dataType), *T.StructType.fromDDL("k binary, n int, p bigint, q bigint, skip int, cold array<int>, hot array<int>").fields]
    return rows.mapInArrow(run, T.StructType(fields))


def _sets(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunks(batches):
            h, own = _distinct(*_shingles(texts))
            yield pa.RecordBatch.from_pydict({"id": ids, "k": pa.array([_key(t) for t in texts], pa.binary()), "s": _lists(h.view(np.int64), own, len(texts), pa.int64())})

    return rows.mapInArrow(run, T.StructType([T.StructField("id", rows.schema["id"].dataType), *T.StructType.fromDDL("k binary, s array<bigint>").fields]))


def _only(df: DataFrame, few: DataFrame, on: list[str], how: str) -> DataFrame:
    """Semi or anti join; ``few`` is broadcast while it is that."""
    return df.join(F.broadcast(few) if few.count() <= BROADCAST_IDS else few, on, how)


# ---- pairs --------------------------------------------------------------------------------------------------------------


def _candidates(heads: DataFrame, on: list[str], others: DataFrame, theta: float) -> DataFrame:
    a, b = heads.alias("a"), others.alias("b")
    both, apart = F.col("a.n") + F.col("b.n"), F.bit_count(F.col("a.p").bitwiseXOR(F.col("b.p"))) + F.bit_count(F.col("a.q").bitwiseXOR(F.col("b.q")))
    left = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))  # shared shingles at most, if this is the first one
    close = (F.col("a.id") < F.col("b.id")) & (left >= both * (theta / (1 + theta)) - 1e-6) & (apart <= both * ((1 - theta) / (1 + theta)) + 1e-6)
    for c in on:
        close = (F.col(f"a.{c}") == F.col(f"b.{c}")) & close
    return a.join(b, close).select(F.col("a.id").alias("class_a"), F.col("b.id").alias("class_b"))


def pairs(df: DataFrame, id_col: str, text_col: str, theta: float = config.NEAR_DUPLICATE_THETA) -> DataFrame:
    """``class_a, class_b, similarity`` of all pairs of different classes at ``theta`` or above."""
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    leads = written(_leads(rows, theta), "leads")
    first = leads.groupBy("k").agg(F.min("id").alias("first"), F.max("id").alias("last")).where(F.col("first") != F.col("last")).drop("last")
    copies = written(leads.select("id", "k").join(first, "k").where(F.col("id") != F.col("first")).select("id", "k").distinct(), "copies")
    reps = _only(leads, copies, ["id", "k"], "left_anti")
    cold = reps.select("id", "n", "p", "q", "skip", F.posexplode("cold").alias("i", "g")).select("g", "id", "n", (F.col("skip") + F.col("i")).alias("at"), "p", "q")
    hot = reps.select("id", "n", "p", "q", (F.col("skip") + F.size("cold")).alias("skip"), F.posexplode("hot").alias("i", "g")).select("g", "id", "n", (F.col("skip") + F.col("i")).alias("at"), "p", "q")
    # a shingle that leads many texts is split: either side of a pair falls into one part and meets all of the other
    parts = hot.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    split = hot.join(parts, "g")
    a = split.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    b = split.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    found = written(_candidates(cold, ["g"], cold, theta).unionByName(_candidates(a, ["g", "part"], b, theta)).distinct(), "candidates")
    ids = found.select(F.col("class_a").alias("id")).unionByName(found.select(F.col("class_b").alias("id"))).distinct()
    sets = written(_only(_sets(_only(rows, written(ids, "compared"), ["id"], "left_semi")), copies, ["id", "k"], "left_anti").dropDuplicates(["id", "k"]), "shingles")
    sa, sb = sets.select(F.col("id").alias("class_a"), F.col("s").alias("sa")), sets.select(F.col("id").alias("class_b"), F.col("s").alias("sb"))
    exact = found.join(sa, "class_a").join(sb, "class_b").withColumn("similarity", jaccard(F.col("sa"), F.col("sb"), theta))
    return exact.where(F.col("similarity") >= theta - 1e-12).select("class_a", "class_b", F.round("similarity", 6).alias("similarity"))
