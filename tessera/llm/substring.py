"""Substring dedup on a compacted de Bruijn graph of word windows.

The edges of the graph are the windows of `window` words. Only edges that occur twice matter, so the corpus is first
thinned: every window is represented by its smallest k-mer (its minimizer), and equal windows share it. k-mers that
occur once rule their windows out. The windows that follow one another with one minimizer are a path without branches
inside a document (a super-k-mer): equal paths are joined to the coordinates of their first occurrence, and all but the
first are repeated as a whole. Only where one minimizer has different paths, that is at the ends of passages, are the
first occurrences looked at window by window: repeated edges get the coordinates of their first occurrence, edges that
follow one another at the source with equal counts compact into paths by a join on those coordinates, and a document's
occurrences of a path become spans. Every span's words are checked against the words at its source's coordinates
(SHA-256 of both) before they are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import drop_saved, release, save

#: A null id is treated as this one.
NO_ID = -(1 << 63)
#: Windows of one text handled at once.
STRETCH = 1 << 20
_CACHE_WORDS = 300_000


class _Hashes(dict):
    """XXH64 of words, worked out once."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_cache = _Hashes()
_MUL = np.uint64(0x9E3779B97F4A7C15)
_POS = np.uint64((1 << 24) - 1)


def _hash_words(words: list[bytes]) -> np.ndarray:
    if len(_cache) > _CACHE_WORDS:
        _cache.clear()
    return np.fromiter(map(_cache.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _run_hash(h: np.ndarray, length: int, mul: np.uint64 = _MUL) -> np.ndarray:
    """A 64-bit hash of every run of `length` words."""
    n = len(h) - length + 1
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out *= mul
        out += h[j : j + n]
    return _mixed(out)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def minimizers(h: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k-mer hash, first window, last window): the runs of windows that share a minimizer, in order."""
    found: list[tuple] = []
    for lo in range(0, max(0, len(h) - window + 1), STRETCH):
        part = h[lo : lo + STRETCH + window - 1]
        kmers = _run_hash(part, k)
        order = (kmers & ~_POS) | np.arange(len(kmers), dtype=np.uint64)  # leftmost of equal k-mers
        at = (_sliding_min(order, window - k + 1) & _POS).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:] - 1, len(at) - 1]
        found.append((kmers[at[first]].view(np.int64), first + lo, last + lo))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def minimizers_of(h: np.ndarray, lengths: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """minimizers() of many short texts laid end to end: (k-mer hash, first window, last window, text), all at once."""
    counts = np.maximum(lengths - window + 1, 0)
    total = int(counts.sum())
    if not total:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    kmers = _run_hash(h, k)
    order = (kmers & ~_POS) | np.arange(len(kmers), dtype=np.uint64)
    least = (_sliding_min(order, window - k + 1) & _POS).astype(np.int64)
    text = np.repeat(np.arange(len(lengths)), counts)
    start = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    at = least[(np.cumsum(lengths) - lengths)[text] + start]  # windows inside one text only
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[first[1:] - 1, total - 1]
    return kmers[at[first]].view(np.int64), start[first], start[last], text[first]


def _hashed(words: list[list[bytes]], window: int, k: int) -> tuple[np.ndarray, ...]:
    """(hashes of all words, where each text begins, k-mer, first, last, text) of texts with their minimizer runs."""
    lengths = np.array([len(w) for w in words], np.int64)
    h = _hash_words([w for text in words for w in text])
    begin = np.cumsum(lengths) - lengths
    if len(h) <= STRETCH:
        return h, begin, *minimizers_of(h, lengths, window, k)
    runs = [minimizers(h[b : b + n], window, k) for b, n in zip(begin, lengths, strict=True)]
    text = np.repeat(np.arange(len(words)), [len(r[0]) for r in runs])
    return h, begin, *(np.concatenate([r[i] for r in runs]) for i in range(3)), text


def _sequence_key(words: list[bytes]) -> tuple[bytes, int]:
    sha = hashlib.sha256(b" ".join(words)).digest()
    return sha, int.from_bytes(sha[:8], "little", signed=True)


def _sketch_batches(window: int, k: int):
    names = ["id", "hs", "sha", "n_words", "kmers", "ats"]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                words = [(text or b"").split() for text in batch.column(1).to_pylist()]
                shas, keys = zip(*map(_sequence_key, words), strict=True)
                _, _, kmer, first, last, text = _hashed(words, window, k)
                ends = pa.array(np.searchsorted(text, np.arange(len(words) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(keys, pa.int64()),
                        pa.array(shas, pa.binary()),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(kmer)),
                        pa.ListArray.from_arrays(ends, pa.array(first * 32 + (last - first))),
                    ],
                    names=names,
                )

    return run


def _path_batches(window: int, k: int):
    """Rows (id, hs, text, ats) to the candidate super-k-mers (kmer, path, id, hs, start, n): n windows from start."""

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                rows = list(_with_ranges(whole.slice(lo, 500), window))
                if not rows:
                    continue
                ids, keys, words, ranges = zip(*rows, strict=True)
                h, begin, kmer, first, last, text = _hashed(list(words), window, k)
                wanted = np.concatenate([(np.int64(i) << 40) + (r >> 5) for i, r in enumerate(ranges)])
                chosen = np.isin((text << 40) + first, wanted)
                kmer, first, text, n = kmer[chosen], first[chosen], text[chosen], (last - first + 1)[chosen]
                path, at = np.zeros(len(first), np.uint64), begin[text] + first
                for j in range(int(n.max(initial=0)) + window - 1):
                    live = np.flatnonzero(j < n + window - 1)
                    path[live] = path[live] * _MUL + h[at[live] + j]
                path = _mixed(path + n.astype(np.uint64)).view(np.int64)
                cols = [kmer, path, np.array(ids)[text], np.array(keys)[text], first, n]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["kmer", "path", "id", "hs", "start", "n"])

    return run


def _with_ranges(batch: pa.RecordBatch, window: int):
    """(id, hs, words, sorted ranges) of the rows (id, hs, text, ats) whose words belong to hs."""
    ids, keys, texts, ranges = (c.to_pylist() for c in batch.columns)
    for id_, key, text, ats in zip(ids, keys, texts, ranges, strict=True):
        words = (text or b"").split()
        if len(words) >= window and _sequence_key(words)[1] == key:
            yield id_, key, words, np.sort(np.array(ats, np.int64))


def _edge_batches(window: int):
    """Rows (id, hs, text, ats) to the candidate windows (w1, w2, id, hs, start)."""
    second = np.uint64(0xD6E8FEB86659FD93)

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                out = [[] for _ in range(5)]
                for id_, key, words, packed in _with_ranges(whole.slice(lo, 500), window):
                    first, n = packed >> 5, (packed & 31) + 1
                    starts = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))
                    h = _hash_words(words)
                    # hash only the stretches that hold candidates
                    breaks = np.flatnonzero(np.diff(starts) > window)
                    for a, b in zip(np.r_[0, breaks + 1], np.r_[breaks, len(starts) - 1], strict=True):
                        s = starts[a : b + 1]
                        part = h[s[0] : s[-1] + window]
                        out[0].append(_run_hash(part, window)[s - s[0]].view(np.int64))
                        out[1].append(_run_hash(_mixed(part + second), window, second)[s - s[0]].view(np.int64))
                        out[2].append(np.full(len(s), id_, np.int64))
                        out[3].append(np.full(len(s), key, np.int64))
                        out[4].append(s)
                cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
                for a in range(0, len(cols[0]), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 50_000]) for c in cols], names=["w1", "w2", "id", "hs", "start"])

    return run


def _digest(words: list[bytes], lo: int, hi: int) -> bytes:
    return hashlib.sha256(b" ".join(words[lo:hi])).digest()


def _cut_batches(batches):
    """Rows (id, hs, text, spans [lo, hi) with their sources' words) to (id, hs, n_removed, kept).

    Only spans whose words are the source's are removed."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 500):
            batch = whole.slice(lo, 500)
            ids, keys, texts, spans = (c.to_pylist() for c in batch.columns)
            rows = []
            for id_, key, text, cuts in zip(ids, keys, texts, spans, strict=True):
                words = (text or b"").split()
                if _sequence_key(words)[1] != key:
                    continue
                keep, upto, removed = [], 0, 0
                for cut in sorted((c["lo"], c["hi"]) for c in cuts if _digest(words, c["lo"], c["hi"]) == c["words"]):
                    keep += words[upto : max(upto, cut[0])]
                    removed += max(0, cut[1] - max(upto, cut[0]))
                    upto = max(upto, cut[1])
                keep += words[upto:]
                rows.append((id_, key, removed, hashlib.sha256(b" ".join(keep)).digest()))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["id", "hs", "n_removed", "kept"])


def repeated_paths(edges: DataFrame) -> DataFrame:
    """Repeated edges compacted into paths: (w1, w2, src_id, src_hs, src_start, path).

    edges: (w1, w2, id, hs, start). src is the first occurrence; a document is told by id and word sequence (hs), since
    ids may be null or repeated. An edge continues the path of the edge before it at the source if both occur equally
    often; `path` is the source start of the path's first edge.
    """
    firsts = (
        edges.groupBy("w1", "w2")
        .agg(F.min(F.struct("id", "start", "hs")).alias("src"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("w1", "w2", F.col("src.id").alias("src_id"), F.col("src.hs").alias("src_hs"), F.col("src.start").alias("src_start"), "n")
    )
    firsts = save(firsts, "edges")
    before = firsts.select("src_id", "src_hs", (F.col("src_start") + 1).alias("src_start"), F.col("n").alias("n_before"))
    heads = firsts.join(before, ["src_id", "src_hs", "src_start"], "left").withColumn(
        "head", F.when(F.col("n_before").eqNullSafe(F.col("n")), None).otherwise(F.col("src_start"))
    )
    along = Window.partitionBy("src_id", "src_hs").orderBy("src_start").rowsBetween(Window.unboundedPreceding, 0)
    return heads.withColumn("path", F.last("head", ignorenulls=True).over(along)).select("w1", "w2", "src_id", "src_hs", "src_start", "path")


def repeated_spans(edges: DataFrame, window: int) -> DataFrame:
    """Later occurrences of repeated paths: (id, hs, lo, hi, src_id, src_hs, src_lo), words [lo, hi) that repeat the source's.

    Every edge of a span has its own source coordinates; a span holds edges whose own and source starts both advance
    by one.
    """
    later = edges.join(repeated_paths(edges), ["w1", "w2"]).where("id > src_id or (id = src_id and start > src_start)")
    shift = F.col("start") - F.col("src_start")
    order = Window.partitionBy("id", "hs", "src_id", "src_hs", "path", "shift").orderBy("start")
    return (
        later.select("id", "hs", "start", "src_id", "src_hs", "src_start", "path", shift.alias("shift"))
        .distinct()
        .withColumn("run", F.col("start") - F.row_number().over(order))
        .groupBy("id", "hs", "src_id", "src_hs", "path", "shift", "run")
        .agg(F.min("start").alias("lo"), (F.max("start") + window).alias("hi"), F.min("src_start").alias("src_lo"))
        .select("id", "hs", "lo", "hi", "src_id", "src_hs", "src_lo")
    )


def joined(spans: DataFrame) -> DataFrame:
    """Spans that touch or overlap, of one document and with one shift to one source, as one span."""
    group = ["id", "hs", "src_id", "src_hs", "shift"]
    order = Window.partitionBy(*group).orderBy("lo", "hi")
    begins = F.coalesce(F.col("lo") > F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    return (
        spans.withColumn("shift", F.col("lo") - F.col("src_lo"))
        .withColumn("begins", begins.cast("int"))
        .withColumn("run", F.sum("begins").over(order))
        .groupBy(*group, "run")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("src_lo").alias("src_lo"))
        .select("id", "hs", "lo", "hi", "src_id", "src_hs", "src_lo")
    )


def _word_batches(batches):
    """Rows (id, hs, text, ranges [lo, hi)) to (src_id, src_hs, src_lo, n, words): SHA-256 of the words of every range."""
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            rows = []
            for id_, key, text, ranges in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or b"").split()
                if _sequence_key(words)[1] == key:
                    rows += [(id_, key, r["lo"], r["hi"] - r["lo"], _digest(words, r["lo"], r["hi"])) for r in ranges]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["src_id", "src_hs", "src_lo", "n", "words"])


def with_source_words(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """Spans (id, hs, lo, hi, src_id, src_hs, src_lo) with `words`, the SHA-256 of the words at the source's coordinates.

    texts: (id, hs, text), a row for each. Every source is read once for all the spans that point at it.
    """
    n = (F.col("hi") - F.col("lo")).alias("n")
    wanted = spans.select("src_id", "src_hs", F.col("src_lo").alias("lo"), (F.col("src_lo") + F.col("hi") - F.col("lo")).alias("hi")).distinct()
    wanted = save(wanted.groupBy(F.col("src_id").alias("id"), F.col("src_hs").alias("hs")).agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "sources")
    words = texts.join(wanted, ["id", "hs"]).select("id", "hs", "text", "ranges").mapInArrow(
        _word_batches, "src_id long, src_hs long, src_lo long, n long, words binary"
    )
    words = save(words, "source-words")
    return spans.select("*", n).join(words, ["src_id", "src_hs", "src_lo", "n"])


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 20,
    k: int = 8,
    broadcast_ids: int = 300_000,
) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256, after removing words in windows that started earlier.

    Earlier means a smaller id, or the same id and an earlier start. A later document with the same word sequence is
    removed as a whole (if it has a window) without looking at its windows; the others are looked up through their
    minimizers. Sets of ids up to broadcast_ids (8 bytes each) are broadcast to filter before a shuffle, larger ones
    are joined by a shuffle.

    A null text has no words. A null id counts as the smallest. Rows repeated with the same id and text are one
    document: none of them starts earlier, and each gets the same result. Shorter texts than a window stay as they
    are. Other columns of the input are not read. An empty table gives an empty result.
    """
    if window - k + 1 > 32:
        raise ValueError("a minimizer may stand for 32 windows at most")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("binary").alias("text"))
    spark = docs.sparkSession
    sketch = save(
        rows.mapInArrow(
            _sketch_batches(window, k), "id long, hs long, sha binary, n_words long, kmers array<long>, ats array<long>"
        ),
        "sketch",
    )
    own = save(sketch.select("id", "hs", "sha", "n_words"), "own")
    classes = own.groupBy("hs", "sha").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    classes = save(classes.select("hs", "sha", "rep"), "classes")
    copies = save(own.join(classes, ["hs", "sha"]).where("id > rep").select("id", "hs").distinct(), "copies")

    def bounded(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= broadcast_ids else df

    kmers = (
        sketch.where(f"n_words >= {window}")
        .select("id", "hs", "kmers", "ats")
        .join(bounded(copies), ["id", "hs"], "left_anti")
        .select("id", "hs", F.explode(F.arrays_zip("kmers", "ats")).alias("x"))
        .select("id", "hs", F.col("x.kmers").alias("kmer"), F.col("x.ats").alias("at"))
    )
    # written out, so that the join of a hot k-mer can be split
    again = save(kmers.groupBy("kmer").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("kmer"), "again")
    ranges = save(kmers.join(again, "kmer").groupBy("id", "hs").agg(F.collect_set("at").alias("ats")), "ranges")
    drop_saved(sketch)
    release(spark)
    wanted = rows.join(bounded(ranges.select("id").distinct()), "id", "left_semi")
    # rows repeated with one id and text are looked at once
    suspects = save(wanted.join(ranges, "id").select("id", "hs", "text", "ats").dropDuplicates(["id", "hs", "text"]), "suspects")
    release(spark)
    paths = save(suspects.mapInArrow(_path_batches(window, k), "kmer long, path long, id long, hs long, start long, n long"), "paths")
    firsts = save(
        paths.groupBy("kmer", "path")
        .agg(F.min(F.struct("id", "start", "hs", "n")).alias("src"), F.count(F.lit(1)).alias("times"))
        .select("kmer", "path", "times", F.col("src.id").alias("src_id"), F.col("src.start").alias("src_lo"), F.col("src.hs").alias("src_hs"), F.col("src.n").alias("src_n")),
        "firsts",
    )
    repeated = (
        paths.join(firsts.where("times > 1"), ["kmer", "path"])
        .where("id > src_id or (id = src_id and start > src_lo)")
        .select("id", "hs", F.col("start").alias("lo"), (F.col("start") + F.col("n") - 1 + window).alias("hi"), "src_id", "src_hs", "src_lo")
    )
    repeated = save(repeated, "spans")
    forked = save(firsts.groupBy("kmer").agg(F.count(F.lit(1)).alias("forks")).where("forks > 1").select("kmer"), "forked")
    ends = (
        firsts.join(forked, "kmer")
        .groupBy(F.col("src_id").alias("id"), F.col("src_hs").alias("hs"))
        .agg(F.collect_set(F.col("src_lo") * 32 + F.col("src_n") - 1).alias("ats"))
    )
    ends = save(ends, "ends")
    drop_saved(paths)
    drop_saved(firsts)
    release(spark)
    at_ends = suspects.drop("ats").join(bounded(ends.select("id", "hs")), ["id", "hs"], "left_semi").join(ends, ["id", "hs"])
    edges = at_ends.select("id", "hs", "text", "ats").mapInArrow(_edge_batches(window), "w1 long, w2 long, id long, hs long, start long")
    edges = save(edges, "windows")
    spans = repeated.unionByName(save(repeated_spans(edges, window), "spans"))
    spans = with_source_words(save(joined(spans), "spans"), suspects.select("id", "hs", "text"))
    spans = save(spans.groupBy("id", "hs").agg(F.collect_list(F.struct("lo", "hi", "words")).alias("spans")), "spans")
    drop_saved(edges)
    release(spark)
    cut = (
        suspects.join(bounded(spans.select("id", "hs")), ["id", "hs"], "left_semi")
        .join(spans, ["id", "hs"])
        .select("id", "hs", "text", "spans")
        .mapInArrow(_cut_batches, "id long, hs long, n_removed long, kept binary")
    )
    gone = copies.select("id", "hs", F.lit(True).alias("gone")).distinct()
    nothing = F.unhex(F.lit(hashlib.sha256(b"").hexdigest()))
    whole = F.col("gone").isNotNull() & (F.col("n_words") >= window)
    return (
        own.join(gone, ["id", "hs"], "left")
        .join(cut, ["id", "hs"], "left")
        .select(
            F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col),
            "n_words",
            F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.lower(F.hex(F.when(whole, nothing).otherwise(F.coalesce("kept", "sha")))).alias("kept_sha256"),
        )
    )
