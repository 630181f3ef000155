"""Quality classifier: a weak-label model over heuristic labellers, and a hashed linear scorer trained on its posteriors."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_sample, save, text_slices

#: Labeller: (bad from, good below, words needed). In between, and on shorter texts, it abstains.
LABELLERS = {
    "repeats": (0.10, 0.04, 10),  # words equal to the word before
    "capitals": (0.40, 0.15, 10),  # capital letters among letters
    "symbols": (0.04, 0.01, 5),  # characters that are no letter, digit, white space or common punctuation
    "bare": (0.12, 0.03, 10),  # words without a letter or digit
    "trigrams": (0.35, 0.12, 60),  # word triples that occur again in the text
    "variety": (-0.30, -0.50, 40),  # minus the share of distinct words in windows of 300 words, their mean
    "marked": (0.25, 0.08, 10),  # words that end with two or more marks
}
_EDGES = {
    "repeats": (0.01, 0.03, 0.06, 0.1, 0.2, 0.5),
    "capitals": (0.02, 0.05, 0.1, 0.2, 0.4, 0.7),
    "symbols": (0.001, 0.005, 0.01, 0.02, 0.04, 0.1),
    "bare": (0.005, 0.02, 0.05, 0.12, 0.25, 0.4),
    "trigrams": (0.02, 0.06, 0.12, 0.2, 0.35, 0.6),
    "variety": (-0.8, -0.7, -0.6, -0.5, -0.3, -0.15),
    "marked": (0.01, 0.04, 0.08, 0.15, 0.25, 0.5),
}
_STATS = list(LABELLERS)
_BINS = 7
_LENGTHS = (2, 5, 10, 20, 40, 80, 160, 320, 640, 1280)
_LOWEST = len(_STATS) * _BINS + len(_LENGTHS) + 1  # bins of the least variety of a window, which has no vote
_FIXED = _LOWEST + _BINS
_HELD_WORDS = 400_000

_SPACE, _LOWER, _UPPER, _DIGIT, _COMMON, _OTHER = range(6)
_KIND = np.full(256, _OTHER, np.int64)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[97:123] = _KIND[128:256] = _LOWER
_KIND[65:91] = _UPPER
_KIND[48:58] = _DIGIT
_KIND[[ord(c) for c in ".,;:'\"-?()"]] = _COMMON
_SHAPE = bytes(97 if k == _LOWER else 65 if k == _UPPER else 57 if k == _DIGIT else i for i, k in enumerate(_KIND))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


class _Words(dict):
    """Numbers for words and, in arrays by number, what is known of each; forgotten as a whole between texts when large."""

    def __init__(self, dims: int):
        super().__init__()
        self.dims = dims
        self.shape, self.bare, self.marked = (np.zeros(1 << 16, kind) for kind in (np.int64, bool, bool))

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        if n >= len(self.shape):
            self.shape, self.bare, self.marked = (np.concatenate([x, np.zeros_like(x)]) for x in (self.shape, self.bare, self.marked))
        shape = word.translate(_SHAPE)
        self.bare[n] = not (b"a" in shape or b"A" in shape or b"9" in shape)
        self.marked[n] = len(shape) > 1 and shape[-1] not in b"aA9" and shape[-2] not in b"aA9"
        self.shape[n] = _FIXED + zlib.crc32(_RUN.sub(rb"\1+", shape)) % (self.dims - _FIXED)
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _HELD_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def variety(ids: np.ndarray, window: int = 300) -> tuple[float, float]:
    """Mean and least share of distinct words in windows that cover the whole text; the last one ends with it."""
    n = len(ids)
    if n <= window:
        share = len(np.unique(ids)) / max(1, n)
        return share, share
    starts = np.r_[np.arange(0, n - window, window), n - window]
    distinct = np.empty(len(starts), np.int64)
    for lo in range(0, len(starts), 1000):
        rows = np.sort(ids[starts[lo : lo + 1000, None] + np.arange(window)], axis=1)
        distinct[lo : lo + 1000] = 1 + (rows[:, 1:] != rows[:, :-1]).sum(axis=1)
    return float(distinct.mean()) / window, int(distinct.min()) / window


def describe(text: bytes, known: _Words) -> tuple[int, np.ndarray, np.ndarray]:
    """(votes in base 3, feature numbers, feature values) of a whole text."""
    words = text.split()
    n = len(words)
    kinds = np.zeros(6, np.int64)
    for at in range(0, len(text), 1 << 20):
        kinds += np.bincount(_KIND[np.frombuffer(text[at : at + (1 << 20)], np.uint8)], minlength=6)
    ids = known.numbers(words)
    triples = (ids[:-2] * 1_000_003 + ids[1:-1]) * 1_000_003 + ids[2:] if n > 2 else ids[:0]
    _, times = np.unique(triples, return_counts=True)
    mean, least = variety(ids)
    stats = {
        "repeats": float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0,
        "capitals": kinds[_UPPER] / max(1, kinds[_UPPER] + kinds[_LOWER]),
        "symbols": kinds[_OTHER] / max(1, len(text)),
        "bare": int(known.bare[ids].sum()) / max(1, n),
        "trigrams": times[times > 1].sum() / max(1, n - 2),
        "variety": -mean,
        "marked": int(known.marked[ids].sum()) / max(1, n),
    }
    votes, numbers = 0, []
    for i, name in enumerate(_STATS):
        bad, good, enough = LABELLERS[name]
        x = stats[name]
        vote = 0 if n < enough else 1 if x >= bad else 2 if x < good else 0
        votes += vote * 3**i
        # a text too short for a labeller has its best bin
        numbers.append(i * _BINS + (int(np.searchsorted(_EDGES[name], x, side="right")) if n >= enough else 0))
    numbers.append(len(_STATS) * _BINS + int(np.searchsorted(_LENGTHS, n, side="right")))
    numbers.append(_LOWEST + (int(np.searchsorted(_EDGES["variety"], -least, side="right")) if n >= LABELLERS["variety"][2] else 0))
    used, counts = np.unique(known.shape[ids], return_counts=True)
    share = np.sqrt(counts / max(1, n))
    return votes, np.r_[numbers, used].astype(np.int32), np.r_[np.ones(len(numbers)), share].astype(np.float32)


def _describe_batches(dims: int):
    def run(batches):
        known = _Words(dims)
        for whole in batches:
            for batch in text_slices(whole, 2):
                rows = [describe(t or b"", known) for t in batch.column(2).to_pylist()]
                cols = list(zip(*rows, strict=True)) or [[]] * 3
                arrays = [pa.array(cols[0], pa.int32()), pa.array(list(cols[1]), pa.list_(pa.int32())), pa.array(list(cols[2]), pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=["id", "h", "votes", "numbers", "vals"])

    return run


def weak_labels(patterns: dict[int, int], labellers: int, rounds: int = 100) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of `good` for every pattern of votes, and each labeller's accuracy, by expectation-maximisation.

    patterns: {votes in base 3: number of documents}; 0 abstains, 1 votes bad, 2 votes good. Labellers vote
    independently given the class, and an abstention says nothing of it (short texts make them).
    """
    codes = np.array(sorted(patterns))
    weight = np.array([patterns[c] for c in codes], float)
    votes = codes[:, None] // 3 ** np.arange(labellers) % 3
    one_hot = np.eye(3)[votes][:, :, 1:]
    bad, good = (votes == 1).sum(axis=1), (votes == 2).sum(axis=1)
    # one vote for bad weighs more than one for good: a labeller sees one kind of bad text only
    p = np.where(bad > 0, 0.5 ** (2 * bad), 0.95)
    for _ in range(rounds):
        q = np.stack([1 - p, p], axis=1) * weight[:, None]
        # a light prior: a labeller is right more often than wrong
        prior = np.array([[2.0, 1.0], [1.0, 2.0]])
        table = np.einsum("pc,plv->clv", q, one_hot) + prior[:, None, :]
        table /= table.sum(axis=2, keepdims=True)
        share = (q.sum(axis=0) + 1) / (q.sum() + 2)
        logs = np.log(share) + np.einsum("plv,clv->pc", one_hot, np.log(table))
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
        if np.abs(new - p).max(initial=0) < 1e-9:
            break
        p = new
    right = share[0] * table[0, :, 0] + share[1] * table[1, :, 1]
    return dict(zip(codes.tolist(), p.tolist(), strict=True)), right


def fit_linear(rows: list[tuple], dims: int, rounds: int = 400, rate: float = 1.0, lean: float = 1e-4) -> np.ndarray:
    """Weights (the last one the intercept) of a logistic regression on soft labels: rows (numbers, values, label)."""
    if not rows:
        return np.zeros(dims + 1)
    x = np.zeros((len(rows), dims + 1), np.float32)
    for i, (numbers, values, _) in enumerate(rows):
        np.add.at(x[i], np.array(numbers, np.int64), np.array(values, np.float32))
    x[:, dims] = 1
    y = np.array([r[2] for r in rows], np.float32)
    used = np.flatnonzero(x.any(axis=0))
    x, w, speed = x[:, used], np.zeros(len(used), np.float32), np.zeros(len(used), np.float32)
    step = rate / max(1e-6, 0.25 * float((x * x).sum(axis=1).mean()))
    for _ in range(rounds):  # Nesterov
        at = w + 0.9 * speed
        g = x.T @ (1 / (1 + np.exp(-np.clip(x @ at, -30, 30))) - y) / len(y) + lean * at
        speed = 0.9 * speed - step * g
        w = w + speed
    out = np.zeros(dims + 1)
    out[used] = w
    return out


def _score_batches(weights: np.ndarray):
    def run(batches):
        for batch in batches:
            numbers, vals = batch.column(2), batch.column(3)
            lengths = np.diff(numbers.offsets.to_numpy())
            flat = weights[numbers.flatten().to_numpy()] * vals.flatten().to_numpy()
            logit = np.bincount(np.repeat(np.arange(batch.num_rows), lengths), flat, batch.num_rows) + weights[-1]
            score = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(4), pa.array(score)], names=["id", "h", "votes", "score"])

    return run


def quality_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    dims: int = 2048,
    train_docs: int = 8_000,
    keep_from: float = 0.5,
) -> DataFrame:
    """One row per document: id, text_hash (xxhash64 of the text), weak_label, score (both 0 to 1, higher: better), kept.

    Votes of all documents, counted by pattern (at most 3**7), estimate the labellers' accuracies. Their posteriors
    label train_docs documents (those with the smallest hashes), on which the linear scorer of `dims` hashed features
    is fitted on the driver; it scores every document from features of its whole text.

    A null or blank text has no votes and the features of an empty text: it is scored and kept or not like any other.
    Ties at keep_from are kept. Repeated rows get equal results. A null id is carried along. Other columns of the input
    are not read. An empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).cast("binary").alias("text"))
    found = rows.mapInArrow(_describe_batches(dims), f"id {id_type}, h long, votes int, numbers array<int>, vals array<float>")
    found = save(found, "features")
    patterns = {r.votes: r.n for r in found.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels, _ = weak_labels(patterns, len(_STATS)) if patterns else ({}, None)
    chosen = hash_sample(found, ["h", "id"], train_docs, sum(patterns.values())).select("numbers", "vals", "votes").collect()
    weights = fit_linear([(r.numbers, r.vals, labels[r.votes]) for r in chosen], dims)
    schema = f"id {id_type}, h long, votes int, score double"
    scored = found.select("id", "h", "numbers", "vals", "votes").mapInArrow(_score_batches(weights), schema)
    posterior = F.element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), F.col("votes")) if labels else F.lit(None).cast("double")
    return scored.select(
        F.col("id").alias(id_col), F.col("h").alias("text_hash"), posterior.alias("weak_label"), "score", (F.col("score") >= keep_from).alias("kept")
    )
