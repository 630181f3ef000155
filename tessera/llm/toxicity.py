"""Toxicity: a linear classifier that is penalised where swapping an identity term changes its score."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_sample, save

#: Groups of identity terms (English, German, French, Spanish); a swap puts another term of the same group in its place.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "straight", "lesbian", "bisexual", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "african", "arab", "european", "american"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("blind", "deaf", "disabled", "elderly", "young", "old"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("schwul", "lesbisch", "hetero", "bisexuell"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "katholiken", "atheisten"),
    ("einwanderer", "flüchtlinge", "einheimische", "ausländer"),
    ("femmes", "hommes", "filles", "garçons"),
    ("homosexuel", "hétérosexuel", "bisexuel", "transgenre"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "catholiques", "athées"),
    ("immigrés", "réfugiés", "autochtones", "étrangers"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("homosexual", "heterosexual", "bisexual", "transgénero"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "católicos", "ateos"),
    ("inmigrantes", "refugiados", "nativos", "extranjeros"),
)
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")
#: Of the documents without an identity term, one in so many also trains with a term put into one of its sentences.
_INSERT_ONE_IN = 4


def bucket(word: str, dims: int) -> int:
    return zlib.crc32(word.encode()) % dims


def text_words(text: str | None) -> set[str]:
    """The text's words and their beginnings of four to seven letters ("<idio"), which inflected forms share."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {f"<{w[:n]}" for w in words for n in range(4, min(7, len(w)) + 1)}


def swaps(text: str | None, groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> tuple[list[tuple[set[str], set[str]]], set[str]]:
    """What identity swaps take from and give to the words of a text's sentences, and the words of a term put in.

    Every sentence that mentions identity terms is swapped once for each of them. A text without any gets one (chosen
    by hash) put into one of its sentences, and this one is swapped, so that the score of every group is tied
    whatever the corpus mentions; of those texts one in four also gives the words put in.
    """
    place = {t: (g, i) for g, group in enumerate(groups) for i, t in enumerate(group)}
    sentences = [s for s in _SENTENCE.split((text or "").lower()) if s.strip()]
    mentions = [(s, term) for s in sentences for term in sorted(set(_WORD.findall(s)) & place.keys())]
    put_in: set[str] = set()
    if not mentions and sentences and groups:
        h = zlib.crc32((text or "").encode())
        group = groups[h % len(groups)]
        term = group[h // len(groups) % len(group)]
        mentions = [(f"{sentences[h % len(sentences)]} {term}", term)]
        put_in = text_words(term) if h // 7 % _INSERT_ONE_IN == 0 else put_in
    out = []
    for sentence, term in mentions:
        g, i = place[term]
        step = 1 + zlib.crc32(sentence.encode()) % (len(groups[g]) - 1)
        other = groups[g][(i + step) % len(groups[g])]
        before, after = text_words(sentence), text_words(re.sub(rf"(?<![^\W\d_]){term}(?![^\W\d_])", other, sentence))
        out.append((before - after, after - before))
    return out, put_in


def _word_batches(groups):
    """Rows (id, toxic, text) to (id, toxic, words, away, put, put_in); away and put have a list for every swap."""
    words = pa.list_(pa.string())
    lists = pa.list_(words)

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                cols = [[] for _ in range(4)]
                for text in batch.column(2).to_pylist():
                    changes, put_in = swaps(text, groups)
                    for col, found in zip(cols, (text_words(text), [a for a, _ in changes], [b for _, b in changes], put_in), strict=True):
                        col.append([sorted(x) for x in found] if isinstance(found, list) else sorted(found))
                arrays = [pa.array(c, t) for c, t in zip(cols, (words, lists, lists, words), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=["id", "toxic", "words", "away", "put", "put_in"])

    return run


def fit(rows: list[tuple[list[int], int]], changes: list[tuple[list[int], list[int]]], dims: int, positive_share: float, rounds: int = 400, lean: float = 2e-3, fairness: float = 5.0) -> np.ndarray:
    """Weights (the intercept last) that minimise weighted logistic loss + lean / (2 sqrt(rows)) |w|^2 +
    fairness * mean (w . change)^2.

    rows: (feature numbers, label). changes: feature numbers that a swap takes away and puts in. Each class weighs
    as its share of the labelled documents.
    """
    w, y = np.zeros(dims + 1), np.array([r[1] for r in rows], float)
    prior = np.log(max(positive_share, 1e-6) / max(1 - positive_share, 1e-6))
    w[dims] = prior
    used, at = np.unique(np.array([n for r in rows for n in r[0]], np.int64), return_inverse=True)
    if not len(used) or y.min(initial=1) == y.max(initial=0):
        return w
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    place = {n: i for i, n in enumerate(used.tolist())}
    swap = [(i, place[n], sign) for i, pair in enumerate(changes) for part, sign in zip(pair, (-1.0, 1.0), strict=True) for n in part if n in place]
    s_row, s_at, s_sign = (np.array(c) for c in zip(*swap, strict=True)) if swap else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    weight = np.where(y == 1, positive_share / max(1, y.sum()), (1 - positive_share) / max(1, (1 - y).sum()))
    v, b, m1, m2 = np.zeros(len(used)), prior, np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, rounds + 1):  # Adam, full batch
        logit = np.bincount(row, v[at], len(rows)) + b
        e = weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y)
        g = np.bincount(at, e[row], len(used)) + lean * v / len(rows) ** 0.5
        if len(swap):
            moved = np.bincount(s_row, s_sign * v[s_at], len(changes))
            g += 2 * fairness / len(changes) * np.bincount(s_at, s_sign * moved[s_row], len(used))
        full = np.r_[g, e.sum()]
        m1 = 0.9 * m1 + 0.1 * full
        m2 = 0.999 * m2 + 0.001 * full**2
        step = 0.05 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
        v, b = v - step[:-1], b - step[-1]
    w[used], w[dims] = v, b
    return w


def _feature_batches(features: dict[str, int]):
    """Rows (toxic, words, away, put, put_in) with feature numbers in the place of words."""

    def numbers(words: list[str]) -> list[int]:
        return sorted({features[w] for w in words if w in features})

    def run(batches):
        flat = pa.list_(pa.int32())
        for batch in batches:
            toxic, words, away, put, put_in = batch.columns
            arrays = [pa.array([numbers(x) for x in words.to_pylist()], flat)]
            arrays += [pa.array([[numbers(x) for x in row] for row in c.to_pylist()], pa.list_(flat)) for c in (away, put)]
            arrays.append(pa.array([numbers(x) for x in put_in.to_pylist()], flat))
            yield pa.RecordBatch.from_arrays([toxic, *arrays], names=["toxic", "numbers", "away", "put", "put_in"])

    return run


def _score_batches(features: dict[str, int], weights: np.ndarray):
    def run(batches):
        names = features.keys()
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                logits = [weights[-1] + weights[sorted({features[w] for w in text_words(t) & names})].sum() for t in batch.column(2).to_pylist()]
                score = 1 / (1 + np.exp(-np.clip(np.array(logits, float), -50, 50)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(score)], names=["id", "held_out", "score"])

    return run


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    dims: int = 1 << 16,
    features: int = 2048,
    train_per_class: int = 5_000,
    fold: int = 5,
    identity_terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    fairness: float = 5.0,
) -> DataFrame:
    """One row per document: id, held_out, score (0 to 1), predicted (1 if score >= 0.5), swaps (those in the loss).

    Labels count only for documents whose crc32 of the id as text, modulo `fold`, is not 0. Up to train_per_class
    documents of each label (those with the smallest id hashes) train; the words whose counts differ most between the
    labels (log-likelihood ratio, `features` at most) are hashed to `dims` buckets, presence in the whole text counts.
    Swapping identity terms in the labelled sentences must not change the score: the squared change of everything that
    the swap takes and gives (beginnings too) is part of the loss, weighed by `fairness`. Sentences of documents that
    mention none get one put in, see swaps(). Every document is scored from its whole text and the fitted weights alone.

    A null or empty text has no words and the score of the intercept. A null id is held out of training, as is an
    unlabelled document; of two labels of one document the higher counts. Repeated rows get equal results. Other
    columns of the inputs are not read. Without labels of both kinds every score is the share of toxic labels.
    """
    key = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    held = (key % fold == 0).alias("held_out")
    id_type = docs.schema[id_col].dataType.simpleString()
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.max(label_col) > 0).cast("int").alias("toxic"))
        .where(F.crc32(F.col("id").cast("string").cast("binary")) % fold != 0)
    )
    shares = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = shares.get(1, 0) / max(1, sum(shares.values()))
    some = [hash_sample(known.where(F.col("toxic") == c), ["id"], train_per_class, shares.get(c, 0)) for c in (0, 1)]
    chosen = some[0].unionByName(some[1])  # at most 2 * train_per_class ids
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    words = texts.select("id", "toxic", "text").mapInArrow(
        _word_batches(identity_terms),
        f"id {id_type}, toxic int, words array<string>, away array<array<string>>, put array<array<string>>, put_in array<string>",
    )
    words = save(words, "words")
    n1, n0 = (words.where(F.col("toxic") == c).count() for c in (1, 0))
    table = (
        words.select("toxic", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
        .where("a + b >= 3")
    )
    all_n = max(1, n0 + n1)
    expected = lambda seen, row, of: F.when(seen > 0, seen * F.ln(seen * all_n / (row * of))).otherwise(0.0)
    with_word, without = F.col("a") + F.col("b"), F.lit(float(all_n)) - F.col("a") - F.col("b")
    ratio = 2 * (
        expected(F.col("a"), with_word, max(1, n1))
        + expected(F.col("b"), with_word, max(1, n0))
        + expected(n1 - F.col("a"), without, max(1, n1))
        + expected(n0 - F.col("b"), without, max(1, n0))
    )
    picked = table.withColumn("ratio", ratio).where("ratio > 15").orderBy(F.col("ratio").desc(), "word").limit(features).collect()
    found = {r.word: bucket(r.word, dims) for r in picked}
    found.update((w, bucket(w, dims)) for group in identity_terms for term in group for w in text_words(term))
    rows, changes = [], []
    chosen_features = words.select("toxic", "words", "away", "put", "put_in").mapInArrow(
        _feature_batches(found), "toxic int, numbers array<int>, away array<array<int>>, put array<array<int>>, put_in array<int>"
    )
    for r in chosen_features.toArrow().to_pylist():  # at most 2 * train_per_class rows of feature numbers
        rows.append((r["numbers"], r["toxic"]))
        if r["put_in"]:
            rows.append((sorted({*r["numbers"], *r["put_in"]}), r["toxic"]))
        changes += zip(r["away"], r["put"], strict=True)
    weights = fit(rows, changes, dims, share, fairness=fairness)
    scored = docs.select(F.col(id_col).alias("id"), held, F.col(text_col).alias("text")).mapInArrow(
        _score_batches(found, weights), f"id {id_type}, held_out boolean, score double"
    )
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.lit(len(changes)).alias("swaps"))
