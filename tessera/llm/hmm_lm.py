"""Hidden Markov language model: Baum-Welch over all training documents, exact likelihood by the scaled forward recursion.

A token is emitted in two steps: the state emits a word class, the class emits the word. The most frequent words are
classes of their own, all others share classes by spelling (first two and last three bytes), the end is class 0. The
model therefore has a fixed size (states x classes), while the counts behind P(word | class) are those of the whole
corpus and stay in Spark tables. Every step's probabilities over known words, one unknown word per class and the end
sum to one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER_AZ, save

#: Distinct words that a counting task holds before it passes its counts on.
_HELD_WORDS = 500_000
#: Tokens that go through one recursion together; bounds memory.
_GROUP_TOKENS = 600_000
#: Longer sequences go through the recursions alone, in stretches of this length: bounds memory.
_LONG = 1_000_000


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LOWER_AZ).split()


def _count_batches(batches):
    held: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.update(words_of(text))
            if len(held) > _HELD_WORDS:
                yield out()
                held.clear()
    yield out()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of a binary column `text`."""
    return texts.select("text").mapInArrow(_count_batches, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """Frequent words (a bounded cache of the counts) and the rule that gives any word its class."""

    rank: dict[bytes, int]
    log_count: np.ndarray
    own: int
    classes: int

    def shape_class(self, word: bytes) -> int:
        return 1 + self.own + zlib.crc32(word[:2] + b"|" + word[-3:]) % (self.classes - 1 - self.own)

    def word_class(self, word: bytes) -> int:
        r = self.rank.get(word)
        return 1 + r if r is not None and r < self.own else self.shape_class(word)


def frequent_words(counts: DataFrame, most: int, own: int, classes: int) -> Lexicon:
    """The words from the smallest count on with which they are `most` at most; no more than these reach the driver.

    Counts are binned by the logarithm first (under a thousand bins at any size), which gives the bound.
    """
    level = F.floor(F.ln("c") * 16).cast("int")
    upto, least = 0, None
    for at, n in sorted(((r.level, r.n) for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True):
        upto += n
        if upto > most:
            break
        least = at
    if least is None:
        return Lexicon({}, np.zeros(1), own, classes)
    found = counts.where(level >= least).select("word", "c").toArrow()
    order = found.sort_by([("c", "descending"), ("word", "ascending")])
    return Lexicon(dict(zip(order["word"].to_pylist(), range(order.num_rows), strict=True)), np.log10(order["c"].to_numpy() + 1.0), own, classes)


def _code_batches(shared, end_log: float):
    """Rows (row, id, held_out, part, text) to the documents' class sequences; words outside the cache are listed."""
    names = ["row", "id", "held_out", "part", "n_tokens", "classes", "log_all", "log_shared", "known", "rare", "times"]

    def run(batches):
        lex: Lexicon = shared.value
        get, own = lex.rank.get, lex.own
        first = np.array([1 + r if r < own else 0 for r in range(len(lex.log_count))] or [0], np.uint16)
        for w, r in lex.rank.items():
            if r >= own:
                first[r] = lex.shape_class(w)
        shapes: dict[bytes, int] = {}
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                rows = []
                for text in batch.column(4).to_pylist():
                    words = words_of(text)
                    ranks = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
                    in_cache = ranks >= 0
                    classes = np.zeros(len(words) + 1, np.uint16)
                    classes[:-1][in_cache] = first[ranks[in_cache]]
                    rest = [words[i] for i in np.flatnonzero(~in_cache)]
                    if len(shapes) > _HELD_WORDS:
                        shapes.clear()
                    for w in rest:
                        if w not in shapes:
                            shapes[w] = lex.shape_class(w)
                    classes[:-1][~in_cache] = [shapes[w] for w in rest]
                    logs = lex.log_count[ranks[in_cache]] if len(rest) < len(words) else np.zeros(0)
                    rare = Counter(rest)
                    rows.append(
                        (
                            len(words) + 1,
                            classes.astype("<u2").tobytes(),
                            float(logs.sum()) + end_log,
                            float(logs[ranks[in_cache] >= own].sum()),
                            int(in_cache.sum()),
                            list(rare),
                            list(rare.values()),
                        )
                    )
                cols = list(zip(*rows, strict=True)) or [[]] * 7
                types = [pa.int64(), pa.binary(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    return run


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # classes x states


class _Group:
    """Sequences in time-major order, longest first: step t holds the first n[t] sequences."""

    def __init__(self, seqs: list[np.ndarray]):
        lengths = np.array([len(s) for s in seqs])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        self.n = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left").astype(np.int64)
        self.at = np.r_[0, np.cumsum(self.n)]
        flat = np.concatenate([seqs[i] for i in self.order])
        self.doc = np.repeat(np.arange(len(seqs)), lengths)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = self.at[step] + self.doc
        self.cls = np.empty(len(flat), flat.dtype)
        self.cls[place] = flat
        self.owner = np.empty(len(flat), np.int64)
        self.owner[place] = self.doc

    def forward(self, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled forward variables, scales, and each sequence's natural log likelihood (in the order given)."""
        alpha = m.emit[self.cls]
        scale = np.empty(len(alpha))
        n, at, move = self.n.tolist(), self.at.tolist(), m.move
        a = None
        for t in range(len(n)):
            now = alpha[at[t] : at[t + 1]]
            now *= m.start if a is None else a[: n[t]] @ move
            c = scale[at[t] : at[t + 1]]
            np.sum(now, axis=1, out=c)
            now /= c[:, None]
            a = now
        logs = np.empty(len(self.order))
        logs[self.order] = np.bincount(self.owner, np.log(scale), len(self.order))
        return alpha, scale, logs

    def expect(self, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected starts, moves and emissions (Baum-Welch) and the log likelihood."""
        alpha, scale, logs = self.forward(m)
        n, at = self.n.tolist(), self.at.tolist()
        emit = m.emit[self.cls]
        emit /= scale[:, None]
        moves = np.zeros_like(m.move)
        back = m.move.T.copy()
        beta = np.ones((n[-1], len(m.start)))
        gamma = alpha
        for t in range(len(n) - 1, 0, -1):
            x = emit[at[t] : at[t + 1]]
            x *= beta
            before = alpha[at[t - 1] : at[t]]
            moves += before[: n[t]].T @ x
            gamma[at[t] : at[t + 1]] *= beta
            beta = np.ones((n[t - 1], len(m.start)))
            np.matmul(x, back, out=beta[: n[t]])
        gamma[: n[0]] *= beta
        seen = np.stack([np.bincount(self.cls, gamma[:, k], len(m.emit)) for k in range(gamma.shape[1])], axis=1)
        return gamma[: n[0]].sum(axis=0), moves * m.move, seen, float(logs.sum())


def _steps(a: np.ndarray | None, seq: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward variables and scales of a stretch that follows the forward variable a (none: the sequence begins)."""
    alpha, scale = m.emit[seq], np.empty(len(seq))
    for t, now in enumerate(alpha):
        now *= m.start if a is None else a @ m.move
        scale[t] = now.sum()
        now /= scale[t]
        a = now
    return alpha, scale


def long_forward(seq: np.ndarray, m: Model) -> float:
    """The natural log likelihood of one sequence of any length, by the scaled forward recursion."""
    total, a = 0.0, None
    for lo in range(0, len(seq), _LONG):
        alpha, scale = _steps(a, seq[lo : lo + _LONG], m)
        total, a = total + float(np.log(scale).sum()), alpha[-1].copy()
    return total


def long_expect(seq: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """_Group.expect() of one sequence of any length: forward variables are kept at the borders of stretches only, and
    each stretch's are worked out again on the way back."""
    borders: list[np.ndarray | None] = [None]
    like = 0.0
    for lo in range(0, len(seq), _LONG):
        alpha, scale = _steps(borders[-1], seq[lo : lo + _LONG], m)
        like += float(np.log(scale).sum())
        borders.append(alpha[-1].copy())
    moves, seen = np.zeros_like(m.move), np.zeros_like(m.emit)
    beta = np.ones(len(m.start))
    for k in range(len(borders) - 2, -1, -1):
        part = seq[k * _LONG : (k + 1) * _LONG]
        alpha, scale = _steps(borders[k], part, m)
        emit = m.emit[part] / scale[:, None]
        before = borders[k]
        for t in range(len(part) - 1, -1, -1):
            x = emit[t] * beta
            alpha[t] *= beta
            a = alpha[t - 1] if t else before
            if a is not None:
                moves += np.outer(a, x)
                beta = m.move @ x
        np.add.at(seen, part, alpha)
    return alpha[0].copy(), moves * m.move, seen, like


def _grouped(seqs: list[np.ndarray], room: int = _GROUP_TOKENS):
    """Lists of indices of sequences of similar length, about `room` tokens each."""
    order = sorted(range(len(seqs)), key=lambda i: -len(seqs[i]))
    some, held = [], 0
    for i in order:
        some.append(i)
        held += len(seqs[i])
        if held >= room:
            yield some
            some, held = [], 0
    if some:
        yield some


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, "<u2") for b in column.to_pylist()]


def _expected(seqs: list[np.ndarray], m: Model):
    """Expected counts of all sequences, some at a time."""
    short = [s for s in seqs if len(s) <= _LONG]
    for some in _grouped(short):
        yield _Group([short[i] for i in some]).expect(m)
    for s in seqs:
        if len(s) > _LONG:
            yield long_expect(s, m)


def _expect_batches(shared):
    """One task's expected counts as rows (kind, k, v): emissions by class, moves by state, starts with the likelihood."""

    def run(batches):
        m: Model = shared.value
        states = len(m.start)
        start, moves, seen, like = np.zeros(states), np.zeros((states, states)), np.zeros((len(m.emit), states)), 0.0
        for batch in batches:
            seqs = _sequences(batch.column(0))
            for s, mv, em, ll in _expected(seqs, m):
                start, moves, seen, like = start + s, moves + mv, seen + em, like + ll
        used = np.flatnonzero(seen.any(axis=1))
        values = np.concatenate([seen[used], moves, start[None], np.r_[like, np.zeros(states - 1)][None]])
        kind = np.repeat([0, 1, 2, 3], [len(used), states, 1, 1])
        k = np.r_[used, np.arange(states), 0, 0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(k, pa.int32()), *(pa.array(values[:, i]) for i in range(states))],
            names=["kind", "k", *(f"v{i}" for i in range(states))],
        )

    return run


def _maximised(start: np.ndarray, moves: np.ndarray, seen: np.ndarray, class_share: np.ndarray) -> Model:
    """Model of expected counts; emissions lean on the classes' shares, so that none is zero."""
    lean = 50.0
    emit = (seen + lean * class_share[:, None]) / (seen.sum(axis=0) + lean)
    move = (moves + 0.5) / (moves + 0.5).sum(axis=1, keepdims=True)
    return Model((start + 0.5) / (start + 0.5).sum(), move, emit)


def _first_model(class_share: np.ndarray, states: int) -> Model:
    """Where Baum-Welch starts: the corpus' class shares, varied at random (a fixed seed) from state to state."""
    rng = np.random.default_rng(7)
    seen = class_share[:, None] * rng.gamma(2.0, size=(len(class_share), states)) * 1000
    move = np.full((states, states), 0.02) + 0.9 * np.eye(states)
    return _maximised(np.ones(states), move * 1000, seen, class_share)


def _round(train: DataFrame, m: Model, class_share: np.ndarray) -> Model:
    """One round of Baum-Welch over the rows (classes) of train; the same model where there are none."""
    states = len(m.start)
    schema = "kind int, k int, " + ", ".join(f"v{i} double" for i in range(states))
    shared = train.sparkSession.sparkContext.broadcast(m)
    summed = train.mapInArrow(_expect_batches(shared), schema).groupBy("kind", "k").agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(states)])
    got = np.array([list(r) for r in summed.collect()])
    if not len(got):
        return m
    kind, k, v = got[:, 0].astype(int), got[:, 1].astype(int), got[:, 2:]
    if not v[kind == 2].sum():
        return m
    seen, moves = np.zeros((len(class_share), states)), np.zeros((states, states))
    seen[k[kind == 0]] = v[kind == 0]
    moves[k[kind == 1]] = v[kind == 1]
    return _maximised(v[kind == 2][0], moves, seen, class_share)


def _score_batches(shared, class_logs: np.ndarray):
    def run(batches):
        m: Model = shared.value
        for batch in batches:
            seqs = _sequences(batch.column(batch.schema.get_field_index("classes")))
            like, inner = np.zeros(len(seqs)), np.zeros(len(seqs))
            for some in _grouped(seqs):
                if len(seqs[some[0]]) > _LONG:
                    like[some] = [long_forward(seqs[i], m) for i in some]
                else:
                    like[some] = _Group([seqs[i] for i in some]).forward(m)[2]
            for i, s in enumerate(seqs):
                inner[i] = class_logs[s].sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(like / np.log(10)), pa.array(inner)], names=["row", "path_score", "class_logs"]
            )

    return run


def hmm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = 8,
    classes: int = 16_384,
    own_classes: int = 10_000,
    cached_words: int = 150_000,
    rounds: int = 3,
    start_parts: int = 8,
    fold: tuple[int, int] = (7, 2),
) -> DataFrame:
    """Score whole documents: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    Documents whose crc32 of the id as text, modulo fold[0], is fold[1] are held out; all others train. Counts, the
    vocabulary and Baum-Welch cover every training document: first stepwise, over one of start_parts parts (by hash) after
    the other, then `rounds` rounds over all. The cached_words most frequent words are looked up in tasks (a
    cache of fixed size); all others meet their counts in a join. Expected counts are summed in Spark, and states x
    classes of them reach the driver.

    A null text is empty: one token, the end. A null id counts as the empty text for the fold. Repeated rows count
    and are scored each. Other columns of the input are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    share, left = fold
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % share == left).alias("held_out"),
        F.col(text_col).cast("binary").alias("text"),
    )
    counts = save(word_counts(rows.where("not held_out")), "counts")
    ends = rows.where("not held_out").count()
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = tokens + ends, distinct + (ends > 0)
    lex = frequent_words(counts, cached_words, own_classes, classes)
    shared_lex = spark.sparkContext.broadcast(lex)

    def class_batches(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([shared_lex.value.word_class(w) for w in words], pa.int32()), batch.column(1)], names=["k", "c"])

    per_class = counts.mapInArrow(class_batches, "k int, c long").groupBy("k").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    size, kinds = np.zeros(classes), np.zeros(classes)
    for r in per_class:
        size[r.k], kinds[r.k] = r.c, r.v
    size[0] = ends
    class_share = (size + 1) / (size + 1).sum()
    # what a word of a shared class divides its count by; own classes and the end hold one word only
    class_logs = np.log10(size + kinds + 1)
    class_logs[: 1 + own_classes] = 0.0

    part = F.when(F.col("held_out"), -1).otherwise(F.pmod(F.xxhash64("id", "text"), F.lit(start_parts))).cast("int")
    coded = rows.select(F.monotonically_increasing_id().alias("row"), "id", "held_out", part.alias("part"), "text").mapInArrow(
        _code_batches(shared_lex, float(np.log10(ends + 1))),
        f"row long, id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, part int, n_tokens long, classes binary, "
        "log_all double, log_shared double, known long, rare array<binary>, times array<long>",
    )
    coded = save(coded, "coded", "part")
    m = _first_model(class_share, states)
    for part in range(start_parts if ends else 0):
        m = _round(coded.where(F.col("part") == part).select("classes"), m, class_share)
    for _ in range(rounds if ends else 0):
        m = _round(coded.where("part >= 0").select("classes"), m, class_share)
    shared = spark.sparkContext.broadcast(m)
    paths = coded.select("row", "classes").mapInArrow(_score_batches(shared, class_logs), "row long, path_score double, class_logs double")
    rare = (
        coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x"))
        .select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_log"),
            F.sum(F.when(F.col("c").isNotNull(), F.col("times"))).alias("rare_known"),
        )
    )
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    divisor = float(np.log10(tokens + distinct + 1))
    return (
        coded.drop("classes", "rare", "times", "part")
        .join(paths, "row")
        .join(rare, "row", "left")
        .select(
            F.col("id").alias(id_col),
            "held_out",
            "n_tokens",
            (F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            (F.col("log_all") + rare_log - F.col("n_tokens") * divisor).alias("base_score"),
            (F.col("path_score") + F.col("log_shared") + rare_log - F.col("class_logs")).alias("score"),
        )
    )
