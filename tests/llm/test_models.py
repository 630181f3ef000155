"""The language model, the quality classifier and the toxicity classifier."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import hmm_lm, quality, toxicity

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def test_forward_is_the_exact_likelihood():
    rng = np.random.default_rng(0)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    m = hmm_lm.Model(norm(rng.random(3)), norm(rng.random((3, 3))), norm(rng.random((3, 5))).T.copy())
    seqs = [rng.integers(0, 5, n).astype("<u2") for n in (1, 4, 6, 3)]
    logs = hmm_lm._Group(seqs).forward(m)[2]
    for s, log in zip(seqs, logs, strict=True):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(s)):
            p = m.start[path[0]]
            for a, b in itertools.pairwise(path):
                p *= m.move[a, b]
            total += p * math.prod(m.emit[c, z] for c, z in zip(s, path, strict=True))
        assert math.isclose(log, math.log(total), rel_tol=1e-9)
        assert math.isclose(hmm_lm.long_forward(s, m), math.log(total), rel_tol=1e-9)


def test_expected_counts_match_enumeration_and_raise_the_likelihood():
    rng = np.random.default_rng(1)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    m = hmm_lm.Model(norm(rng.random(2)), norm(rng.random((2, 2))), norm(rng.random((2, 4))).T.copy())
    seqs = [rng.integers(0, 4, n).astype("<u2") for n in (5, 2, 1)]
    start, moves, seen, like = hmm_lm._Group(seqs).expect(m)
    want_moves, want_seen, want_start = np.zeros((2, 2)), np.zeros((4, 2)), np.zeros(2)
    for s in seqs:
        paths = {}
        for path in itertools.product(range(2), repeat=len(s)):
            p = m.start[path[0]] * math.prod(m.move[a, b] for a, b in itertools.pairwise(path))
            paths[path] = p * math.prod(m.emit[c, z] for c, z in zip(s, path, strict=True))
        total = sum(paths.values())
        for path, p in paths.items():
            want_start[path[0]] += p / total
            for a, b in itertools.pairwise(path):
                want_moves[a, b] += p / total
            for c, z in zip(s, path, strict=True):
                want_seen[c, z] += p / total
    assert np.allclose(start, want_start) and np.allclose(moves, want_moves) and np.allclose(seen, want_seen)
    better = hmm_lm.Model(start / start.sum(), norm(moves), (seen / seen.sum(axis=0)))
    assert hmm_lm._Group(seqs).expect(better)[3] >= like - 1e-9


def test_long_texts_train_and_score_like_short_ones(monkeypatch):
    """Forward variables kept at borders give the counts of the unsplit text."""
    rng = np.random.default_rng(3)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    m = hmm_lm.Model(norm(rng.random(4)), norm(rng.random((4, 4))), norm(rng.random((4, 9))).T.copy())
    for n in (1, 6, 7, 8, 14, 500):
        seq = rng.integers(0, 9, n).astype("<u2")
        want = hmm_lm._Group([seq]).expect(m)
        monkeypatch.setattr(hmm_lm, "_LONG", 7)
        got = hmm_lm.long_expect(seq, m)
        assert all(np.allclose(a, b) for a, b in zip(got, want, strict=True))
        assert math.isclose(hmm_lm.long_forward(seq, m), want[3], rel_tol=1e-9)


def test_scores_of_a_tiny_corpus_match_a_plain_model(spark):
    """End to end: stepwise and full Baum-Welch rounds and the likelihood, by enumeration of all state paths."""
    rng = random.Random(8)
    data = [(i, " ".join(rng.choices(["aa", "bb", "cc", "dd"], k=rng.randint(0, 3)))) for i in range(30)]
    got = {r.doc_id: r.score for r in hmm_lm.hmm_scores(spark.createDataFrame(data, "doc_id long, text string"), states=2, classes=16, own_classes=8, rounds=2, start_parts=1).collect()}
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    count = Counter(w for d, t in data if not held(d) for w in t.split())
    ends = sum(not held(d) for d, _ in data)
    number = {w: 1 + i for i, (w, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0])))}  # all own classes
    size = np.zeros(16)
    size[0] = ends
    for w, c in count.items():
        size[number[w]] = c
    share = (size + 1) / (size + 1).sum()
    seqs = {d: [number[w] for w in t.split()] + [0] for d, t in data}
    m = hmm_lm._first_model(share, 2)

    def paths(seq):
        for path in itertools.product(range(2), repeat=len(seq)):
            yield path, m.start[path[0]] * math.prod(m.move[a, b] for a, b in itertools.pairwise(path)) * math.prod(m.emit[c, z] for c, z in zip(seq, path, strict=True))

    for _ in range(3):
        start, moves, seen = np.zeros(2), np.zeros((2, 2)), np.zeros((16, 2))
        for d, seq in seqs.items():
            if held(d):
                continue
            total = sum(p for _, p in paths(seq))
            for path, p in paths(seq):
                start[path[0]] += p / total
                for a, b in itertools.pairwise(path):
                    moves[a, b] += p / total
                for c, z in zip(seq, path, strict=True):
                    seen[c, z] += p / total
        m = hmm_lm._maximised(start, moves, seen, share)
    for d, seq in seqs.items():
        assert math.isclose(got[d], math.log10(sum(p for _, p in paths(seq))), rel_tol=1e-6)


def plain_base(data):
    rows = [(d, (t or "").encode().translate(LOWER).split() + [None]) for d, t in data]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    c = Counter()
    for d, w in rows:
        if not held(d):
            c.update(w)
    n, v = sum(c.values()), len(c)
    out = []
    for d, w in rows:
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        out.append((str(d), held(d), len(w), sum(x in c for x in w), n, base))
    return out


def test_base_scores_and_model_probabilities(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(9000, None), (9001, ""), (9002, " \t"), (None, "The the"), (9003, "x " * 30_000), docs[3]]
    frame = spark.createDataFrame([(*d, "c", 1) for d in docs], "doc_id long, text string, classes string, row int")
    # a tiny cache: nearly all words meet their counts in the join
    for kw in ({}, {"cached_words": 5, "own_classes": 3, "classes": 64, "states": 3}):
        got = hmm_lm.hmm_scores(frame, rounds=2, start_parts=2, **kw).collect()
        have = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got)
        assert have == sorted((*x[:5], round(x[5], 5)) for x in plain_base(docs))
        assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    held = [r for r in hmm_lm.hmm_scores(frame).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_of_one_word_texts_sum_to_one(spark):
    """Over every known word, one unknown word a class and the end, the model's next-token probabilities sum to one."""
    rng = random.Random(1)
    train = [(i, " ".join(rng.choices(["aa", "bb", "cc", "dd", "ee"], k=6))) for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2]
    frame = spark.createDataFrame(train, "doc_id long, text string")
    scored = {}
    probe = ["aa", "bb", "cc", "dd", "ee", "zz"]
    ids = iter(i for i in range(1000, 9999) if zlib.crc32(str(i).encode()) % 7 == 2)
    held = [(next(ids), p) for p in probe]
    for r in hmm_lm.hmm_scores(frame.union(spark.createDataFrame(held, "doc_id long, text string")), states=2, classes=8, own_classes=2).collect():
        scored[r.doc_id] = 10**r.score
    # a text of one word has the word's and the end's probability; both factors are below one
    assert all(0 < scored[i] < 1 for i, _ in held) and sum(scored[i] for i, _ in held) < 1


def test_language_model_of_an_empty_table(spark):
    assert hmm_lm.hmm_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_weak_labels_find_the_accuracies():
    rng = random.Random(2)
    right = [0.95, 0.9, 0.85, 0.8]
    patterns = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        votes = [(good if rng.random() < p else not good) if rng.random() < 0.7 else None for p in right]
        patterns[sum((0 if v is None else 2 if v else 1) * 3**i for i, v in enumerate(votes))] += 1
    labels, accuracy = quality.weak_labels(patterns, 4)
    assert np.allclose(accuracy, right, atol=0.04)
    assert labels[0] > 0.7  # all abstain: the share of good ones


def slopes(loss, w, step=1e-4):
    """Gradient of a loss by differences."""
    out = []
    for i in range(len(w)):
        up, down = list(w), list(w)
        up[i] += step
        down[i] -= step
        out.append((loss(up) - loss(down)) / (2 * step))
    return out


def cross_entropy(logit, label):
    return math.log1p(math.exp(-abs(logit))) + max(logit, 0) - label * logit


def test_weak_labels_settle_where_bayes_and_the_counts_agree():
    """One round written out: accuracies from the posteriors, posteriors from the accuracies, change nothing."""
    rng = random.Random(8)
    patterns = Counter()
    for _ in range(4000):
        good = rng.random() < 0.7
        votes = [0 if rng.random() < 0.3 else 1 + (good == (rng.random() < right)) for right in (0.9, 0.8, 0.7, 0.85)]
        patterns[sum(v * 3**i for i, v in enumerate(votes))] += 1
    posterior, _ = quality.weak_labels(dict(patterns), 4, rounds=2000)
    share, table = [1.0, 1.0], [[[0, 2.0, 1.0] for _ in range(4)], [[0, 1.0, 2.0] for _ in range(4)]]
    for code, n in patterns.items():
        for c, p in enumerate((1 - posterior[code], posterior[code])):
            share[c] += n * p
            for i in range(4):
                table[c][i][code // 3**i % 3] += n * p
    for code in patterns:
        odds = list(share)
        for c in (0, 1):
            for i in range(4):
                vote = code // 3**i % 3
                odds[c] *= table[c][i][vote] / (table[c][i][1] + table[c][i][2]) if vote else 1
        assert abs(posterior[code] - odds[1] / sum(odds)) < 1e-6


def test_linear_scorer_minimises_its_loss():
    rng = random.Random(4)
    rows = []
    for _ in range(200):
        numbers = rng.sample(range(5), 2)
        rows.append((numbers, [rng.uniform(0.5, 1.5) for _ in numbers], min(0.95, max(0.05, 0.3 + 0.4 * (0 in numbers) + rng.uniform(-0.2, 0.2)))))

    def loss(w):
        total = sum(cross_entropy(w[-1] + sum(w[k] * x for k, x in zip(ks, xs, strict=True)), y) for ks, xs, y in rows)
        return total / len(rows) + 1e-4 / 2 * sum(x * x for x in w)

    got = quality.fit_linear(rows, 5, lean=1e-4)
    assert max(map(abs, slopes(loss, got.tolist()))) < 2e-3
    assert loss(got.tolist()) < loss([0.0] * 6) - 0.01 and got[0] == max(got[:5])


def test_toxicity_scorer_minimises_loss_and_score_changes():
    rng = random.Random(6)
    rows = []
    for _ in range(300):
        label = int(rng.random() < 0.3)
        rows.append(([k for k in range(4) if rng.random() < (0.7 if k == label else 0.3)], label))
    changes = [([1], [2]), ([2], [1]), ([1, 3], [2])]
    positive = 0.2

    def loss(w, fairness):
        share = {1: positive / sum(y for _, y in rows), 0: (1 - positive) / sum(1 - y for _, y in rows)}
        total = sum(share[y] * cross_entropy(w[-1] + sum(w[k] for k in ks), y) for ks, y in rows)
        moved = [sum(w[k] for k in put) - sum(w[k] for k in away) for away, put in changes]
        return total + 2e-3 / (2 * math.sqrt(len(rows))) * sum(x * x for x in w[:-1]) + fairness * sum(m * m for m in moved) / len(moved)

    gaps = {}
    for fairness in (0.0, 5.0):
        got = toxicity.fit(rows, changes, 4, positive, rounds=3000, fairness=fairness).tolist()
        here = lambda w, f=fairness: loss(w, f)
        # a Newton step from the fit: how far the weights are from the minimum (steps of a fixed size end near it)
        bend = [(np.array(slopes(here, (np.array(got) + d).tolist())) - slopes(here, (np.array(got) - d).tolist())) / 2e-2 for d in np.eye(5) * 1e-2]
        assert np.abs(np.linalg.solve(np.array(bend), slopes(here, got))).max() < 0.02
        gaps[fairness] = abs(got[1] - got[2])
    assert gaps[5.0] < 0.1 * gaps[0.0]


def test_quality_reads_texts_and_words_to_their_ends():
    rng = random.Random(4)
    vote = lambda text, name: quality.describe(text.encode(), quality._Words(2048))[0] // 3 ** list(quality.LABELLERS).index(name) % 3
    clean, few = [f"word{i}" for i in range(5000)], [f"j{i}" for i in range(40)]
    assert vote(" ".join(rng.choices(clean, k=300) + rng.choices(few, k=3000)), "variety") == 1
    assert vote(" ".join(rng.choices(few, k=300) + rng.choices(clean, k=3000)), "variety") == 2
    assert quality.variety(np.arange(1000) % 7)[1] == 7 / 300
    # the ending and the letters of words of more than 200 bytes
    assert vote(" ".join(["a" * 250 + "!!"] * 20), "marked") == 1 and vote(" ".join(["-" * 250 + "a"] * 20), "bare") == 2


def plain_votes(text):
    """The labellers' votes by their definitions, over bytes and words one by one."""
    raw = (text or "").encode()
    w = [x for x in raw.translate(bytes(32 if 9 <= c <= 13 else c for c in range(256))).split(b" ") if x]
    n, kinds = len(w), Counter()
    letter = lambda c: 97 <= c <= 122 or c >= 128
    plain = lambda c: letter(c) or 65 <= c <= 90 or 48 <= c <= 57
    for c in raw:
        kinds["space" if 9 <= c <= 13 or c == 32 else "lower" if letter(c) else "upper" if 65 <= c <= 90 else "digit" if 48 <= c <= 57 else "common" if c in b".,;:'\"-?()" else "other"] += 1
    triples = Counter(zip(w, w[1:], w[2:], strict=False))
    starts = [0] if n <= 300 else [*range(0, n - 300, 300), n - 300]
    stats = {
        "repeats": sum(a == b for a, b in itertools.pairwise(w)) / max(1, n - 1),
        "capitals": kinds["upper"] / max(1, kinds["upper"] + kinds["lower"]),
        "symbols": kinds["other"] / max(1, len(raw)),
        "bare": sum(not any(map(plain, x)) for x in w) / max(1, n),
        "trigrams": sum(c for c in triples.values() if c > 1) / max(1, n - 2),
        "variety": -sum(len(set(w[a : a + 300])) / max(1, min(300, n)) for a in starts) / len(starts),
        "marked": sum(len(x) > 1 and not plain(x[-1]) and not plain(x[-2]) for x in w) / max(1, n),
    }
    vote = lambda x, bad, good, enough: 0 if n < enough else 1 if x >= bad else 2 if x < good else 0
    return sum(vote(stats[name], *rule) * 3**i for i, (name, rule) in enumerate(quality.LABELLERS.items()))


def test_quality_query_matches_a_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnsRenamed({"lang": "h", "source": "id", "n_chars": "numbers"})
    rows = docs.collect()
    votes = {r.doc_id: plain_votes(r.text) for r in rows}
    labels, _ = quality.weak_labels(Counter(votes.values()), len(quality.LABELLERS))
    got = {r.doc_id: r for r in quality.quality_scores(docs).collect()}
    assert all(math.isclose(got[d].weak_label, labels[v], rel_tol=1e-9) for d, v in votes.items())
    # the scorer: a logistic regression on the posteriors, one text at a time
    found = {r.doc_id: quality.describe((r.text or "").encode(), quality._Words(2048))[1:] for r in rows}
    weights = quality.fit_linear([(*found[r.doc_id], labels[votes[r.doc_id]]) for r in rows], 2048)
    for d, (numbers, values) in found.items():
        logit = weights[-1] + sum(weights[int(k)] * float(v) for k, v in zip(numbers, values, strict=True))
        assert abs(got[d].score - 1 / (1 + math.exp(-logit))) < 1e-3 and got[d].kept == (got[d].score >= 0.5)


def test_quality_keeps_clean_documents_and_drops_junk(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.quality_scores(docs).join(labels, "doc_id").select("quality", "kept").collect()
    clean, junk = [r.kept for r in got if r.quality], [r.kept for r in got if not r.quality]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.05 * len(junk)


def test_quality_on_awkward_rows(spark):
    data = [(1, None), (2, ""), (3, " \n"), (4, "word " * 40_000), (4, "word " * 40_000), (None, "A fine short text."), (5, "é" * 100_000)]
    frame = spark.createDataFrame([(*r, 0.5, 1) for r in data], "doc_id long, text string, score double, votes int")
    got = quality.quality_scores(frame).collect()
    assert len(got) == len(data) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert quality.quality_scores(frame.where("false")).count() == 0


def test_toxicity_on_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    clean, toxic = [r.predicted for r in got if not r.toxic], [r.predicted for r in got if r.toxic]
    assert sum(clean) <= 0.02 * len(clean) and sum(toxic) >= 0.6 * len(toxic)


def test_toxicity_query_matches_a_plain_version(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    toxic = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    texts = {r.doc_id: r.text for r in docs.collect()}
    train = [d for d in texts if d in toxic and zlib.crc32(str(d).encode()) % 5]
    assert len({toxic[d] for d in train}) == 2
    seen = {c: Counter(w for d in train if toxic[d] == c for w in toxicity.text_words(texts[d])) for c in (0, 1)}
    total = {c: sum(toxic[d] == c for d in train) for c in (0, 1)}
    n, ratios = len(train), {}
    for w in seen[0].keys() | seen[1].keys():
        cells = [(seen[c][w], seen[0][w] + seen[1][w], total[c]) for c in (0, 1)]
        cells += [(total[c] - seen[c][w], n - seen[0][w] - seen[1][w], total[c]) for c in (0, 1)]
        ratio = 2 * sum(x * math.log(x * n / (row * of)) for x, row, of in cells if x)
        if seen[0][w] + seen[1][w] >= 3 and ratio > 15:
            ratios[w] = ratio
    features = {w: toxicity.bucket(w, 1 << 16) for w in sorted(ratios, key=lambda w: (-ratios[w], w))[:2048]}
    features |= {w: toxicity.bucket(w, 1 << 16) for g in toxicity.IDENTITY_TERMS for t in g for w in toxicity.text_words(t)}
    numbers = lambda words: sorted({features[w] for w in words if w in features})
    rows, changes = [], []
    for d in train:
        changed, put_in = toxicity.swaps(texts[d])
        rows.append((numbers(toxicity.text_words(texts[d])), toxic[d]))
        if put_in:
            rows.append((numbers(toxicity.text_words(texts[d]) | put_in), toxic[d]))
        changes += [(numbers(a), numbers(b)) for a, b in changed]
    weights = toxicity.fit(rows, changes, 1 << 16, total[1] / n)
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    for d, text in texts.items():
        score = 1 / (1 + math.exp(-weights[-1] - sum(weights[k] for k in numbers(toxicity.text_words(text)))))
        assert abs(got[d].score - score) < 1e-3 and got[d].predicted == int(got[d].score >= 0.5) and got[d].swaps == len(changes)


def test_swaps_take_and_give_all_that_changes():
    changes, put_in = toxicity.swaps("The muslims met. Nobody else did.")
    (away, put), = changes
    assert {"muslims", "<musl", "<muslim"} <= away and not put_in and not put & away and len(put) > 3
    changes, _ = toxicity.swaps("Nobody came. The road was long.")
    assert len(changes) == 1 and all(changes[0])
    assert toxicity.swaps(None) == ([], set()) and toxicity.swaps(" . ") == ([], set())


def test_toxicity_of_neutral_mentions_where_a_group_marks_the_labels(spark):
    """No word but the group's terms tells the labels apart: the penalty keeps them from deciding."""
    rng = random.Random(5)
    plain = [f"p{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(800):
        toxic = i % 2
        named = rng.random() < (0.7 if toxic else 0.1)
        rows.append((i, " ".join(rng.choices(plain, k=20) + (["muslims", "muslim"] if named else ["christians"])) + "."))
        labels.append((i, toxic))
    rows += [(9000, "The muslims met."), (9001, "The christians met.")]
    docs, frame = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    gap = {}
    for fairness in (0.0, 50.0):
        got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, frame, fairness=fairness).collect()}
        gap[fairness] = abs(got[9000] - got[9001])
    assert gap[0.0] > 0.3 and gap[50.0] < 0.1


def test_toxicity_ignores_held_out_labels_and_identity(spark):
    rng = random.Random(3)
    plain = [f"p{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        text = rng.choices(plain, k=20) + (["moron"] if toxic else [])
        # a biased sample: toxic documents name one group more often
        if rng.random() < (0.8 if toxic else 0.1):
            text.append("muslims")
        rows.append((i, " ".join(text) + ".", i))
        labels.append((i, int(toxic), 1))
    rows += [(9000, None, 0), (9001, "", 0), (None, "The muslims met.", 0), (9002, "The christians met.", 0), (9003, "moron " * 20_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic long")
    frame = spark.createDataFrame([*labels, (9002, None, 1), (None, 1, 1)], "doc_id long, toxic int, text int")
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, frame).collect()}
    assert len(got) == len(rows)
    assert abs(got[None].score - got[9002].score) < 0.05 and got[None].predicted == 0
    assert got[9003].predicted == 1 and got[9000].score == got[9001].score
    flipped = frame.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, flipped).collect()}
    assert again == {k: r.score for k, r in got.items()}


def test_toxicity_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity_scores(docs, labels).collect()} == {0}
    assert toxicity.toxicity_scores(docs.where("false"), labels).count() == 0
