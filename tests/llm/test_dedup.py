"""SimHash, exact, substring and embedding dedup against brute force, and on awkward rows."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import common, embedding, exact_dedup, simhash, substring

DOCS = "doc_id long, text string, h string, id long, fp string"
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (text or "")).split(" ") if w]


def rows(seed=3, n=120):
    """Copies, near copies, empty and long texts, shared passages, nulls and a repeated row."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=45)
    out = []
    for i in range(n):
        text = rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 19, 20, 21, 60, 200]))
        kind = rng.random()
        if kind < 0.25 and out:
            text = words(rng.choice(out)[1])
        elif kind < 0.45 and out:
            text = words(rng.choice(out)[1])
            if text:
                text[rng.randrange(len(text))] = "changed"
        elif kind < 0.7:
            cut = rng.randrange(10)
            text = text[:15] + passage[cut:] + text[15:]
        out.append((i * 3 % 1000, "\n ".join(text) if i % 5 else "\t".join(text)))
    out += [(5000, None), (5001, ""), (5002, " \n\t"), (None, "null id text"), (5003, "null id text"), (5004, "x " * 30_000), (5005, "y" * 200_000)]
    out += [out[10], out[11]]
    return [(d, t, "h", 1, "fp") for d, t in out]


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return 0
    size = min(3, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + size]).encode(), 42) for i in range(len(w) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_matches_the_plain_definition():
    for text in ("", "one", "One two", "a b c d e f", "é Ü ß " * 5, "x " * 1000):
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_hashes_as_spark_does(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % (1 << 64)
    assert got == xxhash.xxh64_intdigest(b"a b c", 42)


def test_covering_masks_hide_every_change_of_three_bits():
    masks = simhash.covering_masks(3)
    assert len(masks) == 15
    rng = random.Random(1)
    for _ in range(3000):
        change = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        assert any(change & (m % (1 << 64)) == 0 for m in masks)


def test_simhash_links_like_brute_force(spark):
    data = rows()
    got = simhash.simhash_dedup(spark.createDataFrame(data, DOCS)).collect()
    prints = [(d, plain_fingerprint(t)) for d, t, *_ in data]
    distinct = sorted({f for _, f in prints})
    links = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 3]
    comp = components(distinct, links)
    low = defaultdict(list)
    for d, f in prints:
        low[comp[f]].append(d)
    want = sorted((str(d), f"{f:016x}", min((x for x in low[comp[f]] if x is not None), default=None)) for d, f in prints)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    kept = [r.component_id for r in got if r.kept]
    assert set(kept) == {r.component_id for r in got}


def word_shingles(text, size=5):
    found = [w.translate(LOWER) for w in words(text)]
    size = min(size, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()


def test_near_dedup_links_like_brute_force(spark):
    """Copies around a similarity of 0.8, chains, texts of one repeated passage, and a group larger than its blocks."""
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    texts = [None, "", " \n", "one two", "One TWO"]
    for _ in range(60):
        base = rng.choices(vocabulary, k=rng.choice([8, 40, 100, 300]))
        texts.append(" ".join(base))
        for _ in range(3):  # a chain of changes
            for _ in range(max(1, len(base) // 50)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
            texts.append(" ".join(base))
    passage = " ".join(rng.choices(vocabulary, k=10))
    texts += [" ".join([passage] * 30 + rng.choices(vocabulary, k=60)) for _ in range(5)]
    centre = rng.choices(vocabulary, k=150)
    for _ in range(40):
        texts.append(" ".join(rng.choice(vocabulary) if rng.random() < 0.02 else w for w in centre))
    data = [(None if i == 7 else i, t, "h", i, "f") for i, t in enumerate(texts)] + [(9, texts[9], "h", 0, "f")]
    sets = [word_shingles(t) for t in texts]
    near = lambda a, b: a == b or (len(a & b) > 0 and len(a & b) / len(a | b) >= 0.8)
    n = range(len(texts))
    links = [(a, b) for a in n for b in n if a < b and near(sets[a], sets[b])]
    comp = components(list(n), links)
    low = defaultdict(list)
    for i in n:
        low[comp[i]].append(data[i][0])
    want = sorted((str(d), min((x for x in low[comp[i]] if x is not None), default=None)) for i, (d, *_) in enumerate(data[:-1]))
    for block in (7, 2048):
        got = simhash.near_dedup(spark.createDataFrame(data[:-1], DOCS), block=block).collect()
        assert sorted((str(r.doc_id), r.component_id) for r in got) == want
    # one changed word in the middle of a text of 100 is a near copy; op1's radius of 3 bits finds few of them
    pairs = []
    for i in range(40):
        base = rng.choices(vocabulary, k=100)
        pairs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:50], "changed", *base[51:]]))]
    frame = spark.createDataFrame(pairs, "doc_id long, text string")
    assert sum(r.kept for r in simhash.near_dedup(frame).collect()) == 40
    assert simhash.near_dedup(frame.where("false")).count() == 0


def test_near_candidates_are_simhash_neighbours(spark):
    """Near-dedup takes its candidates from SimHash tables: those that differ in 72 of 256 bits or fewer, in buckets cut into blocks too."""
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(150):
        base = rng.integers(0, 1 << 63, int(rng.choice([5, 9, 90])), np.uint64)
        copy = base.copy()
        copy[: len(base) // 9] = rng.integers(0, 1 << 63, len(base) // 9, np.uint64)
        sets += [base, copy if len(base) > 5 else base[:4]]
    prints = [simhash.wide_fingerprint(s) for s in sets]
    bits = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(a, b, strict=True))
    assert all(bits(a, b) <= 72 for a, b in zip(prints[::2], prints[1::2], strict=True))  # similarity 0.8 each
    n = range(len(prints))
    want = components(list(n), [(i, j) for i in n for j in n if i < j and bits(prints[i], prints[j]) <= 72])
    groups = lambda root: sorted(sorted(i for i in n if root[i] == r) for r in set(root.values()))
    frame = spark.createDataFrame(np.array(prints, np.uint64).view(np.int64).tolist(), ", ".join(f"{w} long" for w in simhash._WIDE))
    signed = np.array(prints, np.uint64).view(np.int64)[:, 0].tolist()
    for block in (3, 1 << 16):
        stars = {r.node: r.component for r in common.star_components(simhash.wide_links(frame, block=block)).collect()}
        assert groups({i: stars.get(signed[i], signed[i]) for i in n}) == groups(want)


def test_simhash_search_of_a_large_cell_and_of_a_hot_group():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 63, (4, 5000), np.uint64)
    near = lambda count, share: np.packbits((rng.random((4, count, 64)) < share).astype(np.uint8), axis=2, bitorder="little").view(np.uint64)[:, :, 0]
    prints[:, 1:1000:2] = prints[:, :1000:2] ^ near(500, 0.1515)
    prints[:, 3000:] = prints[:, 3000:3001] ^ near(2000, 0.03)
    low = simhash._near_prints(prints, 72)
    assert (low[1:1000:2] == low[:1000:2]).sum() >= 490  # one in 200 is missed, for other tables to find
    assert (low[1000:3000] == np.arange(1000, 3000)).all() and (low[3000:] == 3000).all()
    assert (simhash._near_prints(prints, 72, small=1 << 20)[1:1000:2] == np.arange(0, 1000, 2)).all()


def test_simhash_search_of_a_large_cell_leaves_no_pair_out():
    """Pairs at the very limit, all their bits in few words or spread, in cells larger than what is compared at once."""
    rng = np.random.default_rng(8)
    prints = rng.integers(0, 1 << 63, (4, 3000), np.uint64)
    for i in range(0, 1200, 2):
        flip = np.zeros(256, np.uint8)
        flip[np.arange(72) if i % 4 else rng.choice(256, 72 + i % 8 // 4, replace=False)] = 1  # every other spread one has 73 bits
        prints[:, i + 1] = prints[:, i] ^ np.packbits(flip, bitorder="little").view(np.uint64)
    low = simhash._near_prints(prints, 72)
    bits = np.zeros((3000, 3000), np.int64)
    for word in prints:
        bits += np.bitwise_count(word[:, None] ^ word)
    links = [(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(bits <= 72, 1)), strict=True)]
    assert 300 <= len(links) < 600
    assert low.tolist() == list(components(list(range(3000)), [(j, i) for i, j in links]).values())


def test_simhash_blocks_of_a_full_bucket_lose_nothing(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(63)
    fps = sorted({centre ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 6))) for _ in range(300)})
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    for block in (7, 2048):
        stars = {r.node: r.component for r in common.star_components(simhash.near_links(frame, block=block)).collect()}
        want = components(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3])
        groups = defaultdict(list)
        for n in fps:
            groups[want[n]].append(n)
        assert {n: stars.get(n, n) for n in fps} == {n: min(groups[want[n]]) for n in fps}


def test_exact_dedup_is_right_with_tiny_buckets(spark):
    data = rows()
    docs = spark.createDataFrame(data, DOCS)
    # the last two: a hash of four bits, and one for all; only the bytes tell texts apart
    weak = F.xxhash64("text").bitwiseAND(F.lit(15))
    for kw in ({}, {"bucket_rows": 3, "broadcast_keys": 0}, {"hash_of": weak, "bucket_rows": 3}, {"hash_of": F.lit(7)}):
        got = exact_dedup.exact_dedup(docs, **kw).collect()
        groups = defaultdict(list)
        for d, t, *_ in data:
            groups[t or ""].append(d)
        want = []
        for d, t, *_ in data:
            ids = [x for x in groups[t or ""] if x is not None]
            keep = max(ids, default=None)
            want.append((str(d), keep, len(groups[t or ""]), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
        assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == sorted(want)


def test_directory_splits_only_overfull_buckets(spark):
    keys = spark.range(1000).select(F.xxhash64("id").alias("h"))
    depth, slots = exact_dedup.directory(keys, 40)
    per_bucket = keys.withColumn("slot", exact_dedup._slot(depth)).join(slots, "slot").groupBy("local_depth", "bucket").count().collect()
    assert sum(r["count"] for r in per_bucket) == 1000 and max(r["count"] for r in per_bucket) <= 40
    assert slots.count() <= 2**depth
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = docs.withColumn("h", F.xxhash64("text"))
    keys = common.save(texts.groupBy("h").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n")), "keys")
    depth, slots = exact_dedup.directory(keys, 512)
    index = exact_dedup.write_index(keys, texts, depth, slots)
    sizes = [r["count"] for r in index.groupBy("bucket").count().collect()]
    assert depth > 0 and len(sizes) > 1 and max(sizes) <= 512
    shares = [{r.bucket for r in index.where(F.input_file_name() == f).collect()} for f in index.inputFiles()]
    assert sum(map(len, shares)) <= len(sizes) + len(shares)  # an owner has a range of buckets


def test_entries_are_found_by_the_directory_alone(spark):
    """A slot that names another bucket, or that is missing, is an error for the entries behind it."""
    texts = spark.createDataFrame([(i, f"text {i % 150}") for i in range(200)], "id long, text string")
    texts = common.save(texts.withColumn("h", F.xxhash64("text")), "texts")
    keys = texts.groupBy("h").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    depth, slots = exact_dedup.directory(keys, 20)
    slots = common.save(slots, "slots")
    index = exact_dedup.write_index(keys, texts, depth, slots)
    entries = texts.select("id", "h")
    found = exact_dedup.look_up(entries, texts, depth, slots, index).collect()
    assert {(r.id, r.keep_id, r.n) for r in found} == {(i, i + 150 if i < 50 else i, 2 if i % 150 < 50 else 1) for i in range(200)}
    one = slots.orderBy("slot").first()
    other = slots.orderBy(F.desc("slot")).first().bucket
    assert one.bucket != other
    wrong = slots.withColumn("bucket", F.when(F.col("slot") == one.slot, other).otherwise(F.col("bucket")))
    for bad in (wrong, slots.where(F.col("slot") != one.slot)):
        with pytest.raises(Exception, match="not in the bucket"):
            exact_dedup.look_up(entries, texts, depth, bad, index).collect()


def plain_substrings(data, window=20):
    first, docs = {}, sorted(((-(1 << 63) if d is None else d, words(t)) for d, t, *_ in data), key=lambda x: x[0])
    for d, w in docs:
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, (d, s)), (d, s))
    out = []
    for d, w in docs:
        dead = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (d, s):
                dead[s : s + window] = [True] * window
        kept = " ".join(x for x, gone in zip(w, dead, strict=True) if not gone)
        out.append((str(None if d == -(1 << 63) else d), len(w), sum(dead), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_substring_dedup_matches_brute_force(spark):
    for seed in (3, 8):
        data = rows(seed)
        for kw in ({}, {"k": 5, "broadcast_ids": 0}):
            got = substring.substring_dedup(spark.createDataFrame(data, DOCS), **kw).collect()
            assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == plain_substrings(data)


def test_paths_of_many_null_ids_stay_linear(spark):
    """Documents are told apart by id and words: equal ids do not multiply rows."""
    n = 400
    edges = [(w, w, substring.NO_ID, d, s) for d in range(n) for s, w in enumerate(range(d * 5, d * 5 + 5))]
    edges += [(w, w, 1, n, s) for s, w in enumerate(range(n * 5))]
    frame = spark.createDataFrame(edges, "w1 long, w2 long, id long, hs long, start long")
    got = substring.repeated_paths(frame).collect()
    assert len(got) == 5 * n and {(r.src_id, r.src_hs, r.path) for r in got} == {(substring.NO_ID, d, 0) for d in range(n)}
    assert substring.repeated_spans(frame, 20).count() == n


def test_spans_with_other_words_are_not_removed(spark):
    texts = {(1, b"a b c d e f"), (2, b"x a b c d q")}
    keyed = [(i, substring._sequence_key(t.split())[1], t) for i, t in texts]
    key = {i: k for i, k, _ in keyed}
    frame = spark.createDataFrame(keyed, "id long, hs long, text binary")
    spans = spark.createDataFrame([(2, key[2], 1, 5, 1, key[1], 0), (2, key[2], 2, 6, 1, key[1], 2)], "id long, hs long, lo long, hi long, src_id long, src_hs long, src_lo long")
    checked = substring.with_source_words(spans, frame).groupBy("id", "hs").agg(F.collect_list(F.struct("lo", "hi", "words")).alias("spans"))
    cut = frame.join(checked, ["id", "hs"]).select("id", "hs", "text", "spans").mapInArrow(substring._cut_batches, "id long, hs long, n_removed long, kept binary")
    assert [(r.n_removed, bytes(r.kept)) for r in cut.collect()] == [(4, hashlib.sha256(b"x q").digest())]


def test_minimizer_runs_cover_all_windows_and_agree():
    rng = random.Random(2)
    text = [f"w{rng.randrange(30)}".encode() for _ in range(500)]
    h = substring._hash_words(text)
    kmer, first, last = substring.minimizers(h, 20, 8)
    assert first[0] == 0 and last[-1] == len(text) - 20 and (first[1:] == last[:-1] + 1).all()
    again = substring.minimizers(h[100:200], 20, 8)
    assert set(again[0][1:-1]) <= set(kmer)


def vectors(seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(150):
        if i % 3 and out:
            base = rng.choice([v for _, v, _ in out if v])
            v = [x + rng.gauss(0, rng.choice([0, 0.1, 0.5])) for x in base]
        else:
            v = [rng.gauss(0, 1) for _ in range(16)]
        out.append((i, v, i % 2 if i % 11 else None))
    out += [(900, None, 1), (901, [0.0] * 16, 1), (902, [math.nan] + [1.0] * 15, 1), (903, [None] + [1.0] * 15, 1), (904, [math.inf] + [1.0] * 15, 0), (905, [], 0), (906, [1e300] * 16, 0), (907, [1e-300] * 16, 0), (908, [1.0] * 8, 0)]
    return out + [out[3], out[5]]


def cosine(a, b):
    ma, mb = max(map(abs, a)), max(map(abs, b))
    a, b = [x / ma for x in a], [x / mb for x in b]
    return math.fsum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(math.fsum(x * x for x in a) * math.fsum(y * y for y in b))


def test_embeddings_link_like_brute_force(spark):
    data = vectors()
    frame = spark.createDataFrame([(*r, 7) for r in data], "vec_id long, embedding array<double>, label int, n int")
    good = [bool(v) and g is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, g in data]
    links = [
        (i, j)
        for i in range(len(data))
        for j in range(i)
        if good[i] and good[j] and data[i][2] == data[j][2] and len(data[i][1]) == len(data[j][1]) and cosine(data[i][1], data[j][1]) >= 0.93
    ]
    comp = components(range(len(data)), links)
    low, number = defaultdict(list), defaultdict(int)
    for i, (d, *_) in enumerate(data):
        low[comp[i]].append(d)
    for i, j in links:
        number[i] += 1
        number[j] += 1
    want = sorted((d, number[i], min(low[comp[i]]), d == min(low[comp[i]])) for i, (d, *_) in enumerate(data))
    for kw in ({}, {"block": 20, "tile": 8}):
        got = embedding.embedding_dedup(frame, **kw).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want


def test_quantised_bound_holds():
    import numpy as np

    rng = np.random.default_rng(1)
    unit = embedding._unit(rng.normal(size=(200, 64)))
    q, s, e = embedding.quantise(unit)
    approx = (q.astype(float) * s[:, None]) @ (q.astype(float) * s[:, None]).T
    bound = e[:, None] * (1 + e)[None, :] + e[None, :] * (1 + e)[:, None] + e[:, None] * e[None, :]
    assert (np.abs(approx - unit @ unit.T) <= bound + 1e-12).all()


def test_long_chain_is_one_component(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (7777, 7777)], "u long, v long")
    got = {r.node: r.component for r in common.star_components(links).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert simhash.simhash_dedup(docs).count() == 0
    assert exact_dedup.exact_dedup(docs).count() == 0
    assert substring.substring_dedup(docs).count() == 0
    assert embedding.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_minimizers_of_many_texts_are_those_of_each(monkeypatch):
    import numpy as np

    rng = random.Random(9)
    texts = [[f"w{rng.randrange(40)}".encode() for _ in range(n)] for n in (0, 5, 19, 20, 21, 300, 1, 77, 500)]
    lengths = np.array([len(t) for t in texts])
    for stretch in (1 << 20, 64):
        monkeypatch.setattr(substring, "STRETCH", stretch)
        h, begin, kmer, first, last, text = substring._hashed(texts, 20, 8)
        assert begin.tolist() == (np.cumsum(lengths) - lengths).tolist()
        starts = {}
        for i, t in enumerate(texts):
            own = text == i
            # every window once, whatever the stretches; its minimizer is the same
            covered = [s for a, b in zip(first[own], last[own], strict=True) for s in range(a, b + 1)]
            assert covered == list(range(max(0, len(t) - 19)))
            starts[i] = {s: k for k, a, b in zip(kmer[own], first[own], last[own], strict=True) for s in range(a, b + 1)}
        want = {i: {s: k for k, a, b in zip(*substring.minimizers(substring._hash_words(t), 20, 8), strict=True) for s in range(a, b + 1)} for i, t in enumerate(texts)}
        assert starts == want
