"""Merkle manifests, WARC packages and prefix tries against plain versions."""

import base64
import hashlib
import io
import random
import zipfile
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle, trie, warc

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


# ---- Merkle manifest ----


def plain_tree(leaves, k):
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([H("".join(low[i : i + k])) for i in range(0, len(low), k)])
    return levels


def plain_proof(levels, i, k):
    steps = []
    for low in levels[:-1]:
        run = low[i // k * k : i // k * k + k]
        steps.append((i % k, run[: i % k] + run[i % k + 1 :]))
        i //= k
    return steps


def plain_manifest(rows, k):
    """{(id, leaf): (subroot, root, steps)} of rows (id, lang, leaf)."""
    trees = defaultdict(list)
    for i, lang, leaf in rows:
        trees[lang].append(((i is not None, i), leaf))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {x: plain_tree([leaf for _, leaf in sorted(trees[x])], k) for x in langs}
    upper = plain_tree([built[x][-1][0] for x in langs], k)
    found = defaultdict(list)
    for at, x in enumerate(langs):
        for i, ((_, ident), leaf) in enumerate(sorted(trees[x])):
            found[ident, leaf].append((built[x][-1][0], upper[-1][0], plain_proof(built[x], i, k) + plain_proof(upper, at, k)))
    return found


def merkle_docs():
    rng = random.Random(11)
    langs = ["en"] * 6 + ["de", "é", "", None, "-", "="]
    rows = [(i, rng.choice(langs), rng.choice([None, "", "a b", "ä" * 40]), rng.choice([None, 3]), "own") for i in rng.sample(range(-50, 4000), 150)]
    rows += [(None, "en", "x", 1, "own"), (None, None, None, None, None), rows[0], rows[0], (rows[1][0], "en", "another text of one id", 2, "own"), (2**60 + 1, "en", "y" * 200_000, 1, "own"), (9000, "lone", "z", 1, "own")]
    return rows


@pytest.mark.parametrize(("fan_out", "block"), [(2, 1024), (2, 4), (3, 3)])
def test_manifest_equals_a_plain_tree(spark, monkeypatch, fan_out, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = merkle_docs()
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string, n_chars long, digest string").repartition(7)
    got = merkle.merkle_manifest(frame, ["doc_id", "lang", "text", "n_chars"], fan_out=fan_out).collect()
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    plain = plain_manifest([(r[0], r[1], H("".join(map(enc, r[:4])))) for r in rows], fan_out)
    seen = defaultdict(list)
    for r in got:
        seen[r.id, r.leaf].append((r.subroot, r.root, [(s.place, list(s.siblings)) for s in r.proof]))
    assert len(got) == len(rows) and {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in plain.items()}


def test_proofs_fold_to_the_root_and_show_tampering(spark):
    frame = spark.createDataFrame(merkle_docs(), "doc_id long, lang string, text string, n_chars long, digest string")
    found = merkle.merkle_manifest(frame, ["doc_id", "text"], claimed=F.when(F.col("doc_id") % 5 == 0, merkle.row_digest(F.col("doc_id"), F.lit("forged"))))
    folds = lambda leaf: merkle.folded(leaf, F.col("proof")) == F.col("root")
    rows = found.select("id", "claimed", folds(F.col("leaf")).alias("whole"), folds(F.coalesce("claimed", "leaf")).alias("held"), merkle.proof_digest(F.col("proof")).alias("p"), "proof").collect()
    assert all(r.whole for r in rows) and all(r.held == (r.claimed is None) for r in rows)
    assert all(r.p == H("".join(d for s in r.proof for d in s.siblings)) for r in rows)


def test_manifest_of_few_rows(spark):
    types = "doc_id long, lang string, text string"
    assert merkle.merkle_manifest(spark.createDataFrame([], types), ["doc_id", "text"]).collect() == []
    one = merkle.merkle_manifest(spark.createDataFrame([(1, None, None)], types), ["doc_id", "text"]).collect()[0]
    assert one.leaf == one.subroot == one.root == H("1:1-") and one.proof == []
    with pytest.raises(ValueError):
        merkle.merkle_manifest(spark.createDataFrame([], types), ["text"], fan_out=1)


def test_partial_parents_meet_in_any_order():
    rng = random.Random(5)
    for n in (1, 2, 3, 7, 33):
        leaves = [H(str(i)) for i in range(n)]
        events = [(0, i, d) for i, d in enumerate(leaves)]
        while len(events) > 1 or events[0][0] < len(merkle.widths(n, 2)) - 1:
            rng.shuffle(events)
            cut = rng.randint(0, len(events))
            after = []
            for part in (events[:cut], events[cut:]):  # two tasks
                runs = merkle.Runs(n, 2, 99)
                for e in part:
                    runs.add(*e)
                after += runs.frontier()
            events = after
        assert events[0][2] == plain_tree(leaves, 2)[-1][0]


def test_a_missing_leaf_is_an_error(spark):
    nodes = spark.createDataFrame([("t", 4, 0, 0, "a"), ("t", 4, 0, 1, "b"), ("t", 4, 0, 3, "d")], merkle.NODE_TYPES)
    with pytest.raises(Exception, match="missing"):
        merkle.climb(nodes)


# ---- WARC packages ----


def page_rows():
    long_text = "ü" * 700_000
    return [
        (1, "http://a/ x\r\nInjected: 1", "<p>one</p>", "n"), (2, None, None, "n"), (3, "http://ä", "", "n"), (7, "http://b", "<p>one</p>", "n"), (5, "u", "<p>one</p>", "n"),
        (None, "u", "<p>one</p>", "n"), (None, "u", "none", "n"), (8, "u", long_text, "n"), (9, "u", long_text, "n"), (9, "u", long_text, "n"), (-4, "u", "line\n\r\n\r\nWARC/1.1\r\n\r\n", "n"), (11, "u", "\x00\x1a", "n"),
    ]


def plain_records(rows, least=0):
    best = {}
    for k, _, t, _ in rows:
        p = (t or "").encode()
        best[p] = max([x for x in (best.get(p), k) if x is not None], default=None)
    out = []
    for k, _, t, _ in rows:
        p = (t or "").encode()
        again = k != best[p] and len(p) >= least
        out.append((k, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", best[p] if again else None))
    return sorted(out, key=str)


PAGE_TYPES = "page_id long, url string, html string, payload string"


@pytest.mark.parametrize(("big", "member_bytes", "least"), [(False, 1 << 28, 0), (True, 2000, 0), (False, 1, 6)])
def test_packages_round_trip(spark, big, member_bytes, least):
    rows = page_rows()
    path = warc.new_folder(spark)
    warc.write_packages(spark.createDataFrame(rows, PAGE_TYPES).repartition(3), path, big=big, member_bytes=member_bytes, least=least)
    records = warc.read_packages(spark, path).cache()
    got = warc.resolve(records).collect()
    assert sorted(map(tuple, got), key=str) == plain_records(rows, least)
    texts = {(k, (t or "").encode()) for k, _, t, _ in rows}
    assert {(r.page_id, r.payload) for r in records.where("type = 'response'").collect()} <= texts
    names = [r.path for r in spark.read.format("binaryFile").load(path).where("length > 0").select("path").collect()]
    assert names
    for name in names:  # another reader finds the same members, sound and stored
        with zipfile.ZipFile(name.removeprefix("file:")) as z:
            assert z.testzip() is None and {m.compress_type for m in z.infolist()} == {zipfile.ZIP_STORED}
            assert z.infolist()[-1].filename == "indexes/index.jsonl"


def plain_digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_packages_of_other_writers(spark, tmp_path):
    """With bytes in front, comments, several members, and no index; and what cannot be read."""
    one = lambda i: warc.record("response", f"urn:x:{i}", b"body %d" % i, plain_digest(f"body {i}"), 6, "u", None, {"X-Page-Id": str(i)})
    whole = io.BytesIO()
    with zipfile.ZipFile(whole, "w") as z:
        z.comment = b"about \x50\x4b\x05\x06 this"
        z.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
        z.writestr("archive/a.warc", one(1) + one(2))
        z.writestr("archive/b.warc", one(3))
    (tmp_path / "a.wacz").write_bytes(b"#!shell\n" + whole.getvalue())
    got = warc.read_packages(spark, str(tmp_path)).collect()
    assert sorted((r.page_id, r.payload) for r in got) == [(i, b"body %d" % i) for i in (1, 2, 3)]
    some = warc.read_packages(spark, str(tmp_path), payloads=False, wanted=F.col("length") < 0)
    assert some.collect() == [] and "payload" not in some.columns
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a.warc", one(1))
    (tmp_path / "b.wacz").write_bytes(packed.getvalue())
    with pytest.raises(ValueError, match="compressed"):
        warc.read_packages(spark, str(tmp_path))
    (tmp_path / "b.wacz").write_bytes(b"no zip file at all")
    with pytest.raises(Exception, match="not a ZIP file"):
        warc.read_packages(spark, str(tmp_path)).collect()


def test_broken_records_are_errors(spark, tmp_path):
    good = warc.record("response", "urn:x:1", b"body 1", plain_digest("body 1"), 6, None, None, {})
    assert warc.parse_record(good)[1] == b"body 1" and warc.parse_record(good)[0][4] is None
    with pytest.raises(ValueError, match="not what its header tells"):
        warc.parse_record(good.replace(b"body 1", b"body 2"))
    for text, what in ((good[:-9], "cut off"), (b"junk" + good, "no record"), (b"WARC/1.1\r\n", "no end")):
        whole = io.BytesIO()
        with zipfile.ZipFile(whole, "w") as z:
            z.writestr("archive/a.warc", text)
        (tmp_path / "a.wacz").write_bytes(whole.getvalue())
        with pytest.raises(Exception, match=what):
            warc.read_packages(spark, str(tmp_path)).collect()


def test_no_pages(spark):
    path = warc.new_folder(spark)
    warc.write_packages(spark.createDataFrame([], PAGE_TYPES), path)
    assert warc.read_packages(spark, path).collect() == []


def test_large_sizes_stand_in_zip64_fields():
    """A directory of a file that is never made: 6 GB of members in front of it."""
    package = warc.Package()
    head = package.begin("archive/data-00000.warc")
    package.at += 6 << 30
    body = package.end() + package.begin("indexes/index.jsonl") + package.add(b"{}\n") + package.end() + package.finish()

    class Sparse:
        def read_at(self, n, at):
            behind = package.at - len(body)
            hole = max(0, min(n, behind - at))  # zeros stand for the members
            return b"\0" * hole + body[at + hole - behind : at + n - behind]

    members = list(warc.directory(Sparse(), package.at))
    assert [(m["member"], m["size"]) for m in members] == [("archive/data-00000.warc", 6 << 30), ("indexes/index.jsonl", 3)]
    assert members[1]["header"] > 6 << 30 and warc.data_start(Sparse(), members[1]["header"]) == members[1]["header"] + 30 + 19 + 20


# ---- prefix trie ----


def plain_trie(rebuilt):
    """{(depth, sequence): ...} of {conv: [turn, ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(rebuilt):
        turns = tuple(rebuilt[c])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def saved(p):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        return own + sum(saved(q) for q in children[p])

    def leaves(p):
        return sum(map(leaves, children[p])) if children[p] else 1

    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves(p), saved(p), H(",".join(map(str, ends[p]))))
        for p, m in list(members.items())
    )


def talk_rows():
    rng = random.Random(13)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "ü"]), 1) for c in rng.sample(range(90), 60) for t in range(rng.randint(1, 6))]
    rows += [(100 + i, t, "user", f"same {t}", 1) for i in range(5) for t in range(30 - i)]  # a chain on which conversations end
    rows += [(205, None, "system", "first", 1), (205, 3, "user", "x", 1), (None, 1, "user", "nobody's", 1), (206, 1, "u", "ser", 1), (207, 1, "us", "er", 1)]
    rows += [(3 * 10**18 + i, 0, "user", "hi" * 1000, 1) for i in (0, 7)]
    return rows


def plain_turns(rows):
    talks = defaultdict(list)
    for c, t, r, x, _ in rows:
        if c is not None:
            talks[c].append(((t is not None, t), r or "", x or ""))
    return {c: [(r, x) for _, r, x in sorted(v, key=lambda v: v[:2])] for c, v in talks.items()}


TALK_TYPES = "conv_id long, turn long, role string, text string, depth int"


@pytest.mark.parametrize("chunk", [1024, 4, 1])
def test_trie_equals_a_plain_one(spark, chunk):
    rows = talk_rows()
    numbered = trie.ordered_turns(spark.createDataFrame(rows, TALK_TYPES).repartition(5))
    taken = F.pmod(F.col("conv"), F.lit(4)).cast("int")
    turns, conversations = trie.forked(numbered, F.col("conv") - F.col("conv") % 5, taken, 3)
    got = trie.prefix_trie(turns, conversations, chunk).drop("digest").collect()
    talks = plain_turns(rows)
    rebuilt = {c: talks.get(c - c % 5, [])[: c % 4] + own[c % 4 :] for c, own in talks.items()}
    assert any(not t for t in rebuilt.values())
    assert sorted(map(tuple, got)) == plain_trie(rebuilt)


def test_trie_of_turns_that_tie_and_of_none(spark):
    rows = [(1, 0, "b", "x", 1), (1, 0, "a", "y", 1), (2, 0, "a", "y", 1), (2, 0, "b", "x", 1), (2, 0, "b", "x", 1)]
    numbered = trie.ordered_turns(spark.createDataFrame(rows, TALK_TYPES).repartition(3)).withColumn("depth", F.col("pos") + 1)
    got = trie.prefix_trie(numbered, numbered.groupBy("conv").agg(F.max("depth").alias("depth"))).drop("digest").collect()
    assert sorted(map(tuple, got)) == plain_trie({1: [("a", "y"), ("b", "x")], 2: [("a", "y"), ("b", "x"), ("b", "x")]})
    none = trie.ordered_turns(spark.createDataFrame([], TALK_TYPES))
    turns, conversations = trie.forked(none, F.col("conv"), F.lit(2), 2)
    assert trie.prefix_trie(turns, conversations).collect() == []


def test_long_conversations_are_exploded_by_runs(spark):
    """Two of 3,000 turns that part at the end, and one of their start: three runs, not four million pairs."""
    long = [(c, t, "user", f"{t}" if t < 2990 else f"{c}{t}", 1) for c in (1, 2) for t in range(3000)] + [(3, t, "user", f"{t}", 1) for t in range(100)]
    numbered = trie.ordered_turns(spark.createDataFrame(long, TALK_TYPES)).withColumn("depth", F.col("pos") + 1)
    got = trie.prefix_trie(numbered, numbered.groupBy("conv").agg(F.max("depth").alias("depth")), 256).collect()
    by = {(r.conv_id, r.depth): r for r in got}
    assert len(got) == 1 + 2990 + 20 and by[1, 0].n_leaves == by[1, 2990].n_leaves == 2 and by[2, 2991].n_leaves == 1
    bytes_of = [len(str(t)) for t in range(2990)]
    assert by[1, 0].saved_bytes == 2 * sum(bytes_of[:100]) + sum(bytes_of[100:])
    assert by[1, 1500].saved_bytes == sum(bytes_of[1499:]) and by[1, 2991].saved_bytes == 0 and by[2, 2991].parent_conv_id == 1
