"""Best-fit packing of tokenised documents by bin completion over the histogram of piece lengths."""

from __future__ import annotations

import bisect
import math
import os
import re
import string
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import save, text_slices

#: Words kept in a Python worker's cache of token ids: the first ones that it meets a second time.
CACHE_WORDS = 150_000
#: Bytes of text coded at a time.
SLICE_BYTES = 1 << 18
#: A word is taken as met before by its hash, so that words which stand in one place are not kept.
_HASHES = 1 << 20
#: Lower-case Latin letters; a word of these, with or without ASCII punctuation behind, is plain: a pre-token each.
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c.islower())
_WORD = re.compile(rf"([{_LETTERS}]*)([{re.escape(string.punctuation)}]*)([^ ]*) ")
_loaded: dict[str, tuple] = {}


def _load(tokenizer_file: str) -> tuple:
    """The tokenizer; one for plain words; the cache; which ids end a word; hashes of words met before.

    Where the normalizer leaves plain words as they are and none can hold an added token, they go past both.
    """
    from tokenizers import Tokenizer

    made = plain = Tokenizer.from_file(tokenizer_file)
    kept = f"{_LETTERS} {string.punctuation}"
    added = [_WORD.fullmatch(f"{t.content} ") for t in made.get_added_tokens_decoder().values()]
    if made.normalizer and made.normalizer.normalize_str(kept) == kept and all(found and found[3] for found in added):
        plain = Tokenizer(made.model)
        plain.pre_tokenizer = made.pre_tokenizer
    ends = np.zeros(made.get_vocab_size(), bool)
    ends[[i for token, i in made.get_vocab().items() if token.endswith("</w>")]] = True
    return made, plain, {}, ends, bytearray(_HASHES)


def word_ids(tokenizer_file: str) -> Callable[[list[bytes]], list[bytes]]:
    """Little-endian uint32 ids of each word.

    The tokenizer never joins text across white space, so words can be coded alone and cached. Plain words that the
    cache lacks are coded together, and cut where a token ends a word; all others are coded one by one.
    """
    if tokenizer_file not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[tokenizer_file] = _load(tokenizer_file)
    tokenizer, plain_tokenizer, cache, ends, met = _loaded[tokenizer_file]

    def together(words: list[str], parts: list[int]) -> list[bytes]:
        if not words:
            return []
        coded = np.array(plain_tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(ends[coded]) + 1
        last = np.cumsum(parts) - 1
        if len(stops) != last[-1] + 1:
            return alone(words)
        raw, cuts = coded.tobytes(), [0, *(4 * stops[last]).tolist()]
        return [raw[i:j] for i, j in zip(cuts, cuts[1:])]

    def alone(words: list[str]) -> list[bytes]:
        return [np.array(c.ids, "<u4").tobytes() for c in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def ids(words: list[bytes]) -> list[bytes]:
        coded = list(map(cache.get, words))
        new = [i for i, found in enumerate(coded) if found is None]
        for lo in range(0, len(new), 1000):
            at = new[lo : lo + 1000]
            text = b"".join([words[i] + b" " for i in at]).decode("utf-8", "replace")
            plain, plain_at, parts, odd, odd_at = [], [], [], [], []
            for i, (letters, marks, rest) in zip(at, _WORD.findall(text), strict=True):
                if rest or not (letters or marks):
                    odd.append(letters + marks + rest)
                    odd_at.append(i)
                else:
                    plain.append(letters + marks)
                    plain_at.append(i)
                    parts.append((letters != "") + (marks != ""))
            for i, found in zip(plain_at + odd_at, together(plain, parts) + alone(odd), strict=True):
                coded[i] = found
        if len(cache) < CACHE_WORDS:
            for i in new:
                at = hash(words[i]) % _HASHES
                if met[at] and len(cache) < CACHE_WORDS:
                    cache[words[i]] = coded[i]
                met[at] = 1
        return coded

    return ids


def text_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of binary texts, the place among them of every word in turn, and where each text begins in those.

    A-Z are lower-cased, as the tokenizer does itself, but for texts where a special token may stand. White space at an
    end of a text makes an empty word, which has no ids.
    """
    texts = pc.fill_null(texts.cast(pa.binary()), b"")
    plain = texts.view(pa.string())
    words = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), plain, pc.ascii_lower(plain)))
    coded = words.flatten().view(pa.binary()).dictionary_encode()
    begins = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(zero_copy_only=False), begins


def _piece_batches(tokenizer_file: str, room: int, end_id: int):
    names = ["id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        ids, end = word_ids(tokenizer_file), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in text_slices(batch, 1, SLICE_BYTES):
                words, places, begins = text_words(part.column(1))
                coded = np.array(ids(words), object)[places].tolist()
                whose, rows = [], []
                for row, (first, last) in enumerate(zip(begins, begins[1:])):
                    stream = b"".join(coded[first:last]) + end
                    for k, lo in enumerate(range(0, len(stream), 4 * room)):
                        chunk = stream[lo : lo + 4 * room]
                        whose.append(row)
                        rows.append((k, lo // 4, len(chunk) // 4, zlib.crc32(chunk)))
                cols = list(zip(*rows, strict=True)) or [[]] * 4
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(whose, pa.int64())), *arrays], names=names)

    return run


def token_pieces(docs: DataFrame, tokenizer_file: str, room: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document: its ids and end_id, cut only beyond `room` tokens."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(_piece_batches(tokenizer_file, room, end_id), schema)


def _dominates(big: tuple[int, ...], small: tuple[int, ...]) -> bool:
    """Whether the items of `small` can be put into bins of the sizes of `big` (Martello and Toth)."""
    if sum(small) > sum(big):
        return False

    def put(rooms: list[int], items: tuple[int, ...]) -> bool:
        if not items:
            return True
        for i, free in enumerate(rooms):
            if free >= items[0] and free not in rooms[:i] and put([*rooms[:i], free - items[0], *rooms[i + 1 :]], items[1:]):
                return True
        return False

    return put(list(big), small)


def _fillings(have: list[int], counts: dict[int, int], free: int, slack: int, work: list[int]) -> Iterator[tuple[int, ...]]:
    """All undominated ways to fill `free` with at most `slack` waste, least waste first, as they are asked for.

    have: lengths still there, ascending. sums[i] has a bit for every sum of the first i lengths, so that only branches
    that can still meet the waste are entered. work[0] counts down by bit sets made and lengths looked at; at zero the
    enumeration ends.
    """
    usable = have[: bisect.bisect_right(have, free)]
    mask, sums = (1 << (free + 1)) - 1, [1]
    for x in usable:
        reach, step = sums[-1], x
        while step <= free:
            reach |= reach << step
            step *= 2
        sums.append(reach & mask)
    work[0] -= len(usable)

    def grow(chosen: tuple[int, ...], left: int, top: int) -> Iterator[tuple[int, ...]]:
        if not left:
            yield chosen
            return
        for at in range(min(top, bisect.bisect_right(usable, left) - 1), -1, -1):
            work[0] -= 1
            if work[0] <= 0 or not sums[at + 1] >> left & 1:
                return
            x = usable[at]
            if counts[x] > chosen.count(x):
                yield from grow((*chosen, x), left - x, at)

    kept: list[tuple[int, ...]] = []
    for waste in range(min(slack, free) + 1):
        if work[0] <= 0:
            return
        if not sums[-1] >> (free - waste) & 1:
            continue
        for filling in grow((), free - waste, len(usable) - 1):
            # a filling with room for one more is dominated, as is one whose items fit into those of another
            if any(x <= waste and counts[x] > filling.count(x) for x in usable[:1]) or any(_dominates(k, filling) for k in kept):
                continue
            kept.append(filling)
            yield filling
            if len(filling) == 1 and not waste:
                return  # an exact single item dominates every other filling of the same room


def lower_bound(lengths: dict[int, int], room: int) -> int:
    """Bins needed at least (Martello and Toth's L2): items over room - k stay alone but for items under k."""
    counts = np.zeros(room + 1, np.int64)
    for x, n in lengths.items():
        counts[x] = n
    number, words = np.cumsum(counts), np.cumsum(counts * np.arange(room + 1))
    half, best = room // 2, 0
    for k in range(half + 1):
        alone, large = number[room] - number[room - k], number[room - k] - number[half]
        free = large * room - (words[room - k] - words[half])
        small = words[half] - (words[k - 1] if k else 0)
        best = max(best, alone + large + max(0, -(-(small - free) // room)))
    return int(best)


def _greedy(lengths: dict[int, int], room: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing: the largest item, then again and again the largest that fits; equal bins at once."""
    counts, have, plan = dict(lengths), sorted(lengths), []
    while have:
        bin_: list[int] = []
        left = room
        while (at := bisect.bisect_right(have, left) - 1) >= 0:
            while at >= 0 and counts[have[at]] <= bin_.count(have[at]):
                at -= 1
            if at < 0:
                break
            bin_.append(have[at])
            left -= have[at]
        times = min(counts[x] // bin_.count(x) for x in set(bin_))
        plan.append((times, tuple(bin_)))
        for x in set(bin_):
            counts[x] -= times * bin_.count(x)
        have = [x for x in have if counts[x]]
    return plan


def pack_lengths(lengths: dict[int, int], room: int = 2048, work: int = 3_000_000, held: int = 16) -> list[tuple[int, tuple[int, ...]]]:
    """Fill bins of `room` with the multiset {length: count}: a list of (times, lengths in one bin).

    Bin completion (Korf, 2003): each bin is built around the largest item left; its undominated fillings are tried,
    least waste first, and a branch is cut when its waste exceeds what a better solution than the incumbent may
    waste. The first incumbent is best-fit decreasing. A filling is used as often as the counts allow, so the depth
    is bounded by the number of lengths, not by the number of items. Fillings are enumerated as the search asks for
    them, all of them if it comes to that. The search ends at the lower bound, when nothing is left to try, or after
    `work` steps (lengths looked at) with the best incumbent. An enumeration takes up to a megabyte, so only those of
    the `held` deepest levels stay; others are made again, up to where they were, when the search comes back.
    """
    total = sum(x * n for x, n in lengths.items())
    least = lower_bound(lengths, room)
    best = _greedy(lengths, room)
    best_bins = sum(t for t, _ in best)
    budget = [work]
    counts, have = dict(lengths), sorted(lengths)
    stack: list[list] = []  # by level: fillings left to try (None: let go), and how many were taken
    path: list[tuple[int, tuple[int, ...]]] = []
    waste = bins = 0

    def options() -> Iterator[tuple[int, tuple[int, ...]]]:
        # what is left is the same whenever the search comes back to this level
        top, spare = have[-1], (best_bins - 1) * room - total - waste
        if spare < 0:
            return
        left = {**counts, top: counts[top] - 1}
        for f in _fillings([x for x in have if left[x]], left, room - top, min(spare, room), budget):
            bin_ = (top, *f)
            yield min(counts[x] // bin_.count(x) for x in set(bin_)), bin_

    def enter() -> None:
        stack.append([options(), 0])
        if len(stack) > held:
            stack[-1 - held][0] = None

    def following() -> tuple[int, tuple[int, ...]]:
        level = stack[-1]
        if level[0] is None:
            level[0], left, budget[0] = options(), budget[0], work  # these steps were counted the first time
            for _ in range(level[1]):
                next(level[0], None)
            budget[0] = left
        level[1] += 1
        return next(level[0], (0, ()))

    def apply(times: int, bin_: tuple[int, ...], sign: int) -> None:
        nonlocal have, waste, bins
        for x in set(bin_):
            counts[x] -= sign * times * bin_.count(x)
        waste += sign * times * (room - sum(bin_))
        bins += sign * times
        have = sorted(x for x, n in counts.items() if n)

    if not lengths or best_bins == least:
        return best
    enter()
    while stack and budget[0] > 0 and best_bins > least:
        times, bin_ = following()
        if not bin_:
            stack.pop()
            if path:
                apply(*path.pop(), -1)
            continue
        budget[0] -= len(have)
        per, spare = room - sum(bin_), (best_bins - 1) * room - total - waste
        if times * per > spare:
            times = spare // per if spare >= 0 and per else 0  # as often as the waste bound allows
        if times < 1 or spare < 0:
            continue
        apply(times, bin_, 1)
        path.append((times, bin_))
        if not have:
            last = bins
            if last < best_bins:
                best, best_bins = list(path), last
            apply(*path.pop(), -1)
            continue
        enter()
    return best


def _assign_batches(plan: list[tuple[int, tuple[int, ...]]]):
    """Rows (id, piece, start, length, ids_crc32, rank) to sequences: ranks of one length fill its bins in plan order."""
    ranges: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for times, bin_ in plan:
        offset = 0
        for x in sorted(set(bin_), reverse=True):
            c = bin_.count(x)
            ranges.setdefault(x, []).append((used.get(x, 0), first, c, offset))
            used[x] = used.get(x, 0) + times * c
            offset += c * x
        first += times
    table = {x: np.array(r, np.int64).T for x, r in ranges.items()}

    def run(batches):
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                lo, base, per, start = table[int(x)]
                k = np.searchsorted(lo, rank[at], side="right") - 1
                past = rank[at] - lo[k]
                seq[at] = base[k] + past // per[k]
                off[at] = start[k] + past % per[k] * x
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(seq), pa.array(off)],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    room: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_rows: int = 2_000,
) -> DataFrame:
    """Pack all documents into sequences of at most `room` tokens: a row per piece with sequence_id and offset.

    Only the histogram of piece lengths, at most `room` rows at any size of the corpus, reaches the driver; the plan
    for it has a few thousand entries. Pieces get their rank among equal lengths by chunks (a window per length and
    chunk of about chunk_rows pieces, and running sums of chunk counts), so no length is gathered in one task.

    A null or blank text is one piece with the end id. Repeated rows are packed each. A null id is packed too. An empty
    table gives an empty result. Other columns of the input are not read.
    """
    pieces = save(token_pieces(docs, tokenizer_file, room, end_id, id_col, text_col), "pieces")
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    lengths = {x: n for x, n in histogram.collect()}
    plan = pack_lengths(lengths, room)
    chunks = max(1, math.ceil(sum(lengths.values()) / chunk_rows))
    dealt = pieces.withColumn("chunk", F.pmod(F.xxhash64("id", "piece"), F.lit(chunks)).cast("int"))
    counts = dealt.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "chunk", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "chunk").orderBy("id", "piece", "start", "ids_crc32")
    ranked = (
        dealt.withColumn("r", F.row_number().over(within) - 1)
        .join(bases, ["length", "chunk"])
        .select("id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("r")).alias("rank"))
    )
    schema = "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(_assign_batches(plan), schema).withColumnRenamed("id", id_col)
