"""Evaluation texts leaking into training text, found with an index of each shard of the corpus.

Words are compared in one form: visual form, lower case, no marks, no punctuation. The words of the test items are the
alphabet; any other word is one common symbol that no phrase holds. A shard (a bounded number of words of whole documents)
is indexed by its suffix order, whose preceding symbols are kept in a wavelet matrix with rank counts, and by suffix
positions sampled at every 16th place. All phrases of five words of all items are searched backwards at once, one rank
query per symbol and end; occurrences are located by walking back to a sampled position. Around each occurrence the words
along near-by diagonals are counted, and what may hold a passage is aligned word by word, again and again until the rest
of the diagonals can hold none; the spans of all passages of a document are merged into its removal spans.

A passage is a stretch of at least 20 words of an item with less than one word in seven changed, left out or put in. Twenty
words with up to three such edits, and any longer passage, leave five words in a row untouched, so no passage is missed by
searching phrases of five.

Defined cases: null and empty texts and items hold nothing; items of fewer than 20 words cannot leak; equal items leak
together; documents of any length are indexed whole. Test items are compiled on the driver in blocks of a bounded number
of words, one at a time, and each block is broadcast: its size is known, and every worker unpacks it once.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.visual_form import one_form

PHRASE = 5
PASSAGE = 20
ONE_IN = 7
SHARD_WORDS = 200_000
WORDS_PER_BLOCK = 2_000_000
SAMPLE = 16
BAND = 4
_WORD = regex.compile(r"[^\W_]+")


class _Bare(dict):
    """Characters without their marks and in compatible form, found out once each."""

    def __missing__(self, code: int) -> str:
        self[code] = bare = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        return bare


_BARE = _Bare()
#: Texts that the visual form would not change but for blanks, which part words all the same.
_PLAIN = r"^[\x20-\x7E\t\n\r\x0b\x0c]*$"


def words_of(text: str) -> list[str]:
    """The words of a text that is in visual form already."""
    text = text.lower()
    return _WORD.findall(text if text.isascii() else text.translate(_BARE))


def forms_of(texts: pa.Array) -> list[str | None]:
    """Texts in visual form; those that are plain already are left alone."""
    out = texts.to_pylist()
    odd = pa.compute.indices_nonzero(pa.compute.invert(pa.compute.match_substring_regex(texts, _PLAIN)))
    for i, form in zip(odd.to_pylist(), one_form(texts.take(odd)).to_pylist()):
        out[i] = form
    return out


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix order of an integer array by prefix doubling, which goes on only among suffixes that are still alike.

    The first round sorts by as many symbols as fit one integer. A suffix's rank is the place of the first of those like it.
    """
    n, bits = len(text), max(1, int(text.max() + 1).bit_length())
    step = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(step):
        key <<= bits
        key[: max(0, n - k)] |= text[k:] + 1
    order = np.argsort(key, kind="stable")
    at, sorted_key = np.arange(n), key[order]
    rank = np.empty(n, np.int64)
    while True:
        first = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
        rank[order[at]] = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        alone = first & np.concatenate([first[1:], [True]])
        at = at[~alone]
        if not len(at):
            return order
        suffix = order[at]
        after = np.where(suffix + step < n, rank[np.minimum(suffix + step, n - 1)] + 1, 0)
        key = rank[suffix] * (n + 1) + after
        turn = np.argsort(key, kind="stable")
        order[at], sorted_key = suffix[turn], key[turn]
        step *= 2


class ShardIndex:
    """Full-text index of an integer array that ends with the only 0 in it."""

    def __init__(self, text: np.ndarray, n_symbols: int) -> None:
        order = suffix_order(text)
        preceding = text[order - 1]
        self.n, self.levels = len(text), max(1, int(n_symbols).bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))]).astype(np.int64)
        self.zeros, self.ones_before, rest = [], [], preceding
        for level in range(self.levels - 1, -1, -1):  # wavelet matrix: a stable partition by each bit, highest first
            bit = (rest >> level) & 1
            self.ones_before.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])
        self.preceding = preceding
        sampled = order % SAMPLE == 0
        self.sampled, self.sample_no, self.samples = sampled, np.cumsum(sampled) - 1, order[sampled]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place among the preceding symbols."""
        lo, hi = np.zeros_like(place), place.copy()
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            ones, one = self.ones_before[i], ((symbol >> level) & 1).astype(bool)
            a, b = ones[lo], ones[hi]
            lo, hi = np.where(one, self.zeros[i] + a, lo - a), np.where(one, self.zeros[i] + b, hi - b)
        return hi - lo

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with each phrase (one phrase a row), read from its last word to its first."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k]
            lo[live], hi[live] = self.first[c] + self.rank(c, lo[live]), self.first[c] + self.rank(c, hi[live])
            dead = lo[live] >= hi[live]
            hi[live[dead]] = lo[live[dead]]
            live = live[~dead]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of suffixes given by their rows."""
        at, walked, result = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            found = self.sampled[at[live]]
            done = live[found]
            result[done] = self.samples[self.sample_no[at[done]]] + walked[done]
            live = live[~found]
            c = self.preceding[at[live]].astype(np.int64)
            at[live] = self.first[c] + self.rank(c, at[live])
            walked[live] += 1
        return result


class Items:
    """Test items as symbols: 0 ends a shard, 1 is any other word, the words of the items follow."""

    def __init__(self, items: list[tuple[object, str | None]]) -> None:
        split = [(i, words_of(t)) for (i, _), t in zip(items, forms_of(pa.array([t for _, t in items], pa.string()))) if t]
        split = [(i, w) for i, w in split if len(w) >= PASSAGE]
        self.ids = [i for i, _ in split]
        self.symbol: dict[str, int] = {}
        self.words = [np.array([self.symbol.setdefault(x, len(self.symbol) + 2) for x in w], np.int64) for _, w in split]
        self.n_symbols = len(self.symbol) + 2
        self.flat = np.concatenate(self.words) if split else np.empty(0, np.int64)
        self.start = np.concatenate([[0], np.cumsum([len(w) for w in self.words])]).astype(np.int64) if split else np.zeros(1, np.int64)
        every = [(self.flat[s + p : s + p + PHRASE].tobytes(), n, p) for n, s in enumerate(self.start[:-1]) for p in range(len(self.words[n]) - PHRASE + 1)]
        phrases: dict[bytes, list[tuple[int, int]]] = {}
        for key, n, p in every:
            phrases.setdefault(key, []).append((n, p))
        self.phrases = np.array([np.frombuffer(k, np.int64) for k in phrases]).reshape(-1, PHRASE)
        counts = np.array([len(v) for v in phrases.values()], np.int64)
        self.use_from = np.concatenate([[0], np.cumsum(counts)])
        self.uses = np.array([x for v in phrases.values() for x in v], np.int64).reshape(-1, 2)


def best_path(item: list[int], doc: list[int], shift: int, used: dict[int, set[int]], band: int) -> list[tuple[bool, bool, int, int]]:
    """The best path near the diagonal doc = item + shift without matches used before: (same, of item, doc word, item word) of its steps."""
    gap, width = 1, 2 * band + 1  # low, so that a passage is followed across edits near its ends; its share of edits is tested below
    best, best_at = 0, None
    above = [0] * (width + 1)
    moves: list[list[int]] = []
    for i, x in enumerate(item):
        now, move = [0] * (width + 1), [0] * width
        left, taken = -1, used.get(i, ())
        for k in range(width):
            j = i + shift - band + k
            if not 0 <= j < len(doc):
                left = -1
                continue
            score, how = above[k] + (1 if doc[j] == x and j not in taken else -gap), 1
            if above[k + 1] - gap > score:
                score, how = above[k + 1] - gap, 2  # a word of the item is left out
            if left - gap > score:
                score, how = left - gap, 3  # a word is put in
            if score <= 0:
                score, how = 0, 0
            elif score > best:
                best, best_at = score, (i, k)
            now[k], move[k], left = score, how, score
        moves.append(move)
        above = now
    if best_at is None:
        return []
    i, k = best_at
    path = []
    while i >= 0 and 0 <= k < width and moves[i][k]:
        how, j = moves[i][k], i + shift - band + k
        path.append((how == 1 and doc[j] == item[i] and j not in used.get(i, ()), how != 3, j, i))
        i, k = (i - 1, k) if how == 1 else (i - 1, k + 1) if how == 2 else (i, k - 1)
    path.reverse()
    return path


def stretches(path: list[tuple[bool, bool, int, int]]) -> list[tuple[int, int, int, int]]:
    """The passages on a path, the longest first, then those before and after it: (item words, edits, first, last doc word)."""
    out, parts = [], [(0, len(path))]
    while parts:
        lo, hi = parts.pop()
        if hi - lo < PASSAGE:
            continue
        found = None
        for a in range(lo, hi):
            if not path[a][0]:
                continue
            used = edits = 0
            for b in range(a, hi):
                same, of_item, _, _ = path[b]
                used, edits = used + of_item, edits + (not same)
                if same and used >= PASSAGE and edits * ONE_IN < used and (found is None or used > found[0]):
                    found = (used, edits, a, b)
        if found:
            used, edits, a, b = found
            out.append((used, edits, path[a][2], path[b][2]))
            parts += [(lo, a), (b + 1, hi)]
    return out


def align(item: list[int], doc: list[int], shift: int, band: int = 12) -> list[tuple[int, int, int, int]]:
    """All passages near the diagonal doc = item + shift: (item words, edits, first, last doc word).

    The best path is taken out and the next one looked for, until too little is left for any passage: the matches of one
    outnumber its edits by 16 at least (20 words with 2, 22 with 3).
    """
    out, used = [], {}
    while _rest_may_hold(item, doc, shift, used, band):
        path = best_path(item, doc, shift, used, band)
        if sum(1 if step[0] else -1 for step in path) < PASSAGE - 4:
            break
        out += stretches(path)
        for same, _, j, i in path:
            if same:
                used.setdefault(i, set()).add(j)
    return out


def _rest_may_hold(item: list[int], doc: list[int], shift: int, used: dict[int, set[int]], band: int) -> bool:
    """Whether at least 16 in some 20 words of the item are still found near the diagonal. Words 0 and 1 are in no item."""
    held = []
    for i, x in enumerate(item):
        lo, hi = max(0, i + shift - band), max(0, i + shift + band + 1)
        near = doc[lo:hi]
        held.append(near.count(x) > sum(lo <= j < hi for j in used.get(i, ())))
    n = sum(held[:PASSAGE])
    most = n
    for i in range(PASSAGE, len(held)):
        n += held[i] - held[i - PASSAGE]
        most = max(most, n)
    return most >= PASSAGE - 4


def _shard(ids: list[object], docs: list[np.ndarray], items: Items) -> list[tuple[object, object, int, int, int, int]]:
    """Passages in the documents of one shard."""
    lengths = np.array([len(d) for d in docs], np.int64)
    words = np.concatenate([x for d in docs for x in (d, [1])])  # a border after each document
    owner = np.repeat(np.arange(len(docs)), lengths + 1)
    begin = np.cumsum(lengths + 1) - lengths - 1
    kept = (words != 1) | np.concatenate([[True], words[:-1] != 1])  # runs of other words shrink to one
    place = np.flatnonzero(kept)
    index = ShardIndex(np.concatenate([words[place], [0]]), items.n_symbols)
    lo, hi = index.search(items.phrases)
    hit = np.flatnonzero(hi > lo)
    if not len(hit):
        return []
    n = hi[hit] - lo[hit]
    at = place[index.locate(np.repeat(lo[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))]
    phrase = np.repeat(hit, n)
    m = items.use_from[phrase + 1] - items.use_from[phrase]
    use = items.uses[np.repeat(items.use_from[phrase], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)]
    at = np.repeat(at, m)
    doc, item, shift = owner[at], use[:, 0], at - begin[owner[at]] - use[:, 1]
    seeds = np.unique(np.stack([doc, item, shift, use[:, 1]], 1), axis=0)
    near = np.ones(len(seeds), bool)  # of seeds on one diagonal, those less than a phrase apart say the same
    near[1:] = (seeds[1:, :3] != seeds[:-1, :3]).any(1) | (seeds[1:, 3] - seeds[:-1, 3] > PHRASE)
    seeds = seeds[near]
    likely = []
    for block in np.array_split(seeds, max(1, len(seeds) // 20_000)):
        likely.append(block[_may_hold(block, words, begin, lengths, items)])
    out, seen = [], {}
    for d, i, s, _ in np.concatenate(likely).tolist():
        if any(abs(s - other) <= BAND for other in seen.setdefault((d, i), [])):
            continue
        seen[d, i].append(s)
        out += [(ids[d], items.ids[i], *passage) for passage in align(items.words[i].tolist(), docs[d].tolist(), s)]
    return out


def _may_hold(seeds: np.ndarray, words: np.ndarray, begin: np.ndarray, lengths: np.ndarray, items: Items) -> np.ndarray:
    """Whether the words of the item near a seed are mostly found on the diagonals around it: at least 16 in some 20."""
    reach = PASSAGE + 2
    offset = np.arange(-reach, reach + PHRASE)
    pos = seeds[:, 3:4] + offset
    size = (items.start[1:] - items.start[:-1])[seeds[:, 1]][:, None]
    inside = (pos >= 0) & (pos < size)
    symbol = items.flat[np.clip(items.start[seeds[:, 1]][:, None] + pos, 0, len(items.flat) - 1)]
    same = np.zeros(pos.shape, bool)
    for shift in range(-BAND, BAND + 1):
        j = pos + seeds[:, 2:3] + shift
        ok = inside & (j >= 0) & (j < lengths[seeds[:, 0]][:, None])
        same |= ok & (words[np.clip(begin[seeds[:, 0]][:, None] + j, 0, len(words) - 1)] == symbol)
    total = np.concatenate([np.zeros((len(seeds), 1), np.int64), np.cumsum(same, 1)], 1)
    return (total[:, PASSAGE:] - total[:, :-PASSAGE]).max(1) >= PASSAGE - 4


def passages(df: DataFrame, key: str, text: str, benchmark: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """(doc_id, item_id, n_words, n_edits, first_word, last_word) of the passages of test items in the documents.

    One narrow pass over the corpus for each block of test items, without a shuffle; a task holds one shard at a time.
    """
    id_type, item_type = df.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, n_words int, n_edits int, first_word int, last_word int"
    docs = df.select(key, text).where(f"`{text}` is not null and `{text}` <> ''")
    context = df.sparkSession.sparkContext

    def search(block: list[tuple[object, str | None]]) -> DataFrame:
        compiled = context.broadcast(Items(block))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items, ids, held, count = compiled.value, [], [], 0
            arrow = None

            def flush() -> pa.RecordBatch:
                found = sorted(set(_shard(ids, held, items)))
                return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate(arrow)], names=["doc_id", "item_id", "n_words", "n_edits", "first_word", "last_word"])

            if not items.ids:
                for _ in batches:
                    pass
                return
            symbol = items.symbol.get
            for batch in batches:
                arrow = [batch.schema.field(0).type, pa.int64() if isinstance(items.ids[0], int) and item_type == "bigint" else (pa.int32() if item_type == "int" else pa.string()), *[pa.int32()] * 4]
                for i, t in zip(batch.column(0).to_pylist(), forms_of(batch.column(1))):
                    symbols = np.array([symbol(w, 1) for w in words_of(t)], np.int64)
                    if len(symbols) >= PASSAGE - PASSAGE // ONE_IN - 1:
                        ids.append(i)
                        held.append(symbols)
                        count += len(symbols)
                    if count >= SHARD_WORDS:
                        yield flush()
                        ids, held, count = [], [], 0
            if held:
                yield flush()

        return docs.mapInArrow(run, schema)

    parts, block, words = [], [], 0
    for row in benchmark.select(item_key, item_text).toLocalIterator():
        block.append((row[0], row[1]))
        words += len(row[1] or "") // 4 + 1
        if words >= WORDS_PER_BLOCK:
            parts.append(search(block))
            block, words = [], 0
    if block or not parts:
        parts.append(search(block))
    return reduce(DataFrame.unionByName, parts)


def removal_spans(passages: DataFrame) -> DataFrame:
    """(doc_id, first_word, last_word): the words of each document that are in any passage, as spans that do not touch."""
    in_order = Window.partitionBy("doc_id").orderBy("first_word", "last_word")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    starts = passages.withColumn("starts", F.coalesce(F.col("first_word") > F.max("last_word").over(before) + 1, F.lit(True)))
    spans = starts.withColumn("span", F.count_if("starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy("doc_id", "span").agg(F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word")).drop("span")
