"""Evaluation texts that stand, whole or in part, in a training corpus.

Containment search by MinHash in partitions of size, after which every candidate is verified on
the exact shingles and by alignment. The queries are windows of a dozen words of the items; the
domains are blocks of the documents. Shingles are pairs of words, as one altered word in six must
not break them all. Only shingles that some item has can count for containment, so a document's
other shingles are dropped before hashing; that leaves containment as it was and makes the sets
small. Sets are then partitioned by size: a window's share of a block turns into the least
Jaccard similarity a block of that size can have, and the number of hash functions follows from
it, so that large blocks get as many as they need and small ones no more. Several minima must
agree, as items of ordinary text share a shingle or two with most blocks. Only the items that
agree are verified.
"""

from __future__ import annotations

import html
import re
import unicodedata
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A passage has at least so many running words of the item.
PASSAGE_WORDS = 12
#: Of the 11 shingles of a window so many must be in a block, in any order: one altered word in four leaves 6 or more.
WINDOW_SHARED = 6
#: In so many hash functions the minima of a window and a block must agree. One shared shingle that many items have seldom gives as many.
AGREE = 4
#: And so many must be in order: two altered words leave 7 or more.
IN_ORDER = 7
#: A span of a passage has at most one word in so many altered, added or left out: two in a dozen.
WORDS_AN_EDIT = 5
#: Long passages with more edits count by their local alignment: 1 for a word that fits, -1 for one altered, added or left out.
LEAST_SCORE = 10
#: A window that has its share is missed by the hashing with at most this probability; a passage has several windows.
MISS = 1e-4
#: Sizes of blocks that share one number of hash functions (the largest of each partition). Half of the
#: largest holds a passage of a dozen words with two added.
SIZES = (4, 8, 16, 32)
#: Characters of item texts that one pass holds in memory (index and all about 60 bytes each); more items take more passes over the documents.
ITEM_CHARS = 4_000_000

_MARKUP = re.compile(r"<[^<>\n]+>|\[/?[^\W\d_]+(?:=[^\[\]\n]*)?\]")
#: Scripts without spaces between words: each sign counts as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


class _Plain(dict):
    """Letters and digits to their base letters in lower case, what is not seen to nothing, all else to a space."""

    def __missing__(self, code: int) -> str:
        parts = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", chr(code)).casefold())
        plain = "".join(c if c.isalnum() else "" if unicodedata.category(c) in ("Mn", "Cf") or (unicodedata.category(c) == "Cc" and not c.isspace()) else " " for c in parts)
        self[code] = plain = _UNSPACED.sub(r" \g<0> ", plain)
        return plain


_PLAIN = _Plain()


def plain_words(text: str | None) -> list[str]:
    """Words without case, accents, markup and invisible characters, in compatible forms of Unicode.

    Of scripts without spaces between words every sign is a word.
    """
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text or "[" in text:
        text = _MARKUP.sub(" ", text)
    return text.translate(_PLAIN).split()


def hashes_needed(block: int, query: int = PASSAGE_WORDS - 1, shared: int = WINDOW_SHARED, miss: float = MISS) -> int:
    """Hash functions so that a block of that size with the shared shingles agrees in fewer than AGREE of them with probability miss."""
    similarity = min(shared / (query + block - shared) if block > shared else shared / query, 0.999)
    hashes = AGREE
    while sum(comb(hashes, n) * similarity**n * (1 - similarity) ** (hashes - n) for n in range(AGREE)) > miss:
        hashes += 1
    return hashes


#: By number of shingles in a block.
_HASHES = [hashes_needed(next(s for s in SIZES if n <= s)) for n in range(SIZES[-1] + 1)]


def alignment(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """(score, running words of the item) of the best local alignment; of equal scores the one that ends first."""
    n, m = len(item), len(words)
    table = np.zeros((n + 1, m + 1), dtype=np.int32)
    along = np.arange(m + 1, dtype=np.int32)
    for i in range(1, n + 1):
        above = table[i - 1]
        row = np.zeros(m + 1, dtype=np.int32)
        row[1:] = np.maximum(above[:-1] + np.where(words == item[i - 1], 1, -1), above[1:] - 1)
        np.maximum(row, 0, out=row)
        # gaps in the document: the best of all earlier cells less the distance
        table[i] = np.maximum.accumulate(row + along) - along
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    score, last = int(table[i, j]), int(i)
    while i and j and table[i, j] > 0:
        here = table[i, j]
        if here == table[i - 1, j - 1] + (1 if item[i - 1] == words[j - 1] else -1):
            i, j = i - 1, j - 1
        elif here == table[i - 1, j] - 1:
            i -= 1
        else:
            j -= 1
    return score, last - int(i)


def has_passage(item: np.ndarray, words: np.ndarray) -> bool:
    """Whether some span of PASSAGE_WORDS or more running words of the item stands in words, aligned from end to end.

    At most one word in WORDS_AN_EDIT of the span is altered, added or left out. The first and the last word of
    the span stand as they are: with an altered one there it is a shorter quotation. The score is the words
    of the item less WORDS_AN_EDIT for each edit; unlike a local alignment it may fall below zero on the way.
    """
    never = -(1 << 20)
    along = WORDS_AN_EDIT * np.arange(len(words) + 1, dtype=np.int32)
    # rows: words of the item so far, the last for PASSAGE_WORDS or more; columns: words of the document
    table = np.full((PASSAGE_WORDS, len(words) + 1), never, dtype=np.int32)
    for word in item.tolist():
        same = words == word
        before = table.copy()
        np.maximum(before[-2], before[-1], out=before[-1])
        if (before[-1, :-1][same] >= -1).any():
            return True
        table[1:-1] = before[:-2] + (1 - WORDS_AN_EDIT)
        table[-1] = before[-1] + (1 - WORDS_AN_EDIT)
        step = np.where(same, 1, 1 - WORDS_AN_EDIT)
        np.maximum(table[1:-1, 1:], before[:-2, :-1] + step, out=table[1:-1, 1:])
        np.maximum(table[-1, 1:], before[-1, :-1] + step, out=table[-1, 1:])
        table[0] = never
        table[0, 1:][same] = 1
        # words added in the document
        table = np.maximum.accumulate(table + along, axis=1) - along
    return False


def leaked(item: np.ndarray, words: np.ndarray) -> bool:
    """Whether a passage of the item stands in words: edited here and there, or long enough to bear more edits."""
    score, running = alignment(item, words)
    if score >= LEAST_SCORE and running >= PASSAGE_WORDS:
        return True
    # an edit costs the alignment two at most, so no passage scores less
    return score >= PASSAGE_WORDS - 2 * (PASSAGE_WORDS // WORDS_AN_EDIT) and has_passage(item, words)


def _ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... counts[0] of them, then those of the next."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + counts, counts)


@dataclass
class ItemIndex:
    """Windows of items as MinHash signatures over the shingles that items have. Memory is linear in the items' words."""

    items: list[tuple[object, list[str]]]
    words: dict[str, int] = field(init=False)

    def __post_init__(self) -> None:
        self.words = {}
        coded = [np.array([self.words.setdefault(w, len(self.words) + 1) for w in text], dtype=np.int64) for _, text in self.items]
        self.keys = [key for key, _ in self.items]
        self.coded = coded
        self.base = len(self.words) + 1
        pairs = [c[:-1] * self.base + c[1:] for c in coded]
        every = np.concatenate(pairs) if pairs else np.zeros(0, dtype=np.int64)
        self.pairs, joined = np.unique(every, return_inverse=True)
        # all items one behind the other, as numbers of shingles
        self.joined = joined.astype(np.int32)
        self.length = np.array([len(x) for x in pairs], dtype=np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.inside = np.zeros(max(1, len(self.pairs)), dtype=bool)
        self.most = max(_HASHES)
        rng = np.random.default_rng(20240229)
        # a hash function gives the shingles a random order; a minimum is the first shingle in that order
        self.noise = rng.integers(0, 1 << 32, max(1, len(self.pairs)), dtype=np.uint32)
        self.times = rng.integers(0, 1 << 31, self.most, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.plus = rng.integers(0, 1 << 32, self.most, dtype=np.uint32)
        self.offset = np.arange(self.most) * len(self.pairs)
        self._sign()

    def _sign(self) -> None:
        """The items of which a window has a shingle as its minimum, sorted by hash function and minimum."""
        width = PASSAGE_WORDS - 1
        windows = np.maximum(self.length - width + 1, 0)
        at, owner = _ranges(self.first, windows), np.repeat(np.arange(len(self.length), dtype=np.int32), windows)
        low, item = [], []
        for k in range(self.most if len(at) else 0):
            # the order above, the number of the shingle below
            least = (self.noise[self.joined] * self.times[k] + self.plus[k]).astype(np.uint64) << np.uint64(32) | self.joined.astype(np.uint64)
            have = 1
            while have < width:
                step = min(have, width - have)
                least = np.minimum(least[:-step], least[step:])
                have += step
            first = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            # windows next to each other mostly share their minimum
            new = np.append(True, (first[1:] != first[:-1]) | (owner[1:] != owner[:-1]))
            first, mine = first[new], owner[new]
            order = np.argsort(first, kind="stable")
            low.append(first[order] + k * len(self.pairs))
            item.append(mine[order])
        self.low = np.concatenate(low) if low else np.zeros(0, dtype=np.int64)
        self.item = np.concatenate(item) if item else np.zeros(0, dtype=np.int32)

    def near(self, distinct: np.ndarray) -> np.ndarray:
        """Numbers of the items the windows of which agree with a block of these shingles in AGREE minima."""
        hashes = _HASHES[len(distinct)]
        first = distinct[(self.noise[distinct] * self.times[:hashes, None] + self.plus[:hashes, None]).argmin(axis=1)]
        wanted = first + self.offset[:hashes]
        start = np.searchsorted(self.low, wanted)
        counts = np.searchsorted(self.low, wanted, side="right") - start
        items = self.item[_ranges(start, counts)]
        if len(items) < AGREE:
            return items[:0]
        return np.flatnonzero(np.bincount(items) >= AGREE)

    def holding(self, near: np.ndarray, distinct: np.ndarray) -> np.ndarray:
        """Those of the items a window of which shares WINDOW_SHARED shingles with the block, exactly counted."""
        length, width = self.length[near], PASSAGE_WORDS - 1
        self.inside[distinct] = True
        total = np.concatenate(([0], np.cumsum(self.inside[self.joined[_ranges(self.first[near], length)]])))
        self.inside[distinct] = False
        windows = length - width + 1
        at = _ranges(np.cumsum(length) - length, windows)
        best = np.maximum.reduceat(total[at + width] - total[at], np.cumsum(windows) - windows)
        return near[best >= WINDOW_SHARED]

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Of each word, the number of the shingle that begins there, or -1."""
        found = np.full(len(ids), -1, dtype=np.int64)
        if len(ids) > 1 and len(self.pairs):
            at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            code = ids[at] * self.base + ids[at + 1]
            place = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            same = self.pairs[place] == code
            found[at[same]] = place[same]
        return found

    def candidates(self, places: np.ndarray) -> dict[int, list[int]]:
        """Item number -> starts of the blocks of a document in which a window of it has its share."""
        found: dict[int, list[int]] = {}
        at = np.flatnonzero(places >= 0)
        if len(at) < WINDOW_SHARED:
            return found
        width = SIZES[-1]
        starts = np.arange(at[0], at[-1] + 1, width // 2)
        lows, highs = np.searchsorted(at, starts), np.searchsorted(at, starts + width)
        enough = highs - lows >= WINDOW_SHARED
        for start, low, high in zip(starts[enough].tolist(), lows[enough].tolist(), highs[enough].tolist(), strict=True):
            distinct = np.array(sorted(set(places[at[low:high]].tolist())))
            if len(distinct) < WINDOW_SHARED:
                continue
            near = self.near(distinct)
            if len(near):
                for n in self.holding(near, distinct).tolist():
                    found.setdefault(n, []).append(start)
        return found

    def stretches(self, n: int, places: np.ndarray) -> Iterator[tuple[int, int]]:
        """Where shingles of item n stand at about the same distance from their place in the item, with margins.

        A passage of a dozen words with two altered, added or left out keeps 7 shingles within 2 places of
        one distance and 12 of the item; the same words in another order do not.
        """
        own = self.joined[self.first[n] : self.first[n] + self.length[n]]
        here = np.zeros(len(self.pairs) + 1, dtype=bool)
        here[own] = True
        at = np.flatnonzero(here[places])  # no shingle is -1, the last place
        if len(at) < WINDOW_SHARED:
            return
        here, there = np.nonzero(places[at][:, None] == own[None, :])
        apart = (at[here] - there + len(own)) // 4
        counts = np.bincount(apart)
        counts = counts + np.append(counts[1:], 0)
        groups = np.flatnonzero(counts >= IN_ORDER)
        seen: list[tuple[int, int]] = []
        for group in groups[np.argsort(-counts[groups], kind="stable")].tolist():
            mine = (apart == group) | (apart == group + 1)
            steps = np.sort(there[mine])
            if (steps[IN_ORDER - 1 :] - steps[: 1 - IN_ORDER]).min() < 2 * PASSAGE_WORDS:
                # words added or left out move the rest of a long passage; it stays within a few dozen places
                near = at[here[np.abs(apart - group) <= 6]]
                low, high = int(near[0]) - 2 * PASSAGE_WORDS, int(near[-1]) + 2 * PASSAGE_WORDS
                if not any(a <= low and high <= b for a, b in seen):
                    seen.append((low, high))
                    yield low, high

    def search(self, ids: np.ndarray) -> list[object]:
        """Keys of the items of which a passage stands in a document of these word ids."""
        found = []
        places = self.places(ids)
        for n, starts in self.candidates(places).items():
            key, item = self.keys[n], self.coded[n]
            reach = len(item) + SIZES[-1]
            done = -1
            for start in starts:
                if start < done:  # the last stretch has this block well inside
                    continue
                low, high = max(0, start - reach), start + 2 * reach
                done = start + reach - SIZES[-1]
                if any(leaked(item, ids[max(0, low + a) : low + b]) for a, b in self.stretches(n, places[low:high])):
                    found.append(key)
                    break
        return found


def _blocks(items: Iterable[tuple[object, str | None]]) -> Iterator[list[tuple[object, list[str]]]]:
    """Words of the items that can have passages, in blocks of at most ITEM_CHARS characters (or one item)."""
    block: list[tuple[object, list[str]]] = []
    size = 0
    for key, text in items:
        words = plain_words(text)
        if len(words) < PASSAGE_WORDS:
            continue
        if block and size + len(text or "") > ITEM_CHARS:
            yield block
            block, size = [], 0
        block.append((key, words))
        size += len(text or "")
    if block:
        yield block


def find_leaks(documents: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(doc, item) of every document in which a passage of an item stands, each pair once.

    documents: doc, text; items: item, text, a stated set of queries. Items pass through the driver one
    partition and one block of ITEM_CHARS at a time; each block is compared with all documents in one pass
    without a shuffle, further blocks take further passes. Null, empty and short texts have no passages;
    repeated documents are found each by itself; items with the same text all count; an empty side gives no rows.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(doc).alias("_doc"), F.col(text).alias("_text")).filter("_doc IS NOT NULL AND length(_text) > 0")
    queries = items.select(F.col(item).alias("_item"), F.col(text).alias("_text")).filter("_item IS NOT NULL AND length(_text) > 0")
    kinds = rows.schema[0].dataType.simpleString(), queries.schema[0].dataType.simpleString()
    schema = f"`{doc}` {kinds[0]}, `{item}` {kinds[1]}"
    result = None
    for block in _blocks((r[0], r[1]) for r in queries.distinct().toLocalIterator()):
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            index = _index(name, shared)
            known = index.words.get
            for batch in batches:
                docs, leaks = [], []
                for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    words = plain_words(value)
                    ids = np.fromiter(map(known, words, repeat(0)), dtype=np.int64, count=len(words))
                    for leak in index.search(ids):
                        docs.append(key)
                        leaks.append(leak)
                yield pa.RecordBatch.from_arrays([pa.array(docs, batch.schema.field(0).type), pa.array(leaks)], names=[doc, item])

        found = rows.mapInArrow(run, schema)
        result = found if result is None else result.unionByName(found)
    return result.distinct() if result is not None else spark.createDataFrame([], schema)


_INDEX: dict[str, ItemIndex] = {}


def _index(name: str, shared) -> ItemIndex:  # noqa: ANN001
    """One index per worker process and block of items."""
    if name not in _INDEX:
        _INDEX.clear()
        _INDEX[name] = ItemIndex(shared.value)
    return _INDEX[name]
