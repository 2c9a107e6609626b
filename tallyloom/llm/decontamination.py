"""Benchmark passages in training text: pairs of neighbouring words as seeds, then Smith-Waterman alignment."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.common import by_batch, forget, keep_rows, pick, stored

MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
#: Least alignment score as a share of the item's best possible one.
LEAST = 0.5
#: Words; a stretch so long of a longer item is a passage by itself.
RUN = 60
#: Words of benchmark items that one pass over the training text holds.
BLOCK_WORDS = 500_000
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def stretches(n: int) -> list[tuple[int, int]]:
    """First word and length of the parts of an item of ``n`` words."""
    if n <= RUN:
        return [(0, n)]
    pieces = -(-n // RUN)
    ends = [n * i // pieces for i in range(pieces + 1)]
    return [(i, RUN) for i in [*range(0, n - RUN, RUN // 2), n - RUN]] + [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


class Items:
    """A block of benchmark items and the places of all their pairs of neighbouring words.

    An alignment that scores ``LEAST`` of an item's n words holds at least n / 3 - 1 such pairs with at
    most one other word between the two. For say it matches m words, skips or changes d words of the item between
    these and puts i words between: of its m - 1 - d pairs all but p have two or more words between, so
    i >= 2 (m - 1 - d - p), and n / 2 <= m - d / 2 - i / 2 gives p >= n / 2 - 1 - d / 2, while
    d <= n / 3 follows from m + d <= n. In an item of three words the outer two are a pair as well; an item of one word is
    its own seed.

    Items over ``RUN`` words are sought by parts: stretches of ``RUN`` words that begin every ``RUN / 2`` words, and
    pieces of up to ``RUN`` words that make up the item, of which one scores ``LEAST`` if the whole does.
    """

    def __init__(self, rows: list[tuple[object, list[str]]]):
        self.keys = [k for k, _ in rows]
        self.vocab: dict[str, int] = {}
        self.ids = [np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words], np.int64) for _, words in rows]
        self.size = len(self.vocab) + 1
        self.parts = [(i, *part) for i, own in enumerate(self.ids) for part in stretches(len(own))]
        self.lengths = np.array([n for _, _, n in self.parts], np.int64)
        self.least = np.maximum(1, (self.lengths - 1) // 3)
        seeds, owners, places = [], [], []
        for k, (i, first, n) in enumerate(self.parts):
            own = self.ids[i][first : first + n]
            found = [self.pairs(own, 1), self.pairs(own, 2)[: n == 3]] if n > 1 else [self.single(own)]
            seeds += found
            owners.append(np.full(sum(map(len, found)), k))
            places += [np.arange(len(x)) for x in found]
        seeds, owners, places = (np.concatenate(x) for x in (seeds, owners, places))
        order = np.argsort(seeds, kind="stable")
        self.owners, self.places = owners[order], places[order]
        self.seeds, first = np.unique(seeds[order], return_index=True)
        self.first = np.r_[first, len(order)]

    def pairs(self, ids: np.ndarray, apart: int) -> np.ndarray:
        """A number for every two words so far apart; -1 where one of them is in no item."""
        left, right = ids[:-apart], ids[apart:]
        return np.where((left >= 0) & (right >= 0), left * self.size + right, -1)

    def single(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= 0, self.size * self.size + ids, -1)

    def read(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.vocab.get, words, [-1] * len(words)), np.int64, len(words))

    def near(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Every part of an item with so many seeds in one stretch of a text that a copy may be there, and where it would begin by each."""
        grams = [self.pairs(ids, 1), self.pairs(ids, 2)] + [self.single(ids)] * bool((self.lengths == 1).any())
        at = np.concatenate([np.arange(len(x)) for x in grams])
        grams = np.concatenate(grams)
        spot = np.minimum(np.searchsorted(self.seeds, grams), len(self.seeds) - 1)
        found = np.flatnonzero(self.seeds[spot] == grams)
        spot, at = spot[found], at[found]
        widths = self.first[spot + 1] - self.first[spot]
        row = np.arange(widths.sum()) + np.repeat(self.first[spot] - np.cumsum(widths) + widths, widths)
        parts, starts = self.owners[row], np.repeat(at, widths) - self.places[row]
        order = np.lexsort((starts, parts))
        parts, starts = parts[order], starts[order]
        # what one alignment inserts and skips shifts its seeds by no more than the part's length
        last = np.arange(len(parts)) + self.least[parts] - 1
        full = np.flatnonzero(last < len(parts))
        last = last[full]
        full = full[(parts[last] == parts[full]) & (starts[last] - starts[full] <= self.lengths[parts[full]])]
        for part in np.unique(parts[full]).tolist():
            yield part, starts[np.searchsorted(parts, part) : np.searchsorted(parts, part, "right")]


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int]:
    """The best local alignment score and the position in ``text`` after its last word.

    One row per word of the item; within a row gaps in the item are resolved by a running maximum.
    """
    slope = -GAP * np.arange(len(text) + 1)
    above, best, end = np.zeros(len(text) + 1), 0.0, 0
    for word in item.tolist():
        row = np.maximum(above + GAP, 0)
        np.maximum(row[1:], above[:-1] + np.where(text == word, MATCH, MISMATCH), out=row[1:])
        row = np.maximum.accumulate(row + slope) - slope
        at = int(row.argmax())
        if row[at] > best:
            best, end = float(row[at]), at
        above = row
    return best, end


def passages(items: Items, ids: np.ndarray) -> Iterator[tuple[int, float, int, int, int]]:
    """(item, score, first word, last word, seeds) of the best alignment of every item that a text holds."""
    places: dict[int, list[tuple[int, int, bool, int]]] = {}
    for part, starts in items.near(ids):
        (item, first, size), starts = items.parts[part], starts.tolist()
        own, whole = items.ids[item][first : first + size], len(items.ids[item])
        least, need = LEAST * MATCH * size, Counter(own.tolist())
        begin = 0
        for i in range(1, len(starts) + 1):
            if i < len(starts) and starts[i] - starts[i - 1] <= size:
                continue
            low, high, hits, begin = starts[begin], starts[i - 1], i - begin, i
            if hits < items.least[part]:
                continue
            text = ids[max(0, low - size) : high + 2 * size]
            have = Counter(text[text >= 0].tolist())
            if sum(min(k, have[w]) for w, k in need.items()) * MATCH < least:
                continue  # no alignment can score more than its matching words
            if size == whole or align(own, text)[0] >= least:
                places.setdefault(item, []).append((max(0, low - first - whole), high - first + 2 * whole, size == RUN < whole, hits))
    for item, spots in sorted(places.items()):
        own, best = items.ids[item], None
        size = len(own)
        for a, b, held, hits in merged(spots) if size > RUN else spots:
            score, end = align(own, ids[a:b])
            if (held or score >= LEAST * MATCH * size) and (best is None or score / (MATCH * size) > best[1]):
                back, length = align(own[::-1], ids[a:b][:end][::-1])
                best = (item, score / (MATCH * size), a + end - length, a + end - 1, hits)
        if best:
            yield best


def merged(spots: list[tuple[int, int, bool, int]]) -> list[tuple[int, int, bool, int]]:
    """Stretches of a text, those that overlap as one: whether any holds a passage for sure, and the most seeds of one."""
    out: list[tuple[int, int, bool, int]] = []
    for a, b, held, hits in sorted(spots):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), held or out[-1][2], max(hits, out[-1][3]))
        else:
            out.append((a, b, held, hits))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[tuple[Items, bool]]:
    """All items in blocks of about ``BLOCK_WORDS`` words, and whether another block follows; an item is never split."""
    rows, held = [], 0
    for row in pick(benchmark, item, text).orderBy(item, text).toLocalIterator():
        words = words_of(row[1])
        if words and held >= BLOCK_WORDS:
            yield Items(rows), True
            rows, held = [], 0
        if words:
            rows.append((row[0], words))
            held += len(words)
    if rows:
        yield Items(rows), False


def _search(items: Items, key: str) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        who, found = [], []
        for i, value in enumerate(batch.column(1)):
            for hit in passages(items, items.read(value.as_py())):
                who.append(i)
                found.append(hit)
        columns = [batch.column(0).take(pa.array(who, pa.int64())), pa.array([items.keys[h[0]] for h in found], pa.int64()), pa.array([h[1] for h in found], pa.float64())]
        columns += [pa.array([h[j] for h in found], pa.int64()) for j in (2, 3, 4)]
        return pa.RecordBatch.from_arrays(columns, names=[key, "item_id", "score", "first_word", "last_word", "n_seeds"])

    return make


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """Every document and benchmark item of which the document holds a copy, edited or not.

    Words are runs of letters, digits and underscores in lower case. All pairs of neighbouring words of an
    item are seeds, however common, also where the text has one word between the two; an item with
    too few of them in a stretch of a text can't be aligned well there (see :class:`Items`). Around
    the others the text is aligned with the item; a score of ``LEAST`` of the item's length is a leak, and so is
    one of half of ``RUN`` in a stretch of ``RUN`` words of a longer item, such as half as many words in a row;
    ``score`` is the whole item's then too and may be low, ``n_seeds`` that of the part with most.
    No alignment of that score is missed, save for items of two words, of which one word alone would do: both must stand.

    The benchmark is held in blocks of ``BLOCK_WORDS`` words, each with one pass over the text; what
    a block finds is written before the next one is read, so neither the driver nor a plan holds more than one or two. Documents are never shuffled. Null and empty texts and items hold nothing. Each document row gives at
    most one row per item: the best alignment, the first of equals.
    """
    rows = pick(docs, key, text)
    form = f"{key} {dict(rows.dtypes)[key]}, item_id long, score double, first_word long, last_word long, n_seeds long"
    found = rows.sparkSession.createDataFrame([], form)
    for items, more in _blocks(benchmark, item, "text"):
        own = rows.mapInArrow(by_batch(_search(items, key)), form)
        found = found.unionByName(stored(own) if more else own)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents, with all columns, in which :func:`find_leaks` finds nothing.

    What is kept is written after every block of the benchmark but the last; only the newest of these tables stays.
    """
    kept, before = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), None
    for items, more in _blocks(benchmark, item, "text"):

        def clean(texts: pa.Array, items: Items = items) -> list[bool]:
            return [next(passages(items, items.read(t.as_py())), None) is None for t in texts]

        kept = keep_rows(kept, f"c{docs.columns.index(text)}", clean)
        if more:
            kept, old = stored(kept), before
            before = kept
            if old is not None:
                forget(old)
    return kept.toDF(*docs.columns)
