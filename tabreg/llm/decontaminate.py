"""Documents that hold benchmark items, up to a number of word edits.

Texts and items are read as lower-cased words (runs of letters, digits and underscores). An item of m words may
be matched with up to k = floor(``error_rate`` * m) insertions, deletions and substitutions of words. It is split into k + 1
pieces: a match within k edits leaves at least one piece untouched (pigeonhole). Exact hits of pieces are found
by rolling hashes over whole texts, one array pass per piece length; each hit is checked word by word and
gives a diagonal, and Myers' bit-parallel search of the item in the surrounding words gives the smallest distance and
where it ends.

Items are the query set. They are read in blocks of at most ``block_chars`` characters, and each block is sent to the
tasks and run over all documents, so memory is bounded whatever the size of either table. The documents are not shuffled.

Items of any word count; a caller may set ``min_words`` to leave shorter ones out. Items without words match nothing. Null
and empty texts match nothing; repeated rows each give their matches; repeated items match alike. Empty tables give
an empty result. Extra columns are ignored, or kept by ``keep_clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import parts, per_batch, texts_of

WORDS = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
FILTER_BITS = 20


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def pieces_of(n: int, errors: int) -> list[tuple[int, int]]:
    """(first word, words) of the ``errors`` + 1 near-equal pieces of ``n`` words."""
    cuts = [i * n // (errors + 1) for i in range(errors + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def best_match(item: list[int], text: list[int]) -> tuple[int, int]:
    """(smallest edit distance of ``item`` to any part of ``text``, end of the first such part).

    Myers 1999: the column of vertical differences is two bit sets, moved by a few operations per word of the text.
    """
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[int, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    up, down, distance = full, 0, m
    best = (m, 0)
    for at, w in enumerate(text, 1):
        equal = where.get(w, 0)
        vertical = equal | down
        equal |= ((equal & up) + up) ^ up
        rises = down | (full & ~(equal | up))
        falls = up & equal
        if rises & top:
            distance += 1
        elif falls & top:
            distance -= 1
        rises, falls = rises << 1 & full, falls << 1 & full
        up = falls | (full & ~(vertical | rises))
        down = rises & vertical
        if distance < best[0]:
            best = (distance, at)
    return best


class Items:
    """Pieces of a block of items, ready to be looked up."""

    def __init__(self, rows: list[tuple[int | None, str]], error_rate: float, min_words: int):
        self.number: dict[str, int] = {}
        self.ids: list[int | None] = []
        self.items: list[list[int]] = []
        self.errors: list[int] = []
        for key, text in rows:
            words = words_of(text or "")
            if len(words) >= min_words:
                self.ids.append(key)
                self.items.append([self.number.setdefault(w, len(self.number) + 1) for w in words])
                self.errors.append(int(error_rate * len(words)))
        rng = np.random.default_rng(3)
        self.values = rng.integers(1, 1 << 63, len(self.number) + 1, dtype=np.int64).astype(np.uint64)
        self.values[0] = 0  # a word of no item
        pieces: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for at, (item, errors) in enumerate(zip(self.items, self.errors)):
            for first, length in pieces_of(len(item), errors):
                value = self._hash(item[first : first + length])
                pieces.setdefault(length, {}).setdefault(value, []).append((at, first))
        self.pieces = pieces
        self.filters = {}
        for length, found in pieces.items():
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[np.array(list(found), np.uint64) >> np.uint64(64 - FILTER_BITS)] = True
            self.filters[length] = bits

    def _hash(self, item: list[int]) -> int:
        value, power = 0, 1
        for w in item:
            value = (value + int(self.values[w]) * power) & (1 << 64) - 1
            power = power * int(BASE) & (1 << 64) - 1
        return value

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, first word, last word + 1) of the best match of each item within its errors."""
        if not self.items:
            return []
        get = self.number.get
        words = [get(w, 0) for w in words_of(text)]
        n = len(words)
        if not n:
            return []
        flat = np.array(words, np.int64)
        powers = np.empty(n, np.uint64)
        back = np.empty(n, np.uint64)
        powers[0] = back[0] = 1
        powers[1:], back[1:] = BASE, INVERSE
        powers, back = np.cumprod(powers), np.cumprod(back)
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.values[flat] * powers)))
        strangers = np.concatenate(([0], np.cumsum(flat == 0)))
        spots: set[tuple[int, int]] = set()
        for length, found in self.pieces.items():
            if length > n:
                continue
            value = (prefix[length:] - prefix[:-length]) * back[: n - length + 1]
            may = self.filters[length][value >> np.uint64(64 - FILTER_BITS)] & (strangers[length:] == strangers[:-length])
            for at in np.flatnonzero(may).tolist():
                for item, first in found.get(int(value[at]), ()):
                    if words[at : at + length] == self.items[item][first : first + length]:
                        spots.add((item, at - first))
        regions: list[list[int]] = []  # item, first word, last word + 1; overlapping ones are searched as one
        for item, start in sorted(spots):
            low, high = max(0, start - self.errors[item]), min(n, start + len(self.items[item]) + self.errors[item])
            if regions and regions[-1][0] == item and low <= regions[-1][2]:
                regions[-1][2] = high
            else:
                regions.append([item, low, high])
        best: dict[int, tuple[int, int, int]] = {}
        for item, low, high in regions:
            wanted, errors = self.items[item], self.errors[item]
            distance, end = best_match(wanted, words[low:high])
            if distance <= errors and (item not in best or distance < best[item][0]):
                # the same search backwards from the end finds the start
                tail = words[max(0, low + end - len(wanted) - errors) : low + end][::-1]
                best[item] = (distance, low + end - self._length(wanted[::-1], tail, distance), low + end)
        return [(item, *found) for item, found in sorted(best.items())]

    @staticmethod
    def _length(item: list[int], text: list[int], distance: int) -> int:
        """Length of the shortest prefix of ``text`` at ``distance`` from ``item``."""
        column = list(range(len(item) + 1))
        for at, w in enumerate(text, 1):
            diagonal, column[0] = column[0], at
            for i, x in enumerate(item, 1):
                diagonal, column[i] = column[i], min(diagonal + (x != w), column[i] + 1, column[i - 1] + 1)
            if column[-1] == distance:
                return at
        return len(text)


def blocks_of(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items, streamed in blocks."""
    block, size = [], 0
    for row in items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).toLocalIterator():
        block.append((row["id"], row["text"]))
        size += len(row["text"] or "")
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
    error_rate: float = 0.2, min_words: int = 1, block_chars: int = 4 << 20,
) -> DataFrame:
    """(id, item, distance, first_word, end_word): the best match of every item in every document that holds it."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, item long, distance int, first_word int, end_word int"
    names = ["id", "item", "distance", "first_word", "end_word"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    results = []
    for block in blocks_of(items, item_col, text_col, block_chars):
        shared = spark.sparkContext.broadcast(Items(block, error_rate, min_words))

        def work(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            known = shared.value
            found = [
                (key, known.ids[item], *rest)
                for key, text in zip(batch.column("id").to_pylist(), texts_of(batch)) for item, *rest in known.matches(text)
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * 5, kinds)], names)

        results.append(rows.mapInArrow(per_batch(work), schema))
    if not results:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, results)


def keep_clean(
    docs: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text",
    error_rate: float = 0.2, min_words: int = 1, block_chars: int = 4 << 20,
) -> DataFrame:
    """The rows of ``docs`` that hold no item, unchanged."""
    for block in blocks_of(items, item_col, text_col, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(Items(block, error_rate, min_words))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part in (part for whole in batches for part in parts(whole)):
                kept = part.filter(pa.array([not shared.value.matches(t) for t in texts_of(part, text_col)], pa.bool_()))
                if kept.num_rows:
                    yield kept

        docs = docs.mapInArrow(work, docs.schema)
    return docs
