"""Repeated word runs across a corpus, by recompression.

**Naming.** Runs of one word, then pairs, get names in rounds. In each round every symbol falls left or right by a bit of its
name; a left symbol followed by a right one becomes one symbol, whose name is a hash of both names. A name depends on
content alone, so all tasks give equal substrings the same names without exchanging tables. What a symbol rests on is
tracked: a pair rests on its parts, an unpaired symbol also on the neighbour that it was not paired with, a run of words
on the words next to it. A window of ``length`` words determines the symbols that rest on its words alone.

**Sharing.** Every window is represented by a symbol of the highest level on which it determines any: the one whose name has the
smallest hash. Equal windows have
the same representative at the same place. Consecutive windows with one representative form a stretch. Stretches are
dealt by the name of the representative: where a whole stretch occurs again, all its windows are repeated; where different
stretches share a name, their windows are compared one by one, by 128-bit hashes of the words; others are unique. Most stretches
have a name of their own and end there.

**Memory.** Both comparisons stream over sorted rows: a task holds one row of the current name. Longer groups only make longer
streams. Documents meet their own repeated intervals in a join.

Words are runs of bytes other than ASCII white space. Rows are told apart by a hash of id and text; repeated rows repeat each
other. Null texts have no words and no windows. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import parts, per_batch, stage, texts_of

LENGTH = 35
ROUNDS = 6  # fewer make names of common word pairs that say little, more leave few windows to a symbol
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first hash, second hash of the words of all texts, words per text); hashing a word costs less than finding it among known ones"""
    split = [t.encode("utf-8", "replace").split() for t in texts]
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, chain.from_iterable(split))), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy(), np.array([len(own) for own in split], np.int64)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, count) of all entries of a column of lists, and how many each row has; a null list has none."""
    flat = column.flatten()
    at, count = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "count"))
    return at, count, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _mix(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    x = a * np.uint64(0xBF58476D1CE4E5B9) + (b << np.uint64(31) | b >> np.uint64(33)) * np.uint64(0x94D049BB133111EB) + np.uint64(salt)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


class RollingHash:
    """Hashes of word ranges from prefix sums; equal ranges have equal hashes wherever they are."""

    def __init__(self, values: np.ndarray):
        powers, back = np.full(len(values) + 1, BASE), np.full(len(values) + 1, INVERSE)
        powers[0] = back[0] = 1
        self.back = np.cumprod(back)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * np.cumprod(powers)[:-1])))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.back[start]


class Level:
    """Symbols in order: name, first word, and the words [low, high) that each rests on."""

    def __init__(self, name, start, low, high, opens):
        self.name, self.start, self.low, self.high = name, start, low, high
        self.opens = opens  # first of its text


def word_runs(names: np.ndarray, first: np.ndarray, ends: np.ndarray) -> Level:
    """Runs of one word as symbols; ``first`` marks the words that open texts, ``ends`` is the end of each word's text."""
    n = len(names)
    new = first.copy()
    new[1:] |= names[1:] != names[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    name = np.where(size > 1, _mix(names[start], size.astype(np.uint64), 1), names[start])
    stop = start + size
    # a run rests on the words around it, even where the text ends: elsewhere it may go on
    return Level(name, start, start - 1, stop + 1, first[start])


def pair_up(level: Level, salt: int) -> Level:
    """The next level: left symbols joined with right ones that follow them."""
    n = len(level.name)
    right = (_mix(level.name, level.name, salt) >> np.uint64(63)).astype(bool)
    inner = ~level.opens
    joins = np.zeros(n, bool)  # with the symbol after it
    joins[:-1] = ~right[:-1] & right[1:] & inner[1:]
    joined = np.concatenate(([False], joins[:-1]))
    after = np.append(np.arange(1, n), n - 1)
    name = level.name.copy()
    at = np.flatnonzero(joins)
    name[at] = _mix(level.name[at], level.name[at + 1], salt + 1)
    low, high = level.low.copy(), level.high.copy()
    high[at] = level.high[at + 1]
    alone = ~joins & ~joined
    # a lone right symbol rests on the symbol before it, a lone left one on the symbol after it
    back = np.flatnonzero(alone & right & inner)
    low[back] = level.low[back - 1]
    closes = np.append(level.opens[1:], True)
    ahead = np.flatnonzero(alone & ~right & ~closes)
    high[ahead] = level.high[after[ahead]]
    # without a neighbour it rests on what is not there
    edge = np.flatnonzero(alone & right & level.opens)
    low[edge] = level.start[edge] - 1
    edge = np.flatnonzero(alone & ~right & closes)
    high[edge] += 1 << 40
    kept = ~joined
    high = np.maximum.accumulate(np.where(high >= 1 << 40, _next_text(level, high), high))
    return Level(name[kept], level.start[kept], low[kept], high[kept], level.opens[kept])


def _next_text(level: Level, high: np.ndarray) -> np.ndarray:
    """One word past the end of each symbol's text."""
    opens = np.flatnonzero(level.opens)
    text = np.cumsum(level.opens) - 1
    past = np.append(level.start[opens[1:]], level.high[-1] + (1 << 20))
    return past[text] + 1


def range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place of the smallest of ``values[first .. last]`` for each range, the first of equals."""
    if not len(first):
        return first
    depth = int((last - first + 1).max()).bit_length() - 1
    tables = [np.arange(len(values))]
    for k in range(depth):
        a, b = tables[-1][: -(1 << k)], tables[-1][1 << k :]
        tables.append(np.where(values[a] <= values[b], a, b))
    power = np.frexp((last - first + 1).astype(float))[1] - 1
    out = np.empty(len(first), np.int64)
    for k, table in enumerate(tables):
        at = np.flatnonzero(power == k)
        a, b = table[first[at]], table[last[at] - (1 << k) + 1]
        out[at] = np.where(values[a] <= values[b], a, b)
    return out


def stretches(names: np.ndarray, second: np.ndarray, sizes: np.ndarray, length: int):
    """(text, first window, windows, name, content) of every stretch."""
    empty = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    if not (sizes >= length).any():
        return empty
    ends = np.cumsum(sizes)
    starts = ends - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    first = np.zeros(len(names), bool)
    first[starts[sizes > 0]] = True
    levels = [Level(names, np.arange(len(names)), np.arange(len(names)), np.arange(1, len(names) + 1), first)]
    levels.append(word_runs(names, first, ends[text]))
    for r in range(ROUNDS):
        levels.append(pair_up(levels[-1], 1000 + 2 * r))
    window = np.flatnonzero(np.arange(len(names)) + length <= ends[text])
    symbol = np.full(len(names), -1, np.int64)
    name = np.zeros(len(names), np.uint64)
    place = np.zeros(len(names), np.int64)
    left, offset = window, 0
    for level in levels[::-1]:
        lowest = np.searchsorted(level.low, left)
        highest = np.searchsorted(level.high, left + length, "right") - 1
        fits = lowest <= highest
        own, chosen = left[fits], range_minima(_mix(level.name, level.name, 7), lowest[fits], highest[fits])
        symbol[own], name[own], place[own] = chosen + offset, level.name[chosen], level.start[chosen]
        offset += len(level.low)
        left = left[~fits]
    new = np.ones(len(window), bool)
    new[1:] = (symbol[window[1:]] != symbol[window[:-1]]) | (window[1:] != window[:-1] + 1)
    at = np.flatnonzero(new)
    low = window[at]
    count = np.diff(np.append(at, len(window)))
    content = _mix(RollingHash(second).of(low, low + count - 1 + length), (place[low] - low).astype(np.uint64) << np.uint64(32) | count.astype(np.uint64), 5)
    return text[low], low - starts[text[low]], count, name[low], content


def _keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, key): the key is a hash of both."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.withColumn("key", F.xxhash64("id", "text"))


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with the text as compressed bytes, for the shuffle by key."""
    others = [c for c in docs.columns if c != "text"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=3).compress
        texts = pa.array([pack(t.encode("utf-8", "replace")) for t in texts_of(batch)], pa.binary())
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), texts], [*others, "packed"])

    return docs.select(*others, "text").mapInArrow(per_batch(work), ", ".join(f"{c} long" for c in others) + ", packed binary")


def _unpacked(batch: pa.RecordBatch) -> list[str]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(b).decode("utf-8") for b in batch.column("packed").to_pylist()]


def sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``_find`` gives, of rows in the order of (a, b)."""
    last = held = first = None  # the last (a, b); its row and the first row of a: each None once it was given out
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        a, b, key, at, count = (batch.column(c).to_numpy() for c in ("a", "b", "key", "at", "count"))
        row = lambda i: (key[i], at[i], count[i])  # noqa: E731, B023
        same_a, same = np.empty(n, bool), np.empty(n, bool)
        same_a[1:] = a[1:] == a[:-1]
        same[1:] = same_a[1:] & (b[1:] == b[:-1])
        same_a[0] = last is not None and a[0] == last[0]
        same[0] = same_a[0] and b[0] == last[1]
        again = same | np.append(same[1:], False)
        other = same_a & ~same  # the first row of a further b
        group = np.cumsum(~same_a)  # 0: goes on from the last batch
        several = np.bincount(group[other], minlength=group[-1] + 1) > 0
        opens = np.flatnonzero(~same_a)
        other[opens] = several[1:]
        carried = [(*held, 1)] if same[0] and held is not None else []
        if several[0] and first is not None:
            carried.append((*first, 2))
        if several[-1]:
            first = None
        elif len(opens):
            first = row(opens[-1])
        last, held = (a[-1], b[-1]), None if again[-1] else row(n - 1)
        ones, twos = np.flatnonzero(again), np.flatnonzero(other)
        if len(carried) + len(ones) + len(twos):
            kinds = np.repeat([1, 2], [len(ones), len(twos)])
            chosen = np.concatenate((ones, twos))
            columns = zip((key[chosen], at[chosen], count[chosen], kinds), (np.int64, np.int32, np.int32, np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((np.array([c[k] for c in carried], kind), x.astype(kind)))) for k, (x, kind) in enumerate(columns)],
                ["key", "at", "count", "kind"],
            )


def _find(rows: DataFrame) -> DataFrame:
    """(key, at, count, kind) of rows (a, b, key, at, count) that share: kind 1 where (a, b) occurs again, 2 for one row of each (a, b)
    where ``a`` occurs with several ``b``."""
    return rows.repartition("a").sortWithinPartitions("a", "b").mapInArrow(sharing, "key long, at int, count int, kind int")


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, at, count): windows at, at + 1, ..., at + count - 1 of document ``key`` that occur elsewhere; docs as from ``_keys``."""

    def stretch(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, at, count, name, content = stretches(*word_hashes(texts_of(batch)), length)
        key = batch.column("key").to_numpy()[text]
        columns = [name.view(np.int64), content.view(np.int64), key, at.astype(np.int32), count.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "key", "at", "count"])

    schema = "a long, b long, key long, at int, count int"
    found = stage(_find(docs.select("key", "text").mapInArrow(per_batch(stretch), schema)), "stretches")

    def single(batch: pa.RecordBatch) -> pa.RecordBatch:
        one, two, sizes = word_hashes(_unpacked(batch))
        starts = np.cumsum(sizes) - sizes
        low, count, n_open = _lists(batch.column("open"))
        at = np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count)
        each = np.bincount(np.repeat(np.arange(len(n_open)), n_open), count, len(n_open)).astype(np.int64)
        first = at + np.repeat(starts, each)
        columns = [
            RollingHash(two).of(first, first + length).view(np.int64), RollingHash(one).of(first, first + length).view(np.int64),
            np.repeat(batch.column("key").to_numpy(), each), at.astype(np.int32), np.ones(len(at), np.int32),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "key", "at", "count"])

    # copies of a row share a key and name the same stretches: a set takes each once, before the shuffle already
    opened = found.filter("kind = 2").groupBy("key").agg(F.collect_set(F.struct("at", "count")).alias("open"))
    windows = _packed(docs.select("key", "text")).join(opened, "key").select("key", "packed", "open")
    singles = _find(windows.mapInArrow(per_batch(single), schema)).filter("kind = 1")
    return found.filter("kind = 1").select("key", "at", "count").unionByName(singles.select("key", "at", "count"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_words, n_removed, kept): what is left of each text when all words of repeated windows go, joined by spaces."""
    rows = _keys(docs, id_col, text_col)
    marked = repeated_windows(rows, length).groupBy("key").agg(F.collect_set(F.struct("at", "count")).alias("repeats"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, words, removed = [], [], []
        low, count, n_repeats = _lists(batch.column("repeats"))
        high = low + count - 1 + length
        ends = np.cumsum(n_repeats).tolist()
        for text, i, j in zip(_unpacked(batch), [0, *ends], ends):
            own = text.encode("utf-8", "replace").split()
            size = len(own) + 1
            change = np.bincount(low[i:j], minlength=size) - np.bincount(high[i:j], minlength=size)
            stays = np.cumsum(change[:-1]) == 0
            kept.append(b" ".join(compress(own, stays.tolist())))
            words.append(len(own))
            removed.append(len(own) - int(stays.sum()))
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
            ["id", "n_words", "n_removed", "kept"],
        )

    joined = _packed(rows.select("id", "key", "text")).join(marked, "key", "left").select("id", "packed", "repeats")
    return joined.mapInArrow(per_batch(work), "id long, n_words long, n_removed long, kept binary")
