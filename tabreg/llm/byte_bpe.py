"""Byte-level BPE without regular expressions.

**Pre-tokenisation.** Texts of a batch become one array of code points; a table gives each its class
(letter, number, white space, other). Which apostrophes open a contraction depends on all that came
before, so it is read off a scan: every character is a function on four states (free, one or two
characters of a contraction left, inside a run that an apostrophe cannot leave), packed into a
byte. Composition is a table look-up and associative, so prefixes are composed in blocks: all blocks side by side,
their totals by the same scan, then one application. Boundaries follow from classes and states by array logic.

**Merging.** Slices between boundaries go through a bounded cache of merged pieces. The new pieces of a batch are merged side by
side: as rows of an array, of which each round merges every row's best pair. A very long piece is merged
by itself, by rank with a heap, so it costs n log n.

The split is the usual one of byte-level vocabularies: contractions 's 't 're 've 'm 'll 'd, then
runs of letters, numbers or others with one optional space before, then white space, of which the last
character before a word is left to it.

Null texts count as empty and have no ids. Rows keep their ids, repeated or null; extra columns are ignored. All
work is done row by row in map tasks: no shuffle, and memory holds one batch of texts.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import per_batch, texts_of

OTHER, LETTER, NUMBER, SPACE, BREAK = range(5)
FREE, ONE_LEFT, TWO_LEFT, HELD = range(4)
#: White space of the split beyond ASCII (fixed values: Unicode's White_Space property).
WIDE_SPACES = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Letters and numbers of Unicode 16, which Python 3.13's tables (15.1) lack (fixed values: code point ranges).
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
CHARS_AT_ONCE = 1 << 20
CACHED_PIECES = 1 << 17
SHORT, NO_RANK = 48, 1 << 62
ROW_SIZES, ROWS_AT_ONCE, NO_PAIR = (4, 6, 8, 10, 12, 16, 24, SHORT), 4096, (1 << 31) - 1


def _function(*after: int) -> int:
    """The byte of a function on the four states, given its values."""
    return sum(state << 2 * at for at, state in enumerate(after))


#                        from   free      one   two       held
PLAIN = _function(FREE, FREE, ONE_LEFT, FREE)
HOLDS = _function(HELD, FREE, ONE_LEFT, HELD)
OPENS_TWO = _function(ONE_LEFT, FREE, ONE_LEFT, HELD)
OPENS_THREE = _function(TWO_LEFT, FREE, ONE_LEFT, HELD)
RESET = _function(FREE, FREE, FREE, FREE)
SAME = _function(FREE, ONE_LEFT, TWO_LEFT, HELD)


@lru_cache
def classes() -> np.ndarray:
    """Class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        initial = unicodedata.category(chr(code))[0]
        if initial in "LN":
            table[code] = LETTER if initial == "L" else NUMBER
    for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
        for first, last in ranges:
            table[first : last + 1] = kind
    table[[0x20, *range(0x09, 0x0E), *WIDE_SPACES]] = SPACE
    return table


@lru_cache
def compositions() -> np.ndarray:
    """At ``first << 8 | second``: the function that applies ``first``, then ``second``."""
    first, second = np.divmod(np.arange(1 << 16), 256)
    out = np.zeros(1 << 16, np.int64)
    for state in range(4):
        middle = first >> 2 * state & 3
        out |= (second >> 2 * middle & 3) << 2 * state
    return out.astype(np.uint8)


def prefix_functions(steps: np.ndarray, block: int | None = None) -> np.ndarray:
    """Inclusive scan of ``steps`` under composition, in blocks of about the root of their number."""
    table = compositions()
    n = len(steps)
    if block is None:
        block = min(128, max(16, int(n**0.5)))
    if n <= block:
        out = steps.copy()
        for i in range(1, n):
            out[i] = table[int(out[i - 1]) << 8 | int(out[i])]
        return out
    rows = -(-n // block)
    padded = np.full(rows * block, SAME, np.uint8)
    padded[:n] = steps
    side = np.ascontiguousarray(padded.reshape(rows, block).T)
    for i in range(1, block):
        side[i] = table[side[i - 1].astype(np.uint16) << 8 | side[i]]
    before = np.concatenate(([SAME], prefix_functions(side[-1], block)[:-1])).astype(np.uint16) << 8
    return np.ascontiguousarray(table[before | side].T).ravel()[:n]


def piece_starts(text: str, breaks: np.ndarray) -> np.ndarray:
    """Where pieces start in ``text``, whose characters at ``breaks`` stand between documents."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = classes()[code]
    kind[breaks] = BREAK
    space = (code == 0x20) & (kind == SPACE)
    n = len(code)
    following = np.full(n + 2, BREAK, np.uint32)
    following[:n] = np.where(kind == BREAK, 0, code)
    one, two = following[1 : n + 1], following[2 : n + 2]
    letter = {x: ord(x) for x in "stmdrvle"}
    quote = code == ord("'")
    short = quote & ((one == letter["s"]) | (one == letter["t"]) | (one == letter["m"]) | (one == letter["d"]))
    long = quote & (((one == letter["r"]) & (two == letter["e"])) | ((one == letter["v"]) & (two == letter["e"]))
                    | ((one == letter["l"]) & (two == letter["l"])))
    step = np.full(n, PLAIN, np.uint8)
    step[space | (kind == OTHER)] = HOLDS
    step[short], step[long], step[kind == BREAK] = OPENS_TWO, OPENS_THREE, RESET
    after = prefix_functions(step) & 3  # the value at state free, where every text starts
    state = np.concatenate(([FREE], after[:-1]))
    left = np.concatenate(([BREAK], kind[:-1]))
    right = np.concatenate((kind[1:], [BREAK]))
    glued = np.concatenate(([False], space[:-1]))
    closed = np.concatenate(([False], state[:-1] == ONE_LEFT))
    white = kind == SPACE
    start = np.where(white, (left != SPACE) | ((right != SPACE) & (right != BREAK)), (left != kind) & ~glued)
    start |= closed
    start &= (state != ONE_LEFT) & (state != TWO_LEFT)
    return np.flatnonzero(start & (kind != BREAK))


def pieces(texts: list[str]) -> list[list[str]]:
    """The pieces of each text."""
    joined = "\n".join(texts)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    if not joined:
        return [[] for _ in texts]
    starts = piece_starts(joined, ends[:-1])
    cuts = np.searchsorted(starts, ends, "left").tolist()
    starts, out, at = starts.tolist(), [], 0
    for cut, end in zip(cuts, ends.tolist()):
        own = starts[at:cut]
        out.append([joined[a:b] for a, b in zip(own, own[1:] + [end])] if own else [])
        at = cut
    return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the lowest-ranked pair of neighbours first, the leftmost of equals."""
    rank_of = ranks.get
    if (whole := rank_of(piece)) is not None:
        return [whole]
    n = len(piece)
    if n <= SHORT:
        # few pairs: looking at all of them beats a heap
        part = [piece[i : i + 1] for i in range(n)]
        pair = [rank_of(piece[i : i + 2], NO_RANK) for i in range(n - 1)]
        while pair and (lowest := min(pair)) != NO_RANK:
            i = pair.index(lowest)
            part[i] = merged = part[i] + part.pop(i + 1)
            del pair[i]
            if i:
                pair[i - 1] = rank_of(part[i - 1] + merged, NO_RANK)
            if i < len(pair):
                pair[i] = rank_of(merged + part[i + 1], NO_RANK)
        return [ranks[x] for x in part]
    stop, prior = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = stop[i]
        if not alive[i] or middle >= n or not alive[middle] or stop[middle] != end:
            continue
        alive[middle] = False
        stop[i] = end
        if end < n:
            prior[end] = i
            if (rank := ranks.get(piece[i : stop[end]])) is not None:
                heapq.heappush(heap, (rank, i, stop[end]))
        if (j := prior[i]) >= 0 and (rank := ranks.get(piece[j:end])) is not None:
            heapq.heappush(heap, (rank, j, end))
    return [ranks[piece[i : stop[i]]] for i in range(n) if alive[i]]


class Pairs:
    """Pairs of tokens that merge, by their ids; ``complete`` where every single byte is a token, so that ids stand for all parts."""

    def __init__(self, ranks: dict[bytes, int]):
        rank_of = ranks.get
        self.single = np.array([rank_of(bytes([b]), -1) for b in range(256)], np.int64)
        self.complete = bool((self.single >= 0).all())
        self.none = max(ranks.values(), default=-1) + 1  # the id of no token
        found = {
            a * (self.none + 1) + b: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if (a := rank_of(token[:i])) is not None and (b := rank_of(token[i:])) is not None
        }
        keys = np.fromiter(found.keys(), np.int64, len(found))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.fromiter(found.values(), np.int64, len(found))[order], NO_PAIR).astype(np.int32)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, which is the id of the merged token, or ``NO_PAIR``."""
        keys = a * np.int64(self.none + 1) + b
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_PAIR)


def merge_rows(some: list[bytes], pairs: Pairs, size: int) -> list[bytes]:
    """Ids of pieces of up to ``size`` bytes, little-endian: what ``merge`` gives for each, one merge of all of them a round."""
    n, wide = len(some), size + 2  # a place before and one after each piece hold no token
    lengths = np.fromiter(map(len, some), np.int64, n)
    text = np.frombuffer(b"".join([x.ljust(size, b"\0") for x in some]), np.uint8).reshape(n, size)
    alive = np.zeros((n, wide), bool)
    alive[:, 1:-1] = np.arange(size) < lengths[:, None]
    ids = np.full((n, wide), pairs.none, np.int64)
    ids[:, 1:-1] = np.where(alive[:, 1:-1], pairs.single[text], pairs.none)
    rank = np.full((n, wide), NO_PAIR, np.int32)
    rank[:, 1:-1] = pairs.of(ids[:, 1:-1], ids[:, 2:])
    after, before = (np.tile(np.arange(wide) + step, (n, 1)) for step in (1, -1))
    flat_ids, flat_rank, flat_after, flat_before, flat_alive = (x.reshape(-1) for x in (ids, rank, after, before, alive))
    rows = np.arange(n)
    while len(rows):
        at = rank[rows].argmin(axis=1)  # the leftmost of equals
        best = rank[rows, at]
        goes_on = best != NO_PAIR
        rows, at, best = rows[goes_on], at[goes_on], best[goes_on].astype(np.int64)
        base = rows * wide
        here, right = base + at, base + flat_after[base + at]
        following, prior = base + flat_after[right], base + flat_before[here]
        flat_ids[here], flat_rank[right], flat_alive[right] = best, NO_PAIR, False
        flat_after[here], flat_before[following] = following - base, at
        flat_rank[here] = pairs.of(best, flat_ids[following])
        flat_rank[prior] = pairs.of(flat_ids[prior], best)
    out = ids[alive].astype("<i4").tobytes()
    ends = (4 * np.cumsum(alive.sum(axis=1))).tolist()
    return [out[a:b] for a, b in zip([0, *ends], ends)]


class Codec(dict):
    """Merged pieces by text, as little-endian 32-bit ids. When full, pieces that are not asked for again are forgotten."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.old: dict[str, bytes] = {}
        self.vocabulary: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.vocabulary[rank] = token
        self.lengths = np.array([len(t) for t in self.vocabulary], np.int64)
        self.pairs = Pairs(ranks)

    def learn(self, wanted: Iterable[str]) -> None:
        """Merges those of the wanted pieces that are new, together; long ones are left to be merged when they are asked for."""
        missing = set(wanted).difference(self)
        if not missing or not self.pairs.complete:
            return
        if len(self) + len(missing) > CACHED_PIECES:
            self.old = dict(self)
            self.clear()
        by_size: list[list[tuple[str, bytes]]] = [[] for _ in ROW_SIZES]
        for piece in missing:
            if (ids := self.old.get(piece)) is not None:
                self[piece] = ids
                continue
            plain = piece.encode("utf-8", "replace")
            if (whole := self.ranks.get(plain)) is not None:
                self[piece] = whole.to_bytes(4, "little")
            elif len(plain) <= SHORT:
                by_size[bisect_left(ROW_SIZES, len(plain))].append((piece, plain))
        for size, own in zip(ROW_SIZES, by_size):
            for at in range(0, len(own), ROWS_AT_ONCE):
                some = own[at : at + ROWS_AT_ONCE]
                self.update(zip([piece for piece, _ in some], merge_rows([plain for _, plain in some], self.pairs, size)))

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(merge(piece.encode("utf-8", "replace"), self.ranks), "<i4").tobytes()
        if len(piece) <= 64:
            if len(self) >= CACHED_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= CHARS_AT_ONCE):
                size += len(texts[stop])
                stop += 1
            split = pieces(texts[at:stop])
            self.learn(chain.from_iterable(split))
            for own in split:
                out.append(np.frombuffer(b"".join(map(self.__getitem__, own)), "<i4"))
            at = stop
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(rank_lines: bytes) -> Codec:
    return Codec({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_lines.splitlines())})


def _encoder(docs: DataFrame, ranks_path: str, checked: bool):
    """The task function; the rank file (bounded by its vocabulary) is read once and sent to the tasks."""
    with open(ranks_path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, texts = codec(ranks.value), texts_of(batch)
        ids = own.encode(texts)
        offsets = pa.array(np.cumsum([0, *map(len, ids)]).astype(np.int32))
        columns = [batch.column("id"), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32()))]
        if checked:
            columns.append(pa.array([own.decode(x) == t.encode("utf-8", "replace") for x, t in zip(ids, texts)]))
        else:
            ends = np.concatenate([np.cumsum(own.lengths[x]) for x in ids]).astype(np.int64)
            columns.append(pa.ListArray.from_arrays(offsets, pa.array(ends, pa.int64())))
        return pa.RecordBatch.from_arrays(columns, ["id", "ids", "round_trip" if checked else "ends"])

    return per_batch(work)


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, ends): token ids of each text, and where each token ends in the text's UTF-8 bytes."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encoder(docs, ranks_path, False), "id long, ids array<int>, ends array<long>")


def encode_checked(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, round_trip): token ids of each text, and whether they decode to its UTF-8 bytes."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encoder(docs, ranks_path, True), "id long, ids array<int>, round_trip boolean")


def decode(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """(id, ids, decoded): the bytes that each row's ids stand for."""
    with open(ranks_path, "rb") as file:
        ranks = tokens.sparkSession.sparkContext.broadcast(file.read())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(ranks.value)
        lists = batch.column("ids")
        flat, bounds = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy()))).tolist()
        decoded = pa.array([own.decode(flat[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("id"), lists, decoded], ["id", "ids", "decoded"])

    return tokens.select("id", "ids").mapInArrow(per_batch(work), "id long, ids array<int>, decoded binary")
