"""Token counts that follow edits, without encoding whole texts again.

Each document keeps its pre-token pieces in leaves of up to 64, and two segment trees of sums over the leaves: characters and
tokens (``DocumentTree``). An edit replaces ``removed`` characters at ``at`` by ``inserted``. The leaf is found by
descending the character sums. Splitting starts at the last boundary that the edit cannot move (a piece
depends on up to two characters after it) and ends where a new boundary falls on an old one behind the edit, as
splitting looks at nothing before a boundary. Only the pieces in between are encoded; the leaf is replaced, and the
sums on its paths follow. Edits of different documents run side by side, so that their stretches are split in one call.

A tree is stored as a row (id, text, sizes and token counts of the pieces, total). ``apply_edits`` takes edits as a table, shuffled and
sorted with the trees, and streams them: a task holds the trees of one id, however many edits they have.
``apply_edit_lists`` takes the edits of a row from its own column and needs no shuffle.

A null text counts as empty. Positions are clipped to the text; a null position is 0, a null insertion empty, a null or
negative removal 0. Edits of unknown documents change nothing; rows that share an id (null is an id like any
other) each take all its edits. Edits with equal order are applied by position, removal and insertion. Empty
tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .byte_bpe import CHARS_AT_ONCE, Codec, codec, pieces
from .common import parts, per_batch, texts_of

LEAF = 64
LOOKS_AHEAD = 2
NAMES = ["id", "text", "sizes", "counts", "n_tokens", "n_encoded"]
TREE = "id long, text string, sizes array<int>, counts array<int>, n_tokens long, n_encoded long"
EDITS = "array<struct<at:int,removed:int,inserted:string>>"


class SumTree:
    """Sums over leaves: a segment tree in an array, the root at 1."""

    def __init__(self, values: list[int]):
        self.width = 1 << max(0, (len(values) - 1).bit_length())
        self.sums = [0] * (2 * self.width)
        self.sums[self.width : self.width + len(values)] = values
        for node in range(self.width - 1, 0, -1):
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def total(self) -> int:
        return self.sums[1]

    def put(self, leaf: int, value: int) -> None:
        node = leaf + self.width
        change = value - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def find(self, place: int) -> tuple[int, int]:
        """(leaf that holds ``place``, sum before it); the last leaf with anything where place is the end."""
        if not self.sums[1]:
            return 0, 0
        place = min(place, self.sums[1] - 1)
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if place - before >= self.sums[node]:
                before += self.sums[node]
                node += 1
        return node - self.width, before


class DocumentTree:
    """Pieces of one document in leaves: text, piece sizes and token counts of each, and trees of their sums."""

    def __init__(self, own: Codec, text: str, sizes: np.ndarray, counts: np.ndarray):
        self.own = own
        self.n_encoded = 0  # pieces encoded for edits
        self._lay_out(text, sizes, counts)

    @classmethod
    def of(cls, own: Codec, text: str, split: list[str]) -> DocumentTree:
        return cls(own, text, *_measure(own, split))

    def _lay_out(self, text: str, sizes: np.ndarray, counts: np.ndarray) -> None:
        cuts = range(0, max(1, len(sizes)), LEAF)
        self.sizes = [sizes[i : i + LEAF] for i in cuts]
        self.counts = [counts[i : i + LEAF] for i in cuts]
        chars, tokens = (np.add.reduceat(x, cuts).tolist() if len(x) else [0] for x in (sizes, counts))
        ends = [0, *accumulate(chars)]
        self.texts = [text[i:j] for i, j in zip(ends, ends[1:])]
        self.chars, self.tokens = SumTree(chars), SumTree(tokens)

    def state(self) -> tuple[str, np.ndarray, np.ndarray]:
        return "".join(self.texts), np.concatenate(self.sizes), np.concatenate(self.counts)

    def _set(self, leaf: int, text: str, sizes: np.ndarray, counts: np.ndarray) -> None:
        self.texts[leaf], self.sizes[leaf], self.counts[leaf] = text, sizes, counts
        self.chars.put(leaf, len(text))
        self.tokens.put(leaf, int(counts.sum()))

    def edit(self, at: int, removed: int, inserted: str) -> None:
        in_step([self.editing(at, removed, inserted)])

    def editing(self, at: int, removed: int, inserted: str) -> Iterator[str]:
        """The edit, as a generator that gives texts to be split and is sent their pieces."""
        total = self.chars.total()
        at = min(max(0, at), total)
        stop = min(total, at + max(0, removed))
        if at == stop and not inserted:
            return
        safe = max(0, at - LOOKS_AHEAD)
        first, before = self.chars.find(safe)
        bounds = before + np.concatenate(([0], np.cumsum(self.sizes[first])))
        stay = int(np.searchsorted(bounds, safe, "right")) - 1
        start = int(bounds[stay])
        last, reach = first, before + len(self.texts[first])
        while True:
            while reach < stop:
                last += 1
                reach += len(self.texts[last])
            old = "".join(self.texts[first : last + 1])
            window = old[start - before : at - before] + inserted + old[stop - before :]
            split = yield window
            new_bounds = start + np.concatenate(([0], np.cumsum([len(p) for p in split], dtype=np.int64)))
            sizes = np.concatenate(self.sizes[first : last + 1])
            counts = np.concatenate(self.counts[first : last + 1])
            old_bounds = before + np.concatenate(([0], np.cumsum(sizes)))
            shift = len(inserted) - (stop - at)
            # old boundaries behind the edit, where they are now; the end of the window is certain only at the end of the text
            later = old_bounds[old_bounds >= stop] + shift
            limit = start + len(window) - (LOOKS_AHEAD if reach < total else 0)
            sure = new_bounds[: np.searchsorted(new_bounds, limit, "right")]
            at_most = np.minimum(np.searchsorted(later, sure), len(later) - 1)
            met = sure[later[at_most] == sure] if len(later) else later
            if len(met):
                break
            last += 1
            reach += len(self.texts[last])
        n_new = int(np.searchsorted(new_bounds, met[0]))
        n_old = int(np.searchsorted(old_bounds, met[0] - shift))
        fresh, fresh_counts = _measure(self.own, split[:n_new])
        self.n_encoded += n_new
        text = old[: start - before] + window[: int(met[0]) - start] + old[int(met[0]) - shift - before :]
        self._set(
            first, text, np.concatenate((sizes[:stay], fresh, sizes[n_old:])),
            np.concatenate((counts[:stay], fresh_counts, counts[n_old:])),
        )
        nothing = np.empty(0, np.int64)
        for leaf in range(first + 1, last + 1):
            self._set(leaf, "", nothing, nothing)
        if len(self.sizes[first]) > 4 * LEAF:
            self._lay_out(*self.state())


def in_step(edits: list[Iterator[str]]) -> None:
    """Runs edits of different documents side by side: what they want split next is split together, up to ``CHARS_AT_ONCE`` at a time."""
    wanted = [(e, w) for e in edits if (w := next(e, None)) is not None]
    while wanted:
        following, at = [], 0
        while at < len(wanted):
            stop, size = at, 0
            while stop < len(wanted) and (stop == at or size + len(wanted[stop][1]) <= CHARS_AT_ONCE):
                size += len(wanted[stop][1])
                stop += 1
            for (edit, _), split in zip(wanted[at:stop], pieces([w for _, w in wanted[at:stop]])):
                try:
                    following.append((edit, edit.send(split)))
                except StopIteration:
                    pass
            at = stop
        wanted = following


def _one_by_one(tree: DocumentTree, edits: list[dict | None] | None) -> Iterator[str]:
    """All edits of one document, in their order."""
    for e in edits or ():
        if e is not None:
            yield from tree.editing(e["at"] or 0, e["removed"] or 0, e["inserted"] or "")


def _measure(own: Codec, split: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(characters, tokens) of each piece."""
    n = len(split)
    return np.fromiter(map(len, split), np.int64, n), np.fromiter(map(len, map(own.__getitem__, split)), np.int64, n) // 4


def _rows(ids: list, trees: list[DocumentTree]) -> pa.RecordBatch:
    states = [t.state() for t in trees]
    offsets = pa.array(np.cumsum([0, *(len(s[1]) for s in states)]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([s[k] for s in states] or [np.empty(0)]).astype(np.int32))) for k in (1, 2)]
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([s[0] for s in states], pa.string()), *lists,
        pa.array([t.tokens.total() for t in trees], pa.int64()), pa.array([t.n_encoded for t in trees], pa.int64()),
    ], NAMES)


def _restored(own: Codec, batch: pa.RecordBatch) -> list[DocumentTree]:
    lists = [batch.column(c) for c in ("sizes", "counts")]
    sizes, counts = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
    ends = np.cumsum([0, *lists[0].value_lengths().fill_null(0).to_pylist()]).tolist()
    return [DocumentTree(own, t, sizes[i:j], counts[i:j]) for t, i, j in zip(texts_of(batch), ends, ends[1:])]


def build_trees(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: the pieces of its text, their tokens, the total; columns in ``keep`` come along."""
    with open(ranks_path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, texts = codec(ranks.value), texts_of(batch)
        split = pieces(texts)
        own.learn(chain.from_iterable(split))
        out = _rows(batch.column("id").to_pylist(), [DocumentTree.of(own, t, s) for t, s in zip(texts, split)])
        return pa.RecordBatch.from_arrays([*out.columns, *(batch.column(c) for c in keep)], NAMES + list(keep))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *keep)
    return rows.mapInArrow(per_batch(work), TREE + _more(rows, 2))


def _more(rows: DataFrame, own: int) -> str:
    """Types of the columns after the first ``own``."""
    return "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[own:])


def apply_edit_lists(trees: DataFrame, ranks_path: str, edits_col: str = "edits", keep: tuple[str, ...] = ()) -> DataFrame:
    """The trees after the edits in each row's own ``edits_col``, a list of (at, removed, inserted); ``keep`` comes along."""
    with open(ranks_path, "rb") as file:
        ranks = trees.sparkSession.sparkContext.broadcast(file.read())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = _restored(codec(ranks.value), batch)
        in_step([_one_by_one(tree, edits) for tree, edits in zip(held, batch.column("edits").to_pylist())])
        out = _rows(batch.column("id").to_pylist(), held)
        return pa.RecordBatch.from_arrays([*out.columns, *(batch.column(c) for c in keep)], NAMES + list(keep))

    rows = trees.select("id", "text", "sizes", "counts", F.col(edits_col).cast(EDITS).alias("edits"), *keep)
    return rows.mapInArrow(per_batch(work), TREE + _more(rows, 5))


def apply_edits(trees: DataFrame, edits: DataFrame, ranks_path: str, id_col: str = "doc_id", order_col: str = "seq") -> DataFrame:
    """The trees after the edits (id, order, at, removed, inserted) of their documents.

    The edits of an id are put in order once and joined to its trees, each of which is a row by itself: trees that share an id (the null
    id is one like any other) spread over tasks.
    """
    one = F.struct(
        F.col(order_col).cast("long").alias("seq"), F.col("at").cast("int").alias("at"), F.col("removed").cast("int").alias("removed"),
        F.col("inserted").cast("string").alias("inserted"),
    )
    lists = edits.groupBy(F.col(id_col).cast("long").alias("of")).agg(F.array_sort(F.collect_list(one)).alias("edits"))
    plain = F.transform("edits", lambda e: F.struct(e["at"].alias("at"), e["removed"].alias("removed"), e["inserted"].alias("inserted")))
    joined = trees.join(lists, F.col("id").eqNullSafe(F.col("of")), "left").withColumn("edits", plain)
    return apply_edit_lists(joined, ranks_path, "edits")
