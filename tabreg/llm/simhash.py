"""Near-duplicate documents: SimHash fingerprints linked through covering-code anchors.

**Fingerprint.** Words of the lower-cased text, shingles of ``shingle`` words, one 64-bit hash each; a bit
of the fingerprint is set where over half the hashes have it set.

**Anchors.** A link is a pair of fingerprints with at most ``threshold`` differing bits. The 64 bits are cut
into fields; a pair within the threshold differs in at most ``t`` bits (0 or 1) of at least one field, as the
fields' ``t + 1`` sum to ``threshold + 1``. In each field the anchors are the words of a covering code: a
perfect Hamming code on the field's first 2^r - 1 bits and every pattern of its other bits (radius 1), or
all patterns where ``t`` is 0 (radius 0). Every fingerprint has its home anchor within the radius and is
replicated to all anchors within radius plus ``t``, so that a linked pair meets at the home of either one. The
number of replicas depends on the code only (39 for 4 bits), never on the data.

**Comparison.** Equal fingerprints are one before this step, so thousands of copies cost one row. Rows
are dealt by anchor; homes are compared with all members in blocks, and each block hands on a spanning forest
of its links, never all pairs. An anchor with more than ``block_rows`` homes is cut into a grid
of blocks which are dealt separately, so no task holds an unbounded group.

Null and empty texts have fingerprint zero and link like any other. Repeated rows and ids each keep their
row. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import connected_components, per_batch, stage, texts_of

SEED = 42
BLOCK_ROWS = 8192
PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: str, shingle: int) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - shingle + 1)
    first, stop = starts[:last].tolist(), ends[len(ends) - last :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[i:j], SEED) for i, j in zip(first, stop)], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, last, 65536):
        part = hashes[at : at + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp): the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in texts_of(batch)], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps)], ["id", "fp"])

    return rows.mapInArrow(per_batch(work), "id long, fp long")


def fields(threshold: int) -> list[tuple[int, int, int]]:
    """(first bit, width, t) of each field; the sum of t + 1 is threshold + 1."""
    if not 0 <= threshold <= 20:
        raise ValueError("a threshold of 0 to 20 bits is supported")
    wide, narrow = (threshold + 1) // 2, (threshold + 1) % 2
    if not wide:
        return [(0, 64, 0)]
    exact = min(16, 64 // (wide + 1)) if narrow else 0
    cuts = [round(i * (64 - exact) / wide) for i in range(wide + 1)]
    out = [(a, b - a, 1) for a, b in zip(cuts, cuts[1:])]
    return out + ([(64 - exact, exact, 0)] if narrow else [])


@lru_cache
def covering(width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Column of the parity check for each bit; for each syndrome the masks of weight 2 or less with it."""
    r = (width + 1).bit_length() - 1
    column = np.array([i + 1 if i < 2**r - 1 else 0 for i in range(width)], dtype=np.int64)
    masks: list[list[int]] = [[] for _ in range(2**r)]
    masks[0].append(0)
    for i in range(width):
        masks[column[i]].append(1 << i)
        for j in range(i):
            masks[column[i] ^ column[j]].append(1 << i | 1 << j)
    return column, [np.array(m, dtype=np.uint64) for m in masks]


def syndromes(values: np.ndarray, column: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    for i, c in enumerate(column.tolist()):
        if c:
            out ^= np.where(values >> np.uint64(i) & np.uint64(1), c, 0)
    return out


def anchors(fps: np.ndarray, threshold: int, home_only: bool = False):
    """(field, anchor, index of the fingerprint, is home) for every anchor of every fingerprint."""
    for number, (first, width, t) in enumerate(fields(threshold)):
        value = fps >> np.uint64(first)
        if width < 64:
            value = value & np.uint64((1 << width) - 1)
        if t == 0:
            yield number, value, np.arange(len(fps)), np.ones(len(fps), bool)
            continue
        column, masks = covering(width)
        syndrome = syndromes(value, column)
        home = np.where(syndrome > 0, value ^ (np.uint64(1) << np.maximum(syndrome - 1, 0).astype(np.uint64)), value)
        if home_only:
            yield number, home, np.arange(len(fps)), np.ones(len(fps), bool)
            continue
        for s, mask in enumerate(masks):
            at = np.flatnonzero(syndrome == s)
            if len(at):
                anchor = (value[at, None] ^ mask[None]).ravel()
                index = np.repeat(at, len(mask))
                yield number, anchor, index, anchor == home[index]


def link(fps: DataFrame, threshold: int = 4, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): a spanning forest of the links between distinct fingerprints (column ``fp``, stored)."""
    schema = "field int, anchor long, fp long, home boolean"

    def place(home_only: bool):
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = batch.column("fp").to_numpy().view(np.uint64)
            parts = list(anchors(values, threshold, home_only))
            columns = [
                np.concatenate([np.full(len(p[1]), p[0], np.int32) for p in parts]),
                np.concatenate([p[1] for p in parts]).view(np.int64),
                np.concatenate([values[p[2]] for p in parts]).view(np.int64),
                np.concatenate([p[3] for p in parts]),
            ]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["field", "anchor", "fp", "home"])

        return per_batch(work)

    homes = fps.select("fp").mapInArrow(place(True), schema)
    crowded = stage(
        homes.groupBy("field", "anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block_rows)
        .select("field", "anchor", F.ceil(F.col("n") / block_rows).cast("int").alias("cuts")),
        "crowded",
    )
    cell = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    every = F.sequence(F.lit(0), F.col("cuts") - 1)
    placed = (
        fps.select("fp").mapInArrow(place(False), schema)
        .join(crowded, ["field", "anchor"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
        # a home goes to one row of the grid and all its columns; as a member it goes to one column and all rows
        .withColumn("spots", F.concat(
            F.when(F.col("home"), F.transform(every, lambda j: F.struct(cell.alias("i"), j.alias("j"), F.lit(True).alias("h")))).otherwise(F.array()),
            F.transform(every, lambda i: F.struct(i.alias("i"), cell.alias("j"), F.lit(False).alias("h"))),
        ))
        .select("field", "anchor", "fp", F.explode("spots").alias("s"))
        .select("field", "anchor", "s.i", "s.j", "s.h", "fp")
    )
    keys = ["field", "anchor", "i", "j"]
    dealt = placed.repartition(*keys).sortWithinPartitions(*keys, F.desc("h"))
    return dealt.mapInArrow(lambda batches: _compare(batches, threshold), "a long, b long").distinct()


def _compare(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Blocks arrive whole and in order, homes first; a block that spans batches keeps its homes only."""
    kept = None
    for batch in batches:
        rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("field", "anchor", "i", "j", "h", "fp")]
        if kept is not None:
            rows = [np.concatenate(x) for x in zip(kept, rows)]
        n = len(rows[0])
        if not n:
            continue
        new = np.zeros(n, bool)
        new[0] = True
        for c in rows[:4]:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, n))
        homes = np.add.reduceat(rows[4].astype(np.int64), starts)
        yield from _links(rows[5].view(np.uint64), starts, sizes, homes, threshold)
        last = slice(starts[-1], starts[-1] + homes[-1])
        kept = [c[last].copy() for c in rows]


def _links(fps, starts, sizes, homes, threshold) -> Iterator[pa.RecordBatch]:
    members = sizes - homes
    pairs = homes * members
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for g in np.flatnonzero(pairs > PAIRS_AT_ONCE):
        home = fps[starts[g] : starts[g] + homes[g]]
        rest = fps[starts[g] + homes[g] : starts[g] + sizes[g]]
        step = max(1, PAIRS_AT_ONCE // len(home))
        for at in range(0, len(rest), step):
            part = rest[at : at + step]
            i, j = np.nonzero(np.bitwise_count(home[:, None] ^ part[None]) <= threshold)
            found.append(_forest(home[i], part[j]))
    small = np.flatnonzero((pairs > 0) & (pairs <= PAIRS_AT_ONCE))
    total = np.cumsum(pairs[small])
    at = 0
    while at < len(small):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
        g = small[at:stop]
        group = np.repeat(np.arange(len(g)), pairs[g])
        offset = np.arange(len(group)) - np.repeat(np.cumsum(pairs[g]) - pairs[g], pairs[g])
        home = fps[starts[g][group] + offset // members[g][group]]
        other = fps[(starts[g] + homes[g])[group] + offset % members[g][group]]
        near = np.bitwise_count(home ^ other) <= threshold
        found.append(_forest(home[near], other[near]))
        at = stop
    a = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.uint64)
    b = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.uint64)
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node) of each component of the links between ``a`` and ``b``."""
    differ = a != b
    a, b = a[differ], b[differ]
    if not len(a):
        return a, b
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    hung = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[hung], nodes[label[hung]]


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, threshold: int = 4,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, fp, component): for every row the smallest id reachable over links, itself included.

    A null id takes part in linking; it is never the smallest unless all ids of the component are null.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return rows.join(fp_components(rows, threshold, block_rows), "fp").select("id", "fp", "component")


def fp_components(rows: DataFrame, threshold: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(fp, root, component) of stored (id, fp) rows; root is a fingerprint and never null."""
    distinct = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = connected_components(link(distinct, threshold, block_rows))
    grouped = stage(
        distinct.join(roots, F.col("fp") == F.col("node"), "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots",
    )
    lowest = grouped.groupBy("root").agg(F.min("least").alias("component"))
    return grouped.join(lowest, "root").select("fp", "root", "component")


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, threshold: int = 4, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component of linked fingerprints the smallest id stays.

    Of rows with the same id and component the first stays; a null id stays only where its component has no other id.
    """
    key = "_llm_row"
    keyed = stage(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    rows = stage(fingerprints(keyed, key, text_col, shingle), "fingerprints")
    roots = fp_components(rows, threshold, block_rows).select("fp", "root")
    named = rows.join(roots, "fp").select(F.col("id").alias(key), "root").join(keyed.select(key, F.col(id_col).alias("id")), key)
    order = F.struct(F.col("id").isNull().alias("none"), "id", F.col(key).alias("row"))
    kept = named.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.row").alias(key))
    return keyed.join(kept, key, "left_semi").drop(key)
