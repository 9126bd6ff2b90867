"""Exact BM25 top-k over an inverted index in shards, pruned by block maxima.

**Index.** Each task turns its documents into shards of up to ``SHARD_DOCS`` documents or ``SHARD_WORDS`` words: terms in order, postings of
each, and within a term's postings blocks of ``BLOCK`` neighbouring documents; a row of the index holds them compressed. Documents of a shard are ordered by their most frequent
term, so that neighbours are alike and block maxima are tight. The index is stored once and read for every block of queries.

**Statistics.** Numbers of documents, their mean length and document frequencies are of the whole corpus: frequencies are summed
over shards and joined with the terms of the queries. Scores are therefore the same in every shard, and shard results merge exactly.

**Search.** In a shard, queries are taken together. A query's block maxima times term weights give every block of documents an upper
bound; blocks whose bound is below the k-th best score so far are left out, and so is the shard where all are (block-max pruning).
Impacts of terms that a thirty-second of the documents holds are rows of a matrix: one product with the queries' weights gives their part of all
bounds, another of all scores, in single precision; postings of the other terms are added. Documents that may be among the k best, with room
for rounding, are scored anew in double precision, term by term. The k best travel on through all shards of a task, so later shards
prune more; each task gives k rows per query, and a window over the query merges them.

BM25 with k1 = 1.2, b = 0.75, idf = ln(1 + (N - df + 0.5) / (df + 0.5)); a term repeated in the query counts as often. Terms are
lower-cased runs of letters, digits and underscores, known by a 64-bit hash. Equal scores are ordered by id, null ids last. Documents that share
no term with a query are no results; null and empty texts have no terms. Repeated rows are results of their own. Empty
tables give an empty result. Extra columns are ignored. Queries are sent to the tasks in blocks of at most ``QUERY_TERMS`` terms.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from .common import parts, per_batch, stage, texts_of

K1, B = 1.2, 0.75
SHARD_DOCS, SHARD_WORDS, BLOCK = 4096, 1 << 20, 16
QUERY_TERMS = 1 << 21
CACHED_WORDS = 1 << 17
FREQUENT, FREQUENT_TERMS, QUERIES_AT_ONCE = 32, 4096, 512
ABSENT = 1 << 62  # stands for a null id, after all others
WORDS = re.compile(r"\w+")
INDEX = "n_docs long, n_words long, found binary, postings binary"
#: The arrays of a shard, in the order in which they are packed.
FOUND = (("terms", "<u8"), ("term_ends", "<i4"), ("block_ends", "<i4"))
POSTINGS = (("ids", "<i8"), ("lengths", "<i4"), ("block_of", "<u2"), ("docs", "<u2"), ("counts", "<i4"))


class _Terms(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        return found


_TERMS = _Terms()


def terms_of(text: str) -> np.ndarray:
    words = WORDS.findall(text.lower())
    return np.fromiter(map(_TERMS.__getitem__, words), np.uint64, len(words))


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], ..., starts[0] + sizes[0] - 1, starts[1], ..."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _shard(ids: list, found: list[np.ndarray]) -> dict:
    lengths = np.array([len(t) for t in found], np.int64)
    terms, which = np.unique(np.concatenate(found), return_inverse=True)
    doc = np.repeat(np.arange(len(ids)), lengths)
    n = len(ids)
    pairs, counts = np.unique(which * n + doc, return_counts=True)
    term, doc = pairs // n, pairs % n
    # the most frequent term of each document: neighbours have the same
    best = np.lexsort((term, counts, doc))
    head = np.zeros(n, np.int64)
    head[doc[best]] = term[best]
    order = np.lexsort((lengths, head))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    doc = place[doc]
    by = np.lexsort((doc, term))
    term, doc, counts = term[by], doc[by], counts[by]
    block = doc // BLOCK
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
    first = np.flatnonzero(new)
    keys = np.array([ABSENT if i is None else i for i in ids], np.int64)[order]
    arrays = {
        "ids": keys, "lengths": lengths[order], "terms": terms, "term_ends": np.searchsorted(term[first], np.arange(len(terms)), "right"),
        "block_of": block[first], "block_ends": np.append(first, len(term))[1:], "docs": doc, "counts": counts,
    }
    return {"n_docs": n, "n_words": int(lengths.sum()), "found": _packed(arrays, FOUND), "postings": _packed(arrays, POSTINGS)}


def _packed(arrays: dict[str, np.ndarray], kinds: tuple) -> bytes:
    """The arrays of ``kinds``, compressed, ends as sizes: a task holds all shards of a batch in this form and unpacks one at a time."""
    plain = [(np.diff(arrays[name], prepend=0) if name.endswith("_ends") else arrays[name]).astype(kind).tobytes() for name, kind in kinds]
    sizes = np.array([len(x) for x in plain], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(b"".join([sizes, *plain]))


def _unpacked(packed: bytes | pa.Buffer, kinds: tuple) -> dict[str, np.ndarray]:
    plain = zstandard.ZstdDecompressor().decompress(packed)
    head = 8 * len(kinds)
    ends = head + np.cumsum([0, *np.frombuffer(plain, "<i8", len(kinds))])
    out = {
        name: np.frombuffer(plain, kind, (b - a) // np.dtype(kind).itemsize, a)
        for (name, kind), a, b in zip(kinds, ends.tolist(), ends[1:].tolist())
    }
    return {name: np.cumsum(x) if name.endswith("_ends") else x for name, x in out.items()}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard, stored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, words = [], [], 0
        for part in (part for whole in batches for part in parts(whole)):
            for key, text in zip(part.column("id").to_pylist(), texts_of(part)):
                ids.append(key)
                found.append(terms_of(text))
                words += len(found[-1])
                if len(ids) >= SHARD_DOCS or words >= SHARD_WORDS:
                    yield pa.RecordBatch.from_pylist([_shard(ids, found)], schema=schema)
                    ids, found, words = [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([_shard(ids, found)], schema=schema)

    names = [c.split()[0] for c in INDEX.split(", ")]
    schema = pa.schema([(c, pa.int64() if c.startswith("n_") else pa.binary()) for c in names])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return stage(rows.mapInArrow(work, INDEX), "index")


def document_frequencies(index: DataFrame) -> DataFrame:
    """(term, df) over all shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("found"):
                found = _unpacked(packed.as_buffer(), FOUND)
                if len(found["terms"]):
                    ends = found["block_ends"][found["term_ends"] - 1]
                    columns = [pa.array(found["terms"].view("<i8")), pa.array(np.diff(ends, prepend=0))]
                    yield pa.RecordBatch.from_arrays(columns, ["term", "df"])

    counted = index.select("found").mapInArrow(work, "term long, df long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"))


def weigh(queries: DataFrame, index: DataFrame, n_docs: int) -> DataFrame:
    """(query, terms, weights) of each of the queries (query: a number of its own, text) that has terms, stored."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, terms, counts = [], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for key, text in zip(batch.column("query").to_pylist(), texts_of(batch)):
            t, c = np.unique(terms_of(text), return_counts=True)
            keys += [key] * len(t)
            terms.append(t)
            counts.append(c)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(np.concatenate(terms).view(np.int64)), pa.array(np.concatenate(counts))], ["query", "term", "times"]
        )

    wanted = queries.select("query", "text").mapInArrow(per_batch(work), "query long, term long, times long")
    known = wanted.join(document_frequencies(index), "term")
    idf = F.log(1 + (F.lit(float(n_docs)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = known.select("query", F.struct("term", (F.col("times") * idf).alias("weight")).alias("t"))
    lists = weighed.groupBy("query").agg(F.collect_list("t").alias("t"))
    return stage(lists.select("query", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")), "queries")


class Best:
    """The k best (score, id) of a query so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0), np.empty(0, np.int64)

    def least(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else 0.0

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        may = scores >= self.least() if len(self.scores) == self.k else scores > 0
        if not may.any():
            return
        scores, ids = np.concatenate((self.scores, scores[may])), np.concatenate((self.ids, ids[may]))
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


class Shard:
    def __init__(self, row: dict, mean_length: float):
        arrays = _unpacked(row["found"], FOUND) | _unpacked(row["postings"], POSTINGS)
        self.ids, lengths, terms, self.term_ends, self.block_of, ends, self.docs, counts = (
            arrays[c] for c in ("ids", "lengths", "terms", "term_ends", "block_of", "block_ends", "docs", "counts")
        )
        self.terms, self.ends = terms, ends
        self.starts = np.append(0, self.ends[:-1]) if len(ends) else self.ends
        damp = K1 * (1 - B + B * lengths / mean_length)
        self.impact = counts * (K1 + 1) / (counts + damp[self.docs])
        self.maxima = np.maximum.reduceat(self.impact, self.starts) if len(ends) else np.empty(0)
        self.blocks = -(-len(self.ids) // BLOCK)

        if len(terms):
            self._lay_out()

    def _lay_out(self) -> None:
        """Frequent terms as rows of a matrix, by document and by block; all postings by document."""
        first = np.append(0, self.term_ends[:-1]).astype(np.int64)
        self.term_starts = self.starts[first]
        self.term_sizes = self.ends[self.term_ends - 1] - self.term_starts
        n = len(self.ids)
        frequent = np.flatnonzero(self.term_sizes * FREQUENT >= n)[:FREQUENT_TERMS]
        self.row_of = np.full(len(self.terms), -1, np.int64)
        self.row_of[frequent] = np.arange(len(frequent))
        sizes = self.term_sizes[frequent]
        posting = spread(self.term_starts[frequent], sizes)
        self.rows = np.zeros((len(frequent), n), np.float32)
        self.rows[np.repeat(np.arange(len(frequent)), sizes), self.docs[posting]] = self.impact[posting]
        low, each = first[frequent], self.term_ends[frequent] - first[frequent]
        entry = spread(low, each)
        self.block_rows = np.zeros((len(frequent), self.blocks), np.float32)
        self.block_rows[np.repeat(np.arange(len(frequent)), each), self.block_of[entry]] = self.maxima[entry]
        order = np.argsort(self.docs, kind="stable")
        self.own_terms = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.term_sizes)[order]
        self.own_impact = self.impact[order]
        self.own_ends = np.cumsum(np.bincount(self.docs, minlength=n))

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """``terms`` in ascending order."""
        self.search_all([(terms, weights)], [best])

    def search_all(self, queries: list[tuple[np.ndarray, np.ndarray]], best: list[Best]) -> None:
        """Takes over the best documents for each of ``queries``, whose terms are in ascending order."""
        for at in range(0, len(queries), QUERIES_AT_ONCE):
            self._search_some(queries[at : at + QUERIES_AT_ONCE], best[at : at + QUERIES_AT_ONCE])

    def _search_some(self, queries: list[tuple[np.ndarray, np.ndarray]], best: list[Best]) -> None:
        ends = np.cumsum([len(t) for t, _ in queries])
        wanted, weights = (np.concatenate([q[i] for q in queries]) for i in (0, 1))
        at = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        here = self.terms[at] == wanted
        of = np.repeat(np.arange(len(queries)), np.diff(ends, prepend=0))[here]
        at, weights = at[here], weights[here]
        row = self.row_of[at]
        dense = row >= 0
        matrix = np.zeros((len(queries), len(self.rows)), np.float32)
        matrix[of[dense], row[dense]] = weights[dense]
        cuts = np.searchsorted(of, np.arange(len(queries) + 1))
        # sums of single precision, and in another order than the score's: leave room for rounding, which grows with the terms
        slack = (np.diff(cuts) + 8) * 2.0**-23
        bounds = matrix @ self.block_rows
        rare = []
        for q, (i, j) in enumerate(zip(cuts, cuts[1:])):
            few = ~dense[i:j]
            mine, weight = at[i:j][few], weights[i:j][few]
            rare.append((mine, weight))
            low = np.where(mine > 0, self.term_ends[mine - 1], 0).astype(np.int64)
            each = self.term_ends[mine] - low
            entry = spread(low, each)
            bounds[q] += np.bincount(self.block_of[entry], np.repeat(weight, each) * self.maxima[entry], self.blocks)
        bounds = bounds * (1 + slack[:, None])
        least = np.array([b.least() for b in best])
        left = np.flatnonzero((bounds.max(axis=1) >= least) & (np.diff(cuts) > 0))
        near = matrix[left] @ self.rows
        weight_of = np.zeros(len(self.terms))
        for n, q in enumerate(left.tolist()):
            mine, weight = rare[q]
            sizes = self.term_sizes[mine]
            posting = spread(self.term_starts[mine], sizes)
            score = near[n] + np.bincount(self.docs[posting], np.repeat(weight, sizes) * self.impact[posting], len(self.ids))
            floor = least[q]
            if len(score) > best[q].k:
                floor = max(floor, np.partition(score, -best[q].k)[-best[q].k] * (1 - 2 * slack[q]))
            may = np.flatnonzero((score > 0) & (score * (1 + 2 * slack[q]) >= floor) & (np.repeat(bounds[q], BLOCK)[: len(score)] >= least[q]))
            if not len(may):
                continue
            # exact scores of these: sums over a document's terms in ascending order
            i, j = cuts[q], cuts[q + 1]
            weight_of[at[i:j]] = weights[i:j]
            sizes = self.own_ends[may] - np.where(may > 0, self.own_ends[may - 1], 0)
            posting = spread(self.own_ends[may] - sizes, sizes)
            exact = np.bincount(np.repeat(np.arange(len(may)), sizes), weight_of[self.own_terms[posting]] * self.own_impact[posting], len(may))
            weight_of[at[i:j]] = 0
            best[q].add(exact, self.ids[may])


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(query, rank, id, score): the k best documents of each query, a row (id, text). Repeated rows and null ids are queries of their own."""
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col)
    total = index.agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("words")).first()
    schema = "query long, id long, score double"
    if not total["words"]:
        return spark.createDataFrame([], "query long, rank int, id long, score double")
    mean = total["words"] / total["n"]
    asked = stage(
        queries.select(F.monotonically_increasing_id().alias("query"), F.col(id_col).cast("long").alias("query_id"), F.col(text_col).alias("text")), "asked"
    )
    results = []
    for block in _blocks(weigh(asked, index, total["n"])):
        shared = spark.sparkContext.broadcast(block)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = [Best(k) for _ in shared.value]
            for batch in batches:
                for found, postings in zip(batch.column("found"), batch.column("postings")):
                    shard = Shard({"found": found.as_buffer(), "postings": postings.as_buffer()}, mean)
                    if len(shard.terms):
                        shard.search_all([(terms, weights) for _, terms, weights in shared.value], best)
                    del shard  # before the next one is laid out
            keys = np.repeat(np.array([q for q, _, _ in shared.value], np.int64), [len(b.ids) for b in best])
            if len(keys):
                ids = np.concatenate([b.ids for b in best])
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys), pa.array(ids, mask=ids == ABSENT), pa.array(np.concatenate([b.scores for b in best]))
                ], ["query", "id", "score"])

        results.append(index.select("found", "postings").mapInArrow(work, schema))
    if not results:
        return spark.createDataFrame([], "query long, rank int, id long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = reduce(DataFrame.unionAll, results).withColumn("rank", F.row_number().over(order))
    found = ranked.filter(F.col("rank") <= k).join(asked.select("query", "query_id"), "query")
    return found.select(F.col("query_id").alias("query"), "rank", "id", "score")


def _blocks(weighed: DataFrame) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    block, size = [], 0
    for row in weighed.toLocalIterator():
        terms = np.array(row["terms"], np.int64).view(np.uint64)
        order = np.argsort(terms)
        block.append((row["query"], terms[order], np.array(row["weights"])[order]))
        size += len(terms)
        if size >= QUERY_TERMS:
            yield block
            block, size = [], 0
    if block:
        yield block
