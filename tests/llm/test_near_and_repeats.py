"""SimHash components, repeated windows and repeated line runs against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tabreg.llm import lines, simhash, substrings
from tabreg.llm.common import connected_components, read_table
from tabreg.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences


def plain_fingerprint(text: str | None, n: int = 4) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, threshold):
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= threshold and label[j] < label[i]:
                    label[i], changed = label[j], True
    least = {}
    for at, key in zip(label, ids):
        known = [k for k in (least.get(at), key) if k is not None]
        least[at] = min(known, default=None)
    return [least[at] for at in label]


def test_op1_same_as_brute_force(spark, sf_dir, small):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op1_simhash"](spark, sf_dir).collect()}
    fps = [plain_fingerprint(t) for t in small.values()]
    components = plain_components(list(small), fps, 4)
    assert got == {d: (format(f, "016x"), c) for d, f, c in zip(small, fps, components)}


def test_fingerprints_of_odd_rows(odd, none):
    rows = [(r["id"], r["fp"] & (1 << 64) - 1, r["component"]) for r in simhash.simhash_components(odd).collect()]
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    fps = [plain_fingerprint(t) for _, t in texts]
    want = zip([d for d, _ in texts], fps, plain_components([d for d, _ in texts], fps, 4))
    assert Counter(rows) == Counter(want)
    assert simhash.simhash_components(none).count() == 0


@pytest.mark.parametrize("threshold", [0, 1, 4, 7, 9])
def test_links_lose_no_pair(spark, threshold):
    rng = random.Random(threshold)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 6))) & (1 << 64) - 1 for b in base for _ in range(15)})
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    table = spark.createDataFrame(signed, "fp long")
    for block_rows in (8192, 4):  # the small one cuts every crowded anchor into a grid
        links = simhash.link(table, threshold, block_rows)
        roots = {r["node"]: r["root"] for r in connected_components(links).collect()}
        got = Counter(roots.get(f[0], f[0]) for f in signed)
        want = Counter(plain_components(list(range(len(fps))), fps, threshold))
        assert sorted(got.values()) == sorted(want.values())


def test_components_of_a_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in connected_components(edges).collect()} == {0}
    assert connected_components(edges.limit(0)).count() == 0


def test_one_of_each_stays(odd, none):
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = plain_components([d for d, _ in rows], [plain_fingerprint(t, 4) for _, t in rows], 4)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(set(want))
    assert simhash.keep_one_of_each(none).count() == 0


def plain_one_of_each(rows, shingle=4, threshold=4):
    """Smallest ids of the components of linked fingerprints."""
    ids = [d for d, _ in rows]
    return set(plain_components(ids, [plain_fingerprint(t, shingle) for _, t in rows], threshold))


def edited(rng, words, changes):
    """Words with some of them replaced by new ones."""
    at = set(rng.sample(range(len(words)), changes))
    return [f"new{rng.random()}" if i in at else w for i, w in enumerate(words)]


@pytest.mark.parametrize("block_rows", [8192, 4])
def test_one_of_each_same_as_plain(spark, block_rows):
    rng = random.Random(5)
    texts = []
    for _ in range(25):  # equal, nearly equal and rather different ones, and copies of copies
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([40, 150, 400]))]
        texts += [words, words]
        texts += [edited(rng, words, max(1, len(words) * c // 1000)) for c in (3, 5, 10, 22, 60)]
        texts.append(edited(rng, texts[-3], 1))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = {r["doc_id"] for r in simhash.keep_one_of_each(docs, block_rows=block_rows).collect()}
    assert kept == plain_one_of_each(rows) and len(kept) not in (25, len(rows))


def test_one_of_each_of_the_table(spark, sf_dir, small):
    kept = {r["doc_id"] for r in simhash.keep_one_of_each(read_table(spark, sf_dir, "documents")).collect()}
    assert kept == plain_one_of_each(list(small.items()))


def test_op7_same_as_sql(spark, sf_dir):
    assert differences(QUERIES["op7_line_runs"](spark, sf_dir), connect(sf_dir), ORACLES["op7_line_runs"]) == []


def plain_runs(texts, min_words):
    """Lines inside any run of enough words that also starts at an earlier place."""
    every = [t.split("\n") for t in texts]
    first, out = {}, [set() for _ in texts]
    places = [(d, i, j) for d, ls in enumerate(every) for i in range(len(ls)) for j in range(i, len(ls))]
    for d, i, j in places:
        first.setdefault(tuple(every[d][i : j + 1]), (d, i))
    for d, i, j in places:
        run = every[d][i : j + 1]
        if sum(len(x.split()) for x in run) >= min_words and first[tuple(run)] != (d, i):
            out[d].update(range(i, j + 1))
    return ["\n".join(x for i, x in enumerate(ls) if i not in gone) for ls, gone in zip(every, out)]


def test_line_runs_same_as_brute_force(spark):
    rng = random.Random(8)
    texts = ["\n".join(rng.choice(["a b", "c", "", "d e f", "g"]) for _ in range(rng.randint(1, 14))) for _ in range(12)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["text"] for r in lines.line_report(rows, min_words=6).collect()}
    assert got == dict(enumerate(plain_runs(texts, 6)))


def test_line_runs_of_odd_rows(odd, none):
    out = lines.drop_repeats(odd, length_col="n_chars")
    assert out.columns == odd.columns and out.dtypes == odd.dtypes and out.count() == odd.count()
    texts = Counter((r["doc_id"], r["text"]) for r in out.collect() if r["text"] and "quick" in r["text"])
    # the first of the smallest id stays, "again" is another line
    assert {d for d, _ in texts} == {1, 8} and sum(texts.values()) == 2
    assert lines.drop_repeats(none).count() == 0 and lines.line_report(none).count() == 0
    report = {r["id"]: r for r in lines.line_report(odd).filter("id in (3, 4)").collect()}
    assert all((r["n_lines"], r["n_removed"], r["text"]) == (1, 0, "") for r in report.values())


def test_pipeline_drops_short_lines(spark, sf_dir, small):
    rng = random.Random(9)
    texts = ["\n".join(rng.choice(["a b", "c", "", " \t", "d e f", "g", f"own {d}"]) for _ in range(rng.randint(1, 12))) for d in range(12)]
    for texts in (texts, list(small.values())):
        rows = spark.createDataFrame([(d, t, len(t)) for d, t in enumerate(texts)], "doc_id long, text string, n_chars long")
        got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.drop_repeated_lines(spark, rows, sf_dir).collect()}
        want = plain_runs(texts, 1)
        assert got == {d: (t, len(t)) for d, t in enumerate(want)}


def test_thousands_of_equal_rows_lose_all_windows(spark):
    """Copies that share an id as well: what they name is taken once, not once per copy."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text)] * 3000 + [(None, text)] * 1500 + [(2, "before " + text), (3, "other words only")]
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).select("id", "n_words", "n_removed")
    assert Counter(map(tuple, found.collect())) == {(1, 60, 60): 3000, (None, 60, 60): 1500, (2, 61, 60): 1, (3, 3, 0): 1}


def test_rows_that_share_are_found_across_batches():
    rng = random.Random(9)
    for size in (1, 2, 3, 7, 500):
        for spread in (2, 6, 60):
            keys = sorted((rng.randrange(spread), rng.randrange(3)) for _ in range(rng.randint(1, 90)))
            rows = [(a, b, (1 << 62) + i, 2 * i, i % 5 + 1) for i, (a, b) in enumerate(keys)]
            batches = []
            for i in range(0, len(rows), size):
                columns = zip(*rows[i : i + size])
                batches.append(pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["a", "b", "key", "at", "count"]))
            many, names = Counter(keys), {}
            for a, b in keys:
                names.setdefault(a, set()).add(b)
            want = [(*r[2:], 1) for r in rows if many[r[:2]] > 1]
            firsts = {r[:2]: r for r in reversed(rows)}
            want += [(*r[2:], 2) for r in firsts.values() if len(names[r[0]]) > 1]
            got = [tuple(r.values()) for out in substrings.sharing(iter(batches)) for r in out.to_pylist()]
            assert sorted(got) == sorted(want)
