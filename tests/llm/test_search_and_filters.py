"""Search, decontamination, toxicity, preferences and the pipeline."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.llm import decontaminate, preferences, search, toxicity
from tabreg.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences


def plain_search(texts, queries, k):
    found = {d: Counter(re.findall(r"\w+", (t or "").lower())) for d, t in texts.items()}
    n, length = len(found), {d: sum(c.values()) for d, c in found.items()}
    mean = sum(length.values()) / n
    df = Counter(w for c in found.values() for w in c)
    out = {}
    for q in queries:
        scores = []
        for d, c in found.items():
            s = sum(
                times * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * length[d] / mean))
                for w, times in found[q].items() if w in c
            )
            if s > 0:
                scores.append((round(s, 5), d))
        out[q] = sorted(scores, key=lambda x: (-x[0], x[1]))[:k]
    return out


def test_search_same_as_brute_force(spark, sf_dir, small, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    monkeypatch.setattr(search, "QUERY_TERMS", 500)  # several blocks of queries
    got: dict = {}
    for r in search.search(docs, docs.filter("doc_id % 20 = 0"), k=5).collect():
        got.setdefault(r["query"], []).append((r["rank"], round(r["score"], 5)))
    want = plain_search(small, [d for d in small if d % 20 == 0], 5)
    for q, rows in want.items():
        assert len(got[q]) == len(rows)
        assert all(abs(a[1] - b[0]) < 1e-4 for a, b in zip(sorted(got[q]), rows))


def test_op6_same_as_brute_force(spark, sf_dir, small):
    got = {}
    for r in QUERIES["op6_search"](spark, sf_dir).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    want = plain_search(small, [d for d in small if d % 100 == 0], 10)
    assert set(got) == set(want)
    for q, rows in want.items():
        assert [d for _, d, _ in sorted(got[q])] == [d for _, d in rows]
        assert all(abs(a[2] - b[0]) < 1e-4 for a, b in zip(sorted(got[q]), rows))


def test_repeated_and_null_queries(spark):
    docs = spark.createDataFrame([(1, "red fox"), (2, "red red hen"), (3, "blue")], "doc_id long, text string")
    asked = [(7, "red"), (7, "red"), (None, "red"), (8, "blue red"), (9, None)]
    queries = spark.createDataFrame(asked, "doc_id long, text string").repartition(3)
    rows = search.search(docs, queries, k=2).collect()
    assert Counter((r["query"], r["rank"]) for r in rows) == {(7, 1): 2, (7, 2): 2, (None, 1): 1, (None, 2): 1, (8, 1): 1, (8, 2): 1}
    one = {(r["rank"], r["id"], round(r["score"], 9)) for r in rows if r["query"] in (7, None)}
    assert len(one) == 2


def test_repeated_items_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "one two three four five six", "x", 9), (2, "none", "y", 8)], "doc_id long, text string, item string, distance int")
    bench = spark.createDataFrame([(5, "two three"), (5, "two three"), (None, "five"), (6, " ")], "item_id long, text string")
    rows = decontaminate.find_contamination(docs, bench).collect()
    assert sorted(((r["id"], r["item"], r["distance"], r["first_word"], r["end_word"]) for r in rows), key=str) == [
        (1, 5, 0, 1, 3), (1, 5, 0, 1, 3), (1, None, 0, 4, 5)]
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "none", "y", 8)]


def test_bounds_prune_nothing_that_counts():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(1, 12))) for _ in range(700)]
    found = [search.terms_of(t) for t in texts]
    shard = search.Shard(search._shard(list(range(700)), found), 6.0)
    terms = np.unique(search.terms_of("a bb c dd e"))
    weights = np.linspace(0.5, 2, len(terms))
    best = search.Best(10)
    shard.search(terms, weights, best)
    damp = [1.2 * (0.25 + 0.75 * len(f) / 6.0) for f in found]
    scores = [sum(w * c * 2.2 / (c + d) for t, w in zip(terms, weights) if (c := int((f == t).sum()))) for f, d in zip(found, damp)]
    want = sorted(zip([-s for s in scores], range(700)))[:10]
    assert np.allclose(best.scores, [-s for s, _ in want]) and best.ids.tolist() == [i for _, i in want]


def test_index_rows_are_packed_and_unpack_to_the_same_postings():
    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 5000}" for _ in range(200)) for _ in range(600)] + ["", "one"]
    found = [search.terms_of(t) for t in texts]
    row = search._shard(list(range(602)), found)
    pairs = {(t, i): int((f == t).sum()) for i, f in enumerate(found) for t in np.unique(f)}
    assert sum(len(v) for v in row.values() if isinstance(v, bytes)) < 8 * len(pairs) + 8 * len({t for t, _ in pairs})
    got = search._unpacked(row["found"], search.FOUND) | search._unpacked(row["postings"], search.POSTINGS)
    ends = got["block_ends"][got["term_ends"] - 1]
    term = np.repeat(got["terms"], np.diff(ends, prepend=0))
    assert dict(zip(zip(term.tolist(), got["ids"][got["docs"]].tolist()), got["counts"].tolist())) == pairs
    empty = search._shard([1], [np.empty(0, np.uint64)])
    assert not len(search._unpacked(empty["found"], search.FOUND)["terms"]) and search.Shard(empty, 1.0).ids.tolist() == [1]


def test_queries_searched_together_get_the_scores_of_each(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(rng.randint(0, 60))) for _ in range(400)] * 2
    found = [search.terms_of(t) for t in texts]
    ids = [None if i % 97 == 0 else i for i in range(800)]
    shards = [search.Shard(search._shard(ids[i : i + 400], found[i : i + 400]), 30.0) for i in (0, 400)]
    queries = [(np.unique(t), np.random.default_rng(i).random(len(np.unique(t))) + 0.1) for i, t in enumerate(found[:90]) if len(t)]
    queries.append((np.array([7], np.uint64), np.ones(1)))  # a term of no document
    best = [search.Best(10) for _ in queries]
    products = []
    plain = search.Shard._search_some
    monkeypatch.setattr(search.Shard, "_search_some", lambda self, some, own: products.append(len(some)) or plain(self, some, own))
    for shard in shards:
        shard.search_all(queries, best)
    assert products == [len(queries)] * 2
    for (terms, weights), own in zip(queries, best):
        scores = []
        for doc, key in zip(found, ids):
            held, score = Counter(doc.tolist()), 0.0
            for t, w in zip(terms.tolist(), weights.tolist()):
                score += w * (held[t] * 2.2 / (held[t] + 1.2 * (1 - 0.75 + 0.75 * len(doc) / 30.0)))
            scores.append((-score, search.ABSENT if key is None else key))
        want = sorted(x for x in scores if x[0] < 0)[:10]
        # copies tie to the last bit, so they follow each other by id
        assert own.ids.tolist() == [i for _, i in want] and np.allclose(own.scores, [-x for x, _ in want], rtol=1e-12)


def test_search_of_odd_rows(odd, none):
    rows = search.search(odd, odd.filter("doc_id in (2, 4)"), k=5).collect()
    # document 9 holds the text twice; copies tie and are ordered by id, the null id last
    assert {r["query"] for r in rows} == {2} and [r["id"] for r in sorted(rows, key=lambda r: r["rank"])] == [9, 1, 1, 2, None]
    assert search.search(none, none).count() == 0 and search.search(odd, none).count() == 0


def sellers(item, text):
    column = list(range(len(item) + 1))
    best = column[-1]
    for w in text:
        diagonal, column[0] = column[0], 0
        for i, x in enumerate(item, 1):
            diagonal, column[i] = column[i], min(diagonal + (x != w), column[i] + 1, column[i - 1] + 1)
        best = min(best, column[-1])
    return best


def test_items_same_as_brute_force():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5)]
    for _ in range(500):
        items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, *range(5, 19)])))) for i in range(3)]
        text = [rng.choice(words) for _ in range(rng.randint(0, 15))]
        for w in items[rng.randrange(3)][1].split():
            text += [w] if rng.random() < 0.85 else [rng.choice(words)] * rng.randint(0, 2)
        text += [rng.choice(words) for _ in range(rng.randint(0, 15))]
        got = {(a, b) for a, b, _, _ in decontaminate.Items(items, 0.2, 1).matches(" ".join(text))}
        want = {(i, sellers(x.split(), text)) for i, x in items}
        assert got == {(i, d) for i, d in want if d <= int(0.2 * len(items[i][1].split()))}


def test_op4_finds_items_with_edits(spark, sf_dir, small):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in QUERIES["op4_decontaminate"](spark, sf_dir).collect()}
    norm = lambda t: " ".join(decontaminate.words_of(t))
    exact = {(d, i) for d, t in small.items() for i, x in items.items() if f" {norm(x)} " in f" {norm(t)} "}
    assert exact and exact == {k for k, v in got.items() if v == 0}
    words = items[0].split()
    words[3:4] = ["changed", "and", "longer"]
    docs = spark.createDataFrame([(1, "before it " + " ".join(words) + " after"), (2, "clean"), (None, items[1]), (3, None), (4, "far too short a text")], "doc_id long, text string")
    bench = spark.createDataFrame([(0, items[0]), (1, items[1]), (2, None), (3, ""), (4, "too short")], "item_id long, text string")
    for size in (1, 4 << 20):  # one item a block, and all at once
        rows = decontaminate.find_contamination(docs, bench, block_chars=size).collect()
        assert {(r["id"], r["item"], r["distance"]) for r in rows} == {(1, 0, 3), (None, 1, 0), (4, 4, 0)}
        assert {r["doc_id"] for r in decontaminate.keep_clean(docs, bench, block_chars=size).collect()} == {2, 3}
    assert decontaminate.find_contamination(docs, bench.limit(0)).count() == 0
    assert decontaminate.keep_clean(docs.limit(0), bench).count() == 0


def test_decontamination_keeps_columns(odd, spark):
    bench = spark.createDataFrame([(0, "jumps over the lazy dog while rain falls")], "item_id long, text string")
    kept = decontaminate.keep_clean(odd, bench)
    assert kept.dtypes == odd.dtypes and all("lazy" not in (r["text"] or "") for r in kept.collect()) and kept.count() == 8


def test_marginals_in_stretches_same_as_whole(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = np.array([0, 5, 700, 1, 0, 40, 3000, 2])
    first = toxicity._first(sizes)
    emission, transitions = rng.normal(0, 2, int(sizes.sum())), rng.normal(0, 1, (2, 2))
    whole, _ = toxicity.marginals(emission, first, transitions)
    for at_once in (1, 64, 257, 100_000):
        monkeypatch.setattr(toxicity, "TOKENS_AT_ONCE", at_once)
        if at_once > 1:
            assert np.allclose(toxicity.text_marginals(emission, first, transitions), whole, rtol=1e-9, atol=1e-12)
    assert len(toxicity.text_marginals(np.zeros(0), np.zeros(0, bool), transitions)) == 0


def test_scoring_keeps_no_long_words():
    own = toxicity.Vocabulary(keep=False)
    texts = ["a " + "x" * 500 + " b", "y" * 70]
    flat, sizes = own.tokens(texts)
    again, _ = own.tokens(texts)
    assert sizes.tolist() == [3, 1] and not own.long and set(own.numbers) == {"a", "b"}
    assert (own.buckets[flat] == own.buckets[again]).all() and set(own.words) == {None}
    assert toxicity.Vocabulary().tokens(texts)[0].tolist() == [0, 1, 2, 3]


def test_marginals_same_as_enumeration():
    rng = np.random.default_rng(0)
    sizes = np.array([3, 1, 0, 6])
    emission, transitions = rng.normal(size=10) * 2, rng.normal(size=(2, 2))
    p, joint = toxicity.marginals(emission, toxicity._first(sizes), transitions)
    at = 0
    for n in sizes.tolist():
        weights = {
            y: math.exp(sum(emission[at + i] * y[i] for i in range(n)) + sum(transitions[y[i - 1], y[i]] for i in range(1, n)))
            for y in itertools.product((0, 1), repeat=n)
        }
        total = sum(weights.values())
        for i in range(n):
            assert math.isclose(p[at + i], sum(w for y, w in weights.items() if y[i]) / total, rel_tol=1e-9)
            if i:
                both = sum(w for y, w in weights.items() if y[i - 1] and y[i]) / total
                assert math.isclose(joint[1, 1, at + i], both, rel_tol=1e-9)
        at += n


def test_long_chains_same_as_short_blocks():
    rng = np.random.default_rng(1)
    emission, sizes = rng.normal(size=5000), np.array([1, 4000, 999])
    whole, _ = toxicity.marginals(emission, toxicity._first(sizes), np.array([[0.3, -2], [-1, 0.5]]))
    parts = [toxicity.marginals(emission[a:b], np.arange(b - a) == 0, np.array([[0.3, -2], [-1, 0.5]]))[0] for a, b in ((0, 1), (1, 4001), (4001, 5000))]
    assert np.allclose(whole, np.concatenate(parts))


def test_op9_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    scored = QUERIES["op9_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = scored.filter("held_out").join(labels, "doc_id").select("doc_id", "score", "predicted", "toxic").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert all((r["score"] >= 0.5) == bool(r["predicted"]) for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.97 * len(rows)
    assert sum(r["predicted"] for r in rows if not r["toxic"]) <= 0.02 * len(rows)


TEXT_WORDS = "calm then a quiet text of plain words about rain hills rivers and long walks".split()


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, int(i in (1, 2))) for i in range(10)], "doc_id long, toxic int")
    rng = random.Random(2)
    calm = [" ".join(rng.choice(TEXT_WORDS) for _ in range(12)) for _ in range(200)]
    rude = [t.replace(" ", " swine ", 2) for t in calm[:60]]
    model = toxicity.fit(calm + rude, [0] * len(calm) + [1] * len(rude))
    out = toxicity.score(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)
    text = "calm then a swine! calm"
    spans = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()["spans"]
    assert [text[s["start"] : s["end"]] for s in spans] == ["swine!"]
    assert toxicity.keep_clean(odd, model).dtypes == odd.dtypes and toxicity.score(none, model).count() == 0
    assert toxicity.train(none, labels).base == 0.0 and toxicity.train(odd, labels.limit(0)).base == 0.0
    assert toxicity.train(odd, labels.filter("toxic = 1")).base in (0.0, 1.0)
    assert toxicity.train(odd, labels) is not None


def test_toxicity_without_toxic_words(spark):
    # a tenth of the labels is toxic, of texts like all others; at most five of each class are sampled
    docs = spark.createDataFrame([(i, "the same calm words in every text") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, max_labelled=5)
    known = labels.filter(~toxicity.held_out())
    assert model.base == known.agg(F.avg("toxic")).first()[0] and model.base < 0.2
    assert all(r["score"] == model.base for r in toxicity.score(docs, model).collect())
    toxic_only = toxicity.train(docs, labels.filter("toxic = 1"))
    for learned in (model, toxic_only):
        with pytest.warns(UserWarning, match="all rows are kept"):
            assert toxicity.keep_clean(docs, learned).count() == 200


def test_op10_same_as_sql(spark, sf_dir):
    assert differences(QUERIES["op10_preferences"](spark, sf_dir), connect(sf_dir), ORACLES["op10_preferences"]) == []


def test_preferences_of_odd_turns(spark):
    kind = "conv_id long, turn int, role string, text string, id string, turns int"
    chosen = spark.createDataFrame([
        (1, 0, "user", "hi", "x", 1), (1, 1, "assistant", "good", "x", 1), (2, 0, None, None, None, None), (2, 0, None, None, None, None),
        (3, 0, "user", "only chosen", "x", 1), (None, 0, "user", "no id", "x", 1),
    ], kind)
    rejected = spark.createDataFrame([
        (1, 0, "user", "hi", "y", 2), (1, 1, "assistant", "bad", "y", 2), (2, 0, None, None, None, None), (4, 0, "user", "only rejected", "y", 2),
    ], kind)
    rows = {r["id"]: r for r in preferences.format_preferences(chosen, rejected).filter("id is not null").collect()}
    assert rows[1]["prompt"] == "<|im_start|>user\nhi<|im_end|>\n" and rows[1]["n_shared"] == 1
    assert rows[1]["rejected"] == "<|im_start|>assistant\nbad<|im_end|>\n"
    assert [tuple(m) for m in rows[1]["chosen_mask"]] == [(len("<|im_start|>assistant\n"), 0), (len("good<|im_end|>\n"), 1)]
    assert rows[2]["n_shared"] == 1 and rows[2]["rejected"] == "" and rows[2]["chosen"] == "<|im_start|>unknown\n<|im_end|>\n"
    assert rows[3]["rejected"] == "" and rows[4]["chosen"] == "" and rows[4]["n_shared"] == 0
    for r in rows.values():
        assert sum(m["length"] for m in r["chosen_mask"]) == len(r["chosen"])
    assert preferences.format_preferences(chosen.limit(0), rejected.limit(0)).count() == 0
