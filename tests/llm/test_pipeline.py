"""The whole pipeline against its stages in plain Python."""

from __future__ import annotations

import base64

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from tabreg.llm import decontaminate, toxicity
from tabreg.llm.common import read_table
from tests.llm.test_near_and_repeats import plain_one_of_each, plain_runs


def test_run_same_as_plain_stages(spark, sf_dir):
    """Repeated runs with any word go, near copies are linked fingerprints, and items of any length count."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    rows = {r["doc_id"]: r["text"] for r in docs.orderBy("doc_id").collect()}
    rows = {d: t for d, t in rows.items() if toxicity._score(model, [t])[0][0] < 0.5}
    rows = dict(zip(rows, plain_runs(list(rows.values()), 1)))
    stay = plain_one_of_each(list(rows.items()))
    items = [(r["item_id"], r["text"]) for r in read_table(spark, sf_dir, "benchmark").collect()]
    known = decontaminate.Items(items, 0.2, 1)
    rows = {d: t for d, t in rows.items() if d in stay and not known.matches(t)}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(corpus_pipeline.RANKS), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in out} == {d: library.encode_ordinary(t) for d, t in rows.items()}
    assert all(r["round_trip"] for r in out) and len(out) == len(rows)


def test_stages_on_odd_rows(spark, sf_dir, odd, none):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd, none):
        for _, apply in corpus_pipeline.STAGES[:-1]:
            docs = apply(spark, docs, sf_dir)
            assert docs.columns[:5] == columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
