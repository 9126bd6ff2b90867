"""Token ids, files, counts after edits: against the tokenizer libraries."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabreg.llm import byte_bpe, edit_counts, token_files
from tabreg.llm.queries import QUERIES
from tabreg.sources.shared import shared_path

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
ODD = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "a", "é", "1", "²", "!", "　", "\x1c", "中", "😀", "́", "S", "'S", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return byte_bpe.codec(open(RANKS, "rb").read())


def test_scan_is_associative():
    rng = np.random.default_rng(1)
    steps = rng.choice([byte_bpe.PLAIN, byte_bpe.HOLDS, byte_bpe.OPENS_TWO, byte_bpe.OPENS_THREE, byte_bpe.RESET], 1000).astype(np.uint8)
    state, want = 0, []
    for f in steps.tolist():
        state = f >> 2 * state & 3
        want.append(state)
    for block in (3, 16, 128, 2000):
        assert (byte_bpe.prefix_functions(steps, block) & 3).tolist() == want


def test_ids_of_odd_texts(own, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(5000)] + ["a" * 50_000, " " * 50_000 + "x"]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_new_pieces_merged_side_by_side_same_as_one_by_one(own):
    rng = random.Random(6)
    some = {"".join(rng.choice(kind) for _ in range(rng.randint(0, 50))) for kind in ("ab", "etaoins", "é中😀\0a", ODD) for _ in range(400)}
    learned = byte_bpe.Codec(own.ranks)
    learned.learn(some)
    assert len(learned) > 1000 and all(len(p.encode()) > byte_bpe.SHORT for p in some.difference(learned))
    for piece, ids in learned.items():
        assert np.frombuffer(ids, "<i4").tolist() == byte_bpe.merge(piece.encode(), own.ranks), piece
    few = byte_bpe.Codec({b"a": 0, b"b": 1, b"ab": 2})  # without all single bytes: one by one
    few.learn(["abab"])
    assert not few and few.encode(["abab"])[0].tolist() == [2, 2]


def test_op8_same_as_library(spark, sf_dir, small, library):
    for r in QUERIES["op8_byte_bpe"](spark, sf_dir).collect():
        text = small[r["doc_id"]]
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_of_odd_rows(odd, none, library):
    texts = {r["text"] or "" for r in odd.collect()}
    rows = byte_bpe.encode(odd, RANKS).collect()
    assert len(rows) == odd.count()
    assert {tuple(r["ids"]) for r in rows} == {tuple(library.encode_ordinary(t)) for t in texts}
    assert all((r["ends"][-1] if r["ends"] else 0) in {len(t.encode()) for t in texts} for r in rows)
    assert byte_bpe.encode(none, RANKS).count() == 0 and byte_bpe.encode_checked(odd, RANKS).filter("not round_trip").count() == 0


def library_ids(texts):
    known = Tokenizer.from_file(WORDS)
    return [np.array(e.ids + [2], "<u4") for e in known.encode_batch(texts, add_special_tokens=False)]


def test_op3_same_as_library(spark, sf_dir, small):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op3_token_files"](spark, sf_dir).collect()}
    start = 0
    for key, ids in zip(small, library_ids(list(small.values()))):
        assert got.pop(key) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_words_by_parts_same_as_whole_texts():
    rng = random.Random(2)
    alphabet = ODD + ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "a<|endoftext|>b.", "Σ", "ΑΣ", "İ", "ß", "don't", "word.", "it's,", "-", "̀e", "x̂"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    own = token_files.Words(open(WORDS, encoding="utf-8").read(), "<u4").encode(texts)
    for text, ids, want in zip(texts, own, library_ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == want[:-1].tolist(), text


def test_words_of_letters_meet_the_model_directly():
    rng = random.Random(8)
    definition = open(WORDS, encoding="utf-8").read()
    words = ["".join(rng.choice(kind) for _ in range(rng.randint(1, 9))) for kind in ("abcXYZ", "éÄñßoE", "aΣσb") for _ in range(300)]
    texts = [" ".join(w + rng.choice(["", ".", ",", "!?", "..\"", "1"]) for w in rng.choices(words, k=30)) for _ in range(60)]
    texts += ["A <|ENDOFTEXT|> B", "A <|endoftext|> B.", "Plain Words, ALL Ascii's", "H\u0331a H\u0331."]
    own = token_files.Words(definition, "<u4")
    calls, plain = [], own._encode_each
    own._encode_each = lambda some: calls.extend(some) or plain(some)
    for text, ids, want in zip(texts, own.encode(texts), library_ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == want[:-1].tolist(), text
    assert own.direct and not any(w.isascii() and w.isalpha() for w in calls)
    changed = json.loads(definition)
    changed["normalizer"]["normalizers"].append({"type": "Replace", "pattern": {"String": "a"}, "content": "b"})
    other = token_files.Words(json.dumps(changed), "<u4")
    assert not other.direct and other.encode(["a b"]) == other.encode(["b b"])


def test_letters_that_composing_takes_apart_keep_their_marks():
    texts = ["\u0958.", "a\u0958, \ufb4a!? \u212b. \u1100\u1161.", "\u0915\u093c.", "İ. ΑΣ.", "", " ", "\t\x0b\x1c\x85 . \u3000,"]
    own = token_files.Words(open(WORDS, encoding="utf-8").read(), "<u4").encode(texts)
    for text, ids, want in zip(texts, own, library_ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == want[:-1].tolist(), ascii(text)


def test_words_asked_for_again_are_learned_once(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 4)
    own = token_files.Words(open(WORDS, encoding="utf-8").read(), "<u2")
    learned, learn = [], own._learn
    own._learn = lambda some: learned.extend(some) or learn(some)
    for n in range(6):
        own.encode([f"Often été, often. ÉTÉ often' a{n}", f"often!? OFTEN <|endoftext|> été {n}"])
    assert {w: learned.count(w) for w in ("often", "été", "often'", "<|endoftext|>")} == {"often": 1, "été": 1, "often'": 1, "<|endoftext|>": 1}
    assert len(own.known) + len(own.old) < 30 and own.encode(["a0"]) == own.encode(["A0"])


@pytest.mark.parametrize("n", [1, 3, 1023, 1024, 65_537, 200_000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    tokens = np.minimum(rng.zipf(1.3, n), 40_000).astype(np.uint32)
    counts = np.bincount(tokens, minlength=49_000)
    model = token_files.Model(token_files.frequencies(counts))
    stream, states, places, crcs = token_files.encode_block(tokens, model)
    decoded = [token_files.decode_segment(s, n, stream, states, places, crcs, model) for s in reversed(range(len(states)))]
    assert (np.concatenate(decoded[::-1]) == tokens).all()
    if n > 2000:
        damaged = bytearray(stream)
        damaged[len(stream) // 2] ^= 1
        with pytest.raises(ValueError):
            for s in range(len(states)):
                token_files.decode_segment(s, n, bytes(damaged), states, places, crcs, model)


def test_files_of_odd_rows(spark, odd, none):
    rows = token_files.encode_documents(odd, WORDS, shared_path(spark, "files"), 2).orderBy("start").collect()
    keys = [r["id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and len(rows) == odd.count()
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
    assert sum(r["n_tokens"] == 1 for r in rows) == 4  # null, null, empty, blank
    assert token_files.encode_documents(none, WORDS, shared_path(spark, "files"), 2).count() == 0


def test_edits_same_as_new_split(own):
    rng = random.Random(4)
    text_of = lambda n: "".join(rng.choice(ODD[:-1]) for _ in range(rng.randint(0, n)))
    for _ in range(600):
        text = text_of(rng.choice([5, 40, 600]))
        tree = edit_counts.DocumentTree.of(own, text, byte_bpe.pieces([text])[0])
        for _ in range(rng.randint(1, 6)):
            at, removed, inserted = rng.randint(-2, len(text) + 3), rng.choice([0, 0, 1, 20, 400]), text_of(rng.choice([2, 30]))
            start = min(max(0, at), len(text))
            text = text[:start] + inserted + text[min(len(text), start + removed) :]
            tree.edit(at, removed, inserted)
            new = byte_bpe.pieces([text])[0]
            assert tree.state()[0] == text and tree.state()[1].tolist() == [len(p) for p in new]
            assert tree.tokens.total() == sum(len(own[p]) // 4 for p in new)


def test_op5_same_as_new_encoding(spark, sf_dir, small, library):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op5_edit_counts"](spark, sf_dir).collect():
        d = docs[r["doc_id"]]
        middle = len(d["text"]) // 2
        text = f"{d['source']}\n{d['text']}"
        text = text[:middle] + text[middle + 7 :] + " " + d["lang"]
        assert (r["n_before"], r["n_after"]) == (len(library.encode_ordinary(d["text"])), len(library.encode_ordinary(text)))
        assert r["n_encoded"] < 40


def test_edits_of_many_documents_are_split_together(monkeypatch):
    with open(RANKS, "rb") as file:
        own = byte_bpe.codec(file.read())
    texts = [("it's one, two  three " * (n % 7) * 9)[n:] for n in range(30)] + [""]
    edits = [[{"at": n * 3, "removed": n % 5, "inserted": " new's"}, None, {"at": 1 << 30, "removed": None, "inserted": "x"}] for n in range(31)]
    split = lambda: [edit_counts.DocumentTree.of(own, t, p) for t, p in zip(texts, byte_bpe.pieces(texts))]
    alone, together, calls = split(), split(), []
    for tree, wanted in zip(alone, edits):
        for e in filter(None, wanted):
            tree.edit(e["at"], e["removed"] or 0, e["inserted"])
    monkeypatch.setattr(edit_counts, "pieces", lambda some: calls.append(len(some)) or byte_bpe.pieces(some))
    edit_counts.in_step([edit_counts._one_by_one(tree, wanted) for tree, wanted in zip(together, edits)])
    assert calls[0] == 31 and len(calls) <= 6
    for a, b in zip(alone, together):
        assert a.n_encoded == b.n_encoded and all(np.array_equal(x, y) for x, y in zip(a.state(), b.state()))
        text = b.state()[0]
        assert b.tokens.total() == sum(map(len, own.encode([text])))


def test_edits_as_a_table(spark, odd, none, library):
    trees = edit_counts.build_trees(odd, RANKS)
    edits = spark.createDataFrame(
        [(1, 2, 3, 2, "new"), (1, 1, None, None, "first "), (4, 1, 0, 0, "filled"), (99, 1, 0, 0, "x"), (6, 1, 1000, 5000, None), (2, 1, 5, -3, None)],
        "doc_id long, seq long, at int, removed int, inserted string",
    )
    rows = edit_counts.apply_edits(trees, edits, RANKS).collect()
    assert len(rows) == odd.count() and all(r["n_tokens"] == len(library.encode_ordinary(r["text"])) for r in rows)
    text = next(r["text"] for r in odd.collect() if r["doc_id"] == 2)
    changed = "first " + text
    assert [r["text"] for r in rows if r["id"] == 1] == [changed[:3] + "new" + changed[5:]] * 2
    assert [r["text"] for r in rows if r["id"] == 4] == ["filled"] and [r["text"] for r in rows if r["id"] == 2] == [text]
    assert edit_counts.apply_edits(edit_counts.build_trees(none, RANKS), edits, RANKS).count() == 0
    assert edit_counts.apply_edits(trees, edits.limit(0), RANKS).agg(F.sum("n_encoded")).first()[0] == 0


def test_edits_of_a_hot_id(spark):
    """A third of the rows under one id, another third under none: each tree is edited by itself."""
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else 1000 + i, f"text {i} of it") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    edits = spark.createDataFrame(
        [(7, 2, 0, 4, "word"), (7, 1, 0, 0, "a "), (None, 1, 0, 0, "none "), (1002, 1, 0, 5, None)], "doc_id long, seq long, at int, removed int, inserted string"
    )
    found = Counter((r["id"], r["text"]) for r in edit_counts.apply_edits(edit_counts.build_trees(docs, RANKS), edits, RANKS).collect())
    changed = {7: lambda t: "word" + ("a " + t)[4:], None: lambda t: "none " + t, 1002: lambda t: t[5:]}
    assert found == Counter((d, changed.get(d, lambda t: t)(t)) for d, t in rows)
