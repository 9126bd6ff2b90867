"""Conversation repair, Merkle manifest and licence scan against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tabreg.llm import licences, manifest, queries, repair
from tests.oracle import connect, differences

BLANKS = " \t\n\x0b\x0c\r"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_repair(rows):
    """Facts of ordered rows (turn, role, text) by dynamic programming over (cost, edits), last turn first."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    wanted = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, ""), "a": (0, ""), "u": (3, "I"), "s": (6, "II")}
    for (_, role, _), fault in zip(reversed(rows), reversed(faults)):
        now = {}
        for state in ("", "s", "u", "a"):
            found = [(best[state][0] + 4, "D" + best[state][1])]
            if fault in ("", "t"):
                more = 3 if fault else 0
                if (state, role[:1]) in STEP:
                    cost, rest = best[STEP[state, role[:1]]]
                    found.append((cost + more, "K" + rest))
                cost, rest = best[wanted[state]]
                found.append((cost + more + 3, "R" + rest))
            now[state] = min(found)
        for _ in range(4):  # any number of inserts in front of the turn
            now = {s: min(now[s], (now[wanted[s]][0] + 3, "I" + now[wanted[s]][1])) for s in now}
        best = now
    cost, audit = best[""]
    lines, state, at = [], "", 0
    for edit in audit:
        letter = wanted[state]
        if edit != "I":
            _, role, text = rows[at]
            at += 1
            if edit == "D":
                continue
            if edit == "K":
                letter = role[:1]
            lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[letter]}:{text}")
        else:
            lines.append({"u": "user", "a": "assistant"}[letter] + ":")
        state = letter
    letters = [role[:1] for _, role, _ in rows]
    assert re.fullmatch(r"(s?(ua)+)?", "".join(line[0] for line in lines))
    numbers = [t for t, _, _ in rows if t is not None]
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults.count("b"), faults.count("d"), faults.count("t"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:])), cost, audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def in_order(rows):
    """Turns as the operator orders them; the last key only parts turns that begin alike."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1][:32], r[2][:32]))


def random_turns(rng, n):
    roles = ["user", "assistant", "system", "tool", "user", "assistant", ""]
    texts = ["Yes.", "No!", "and", " \n", "", "Why?", "a. b"]
    return [(None if rng.random() < 0.1 else rng.randrange(n + 2), rng.choice(roles), rng.choice(texts) + (str(i) + "." if rng.random() < 0.5 else "")) for i in range(n)]


def columns(found):
    return {r["id"]: tuple(r)[1:] for r in found.collect()}


@pytest.mark.parametrize("block", [64, 3, 1])
def test_repair_same_as_plain(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    turns = {c: random_turns(rng, rng.randrange(1, 14)) for c in range(120)} | {120: random_turns(rng, 150)}
    rows = [(c, *t, "x") for c, ts in turns.items() for t in ts]
    rng.shuffle(rows)
    # the setting is read where blocks are cut, in the workers
    monkeypatch.setattr(repair, "_cut", _cut_with(block))
    found = columns(repair.repair_conversations(spark.createDataFrame(rows, "conv_id int, turn long, role string, text string, key string").repartition(5)))
    assert found == {c: plain_repair(in_order(ts)) for c, ts in turns.items()}


def _cut_with(block):
    def cut(batches):
        from tabreg.llm import repair as module

        module.BLOCK = block
        return module._cut(batches)

    return cut


def test_search_same_as_all_edits():
    """Every row of up to seven edits, tried out, for all conversations of up to three turns."""
    kinds = [(letter, fault) for letter in "sua" for fault in range(4)] + [("t", 0)]
    letters = {"D": 4, "I": 3, "K": 0, "R": 3}

    def cost_of(edits, turns):
        state, at, cost = repair.START, 0, 0
        for e in edits:
            if e != "I" and at == len(turns):
                return None
            letter, fault = turns[at] if e != "I" else ("", 0)
            at += e != "I"
            cost += letters[e]
            if e == "D":
                continue
            if e in "KR" and fault in (1, 2) or e == "K" and (state, letter) not in repair.NEXT:
                return None
            cost += 3 if e != "I" and fault == 3 else 0
            state = repair.NEXT[state, letter if e == "K" else repair.WANTED[state]]
        return cost if at == len(turns) and state in repair.ACCEPTING else None

    every = ["".join(e) for n in range(6) for e in itertools.product("DIKR", repeat=n)]
    for turns in itertools.chain([()], itertools.product(kinds, repeat=1), itertools.product(kinds, repeat=2), itertools.islice(itertools.product(kinds, repeat=3), 0, None, 17)):
        assert repair.solve(turns) == min((c, e) for e in every if (c := cost_of(e, turns)) is not None)


def test_repair_of_odd_rows(spark):
    schema = "conv_id string, turn int, role string, text string, fault int, row string"
    rows = [
        (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, None, None, "x."), ("", None, "user", None), ("a", 2, "user", "Hi."),
        ("a", 2, "user", "Hi."), ("b", 5, "assistant", "long " * 40_000 + "."),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    plain = {}
    for c, *turn in rows:
        plain.setdefault(c, []).append((turn[0], turn[1] or " ", " " if turn[2] is None else turn[2]))
    assert columns(repair.repair_conversations(df)) == {c: plain_repair(in_order(ts)) for c, ts in plain.items()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    only_listed = repair.repair_conversations(df, present=F.col("conv_id") == "a")
    assert columns(only_listed) == {None: nothing, "": nothing, "b": nothing, "a": plain_repair([(2, "user", "Hi."), (2, "user", "Hi.")])}
    assert repair.repair_conversations(df.limit(0)).collect() == []


def test_repair_of_one_hot_conversation(spark):
    """A third of all rows in one conversation, half of these rows alike."""
    rng = random.Random(5)
    hot = [(7, i, rng.choice(["user", "assistant"]), f"t{i}.") for i in range(1500)] + [(7, 3, "user", "same.")] * 1500
    rows = hot + [(100 + i // 4, i % 4, ["user", "assistant"][i % 2], f"text {i}.") for i in range(6000)]
    found = columns(repair.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)))
    assert len(found) == 1501 and found[7] == plain_repair(in_order([r[1:] for r in hot]))
    assert all(found[100 + i][5:7] == (0, "KKKK") for i in range(1500))


def test_op11_same_as_plain(spark, sf_dir):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{sf_dir}/conversations.parquet' ORDER BY 1, 2").fetchall()
    turns = {c: [] for c, *_ in rows}
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        turns[conv] += [(turn, "user" if draw == 4 else role, text)] * {0: 0, 3: 2}.get(draw, 1)
    found = {r["conv_id"]: tuple(r)[1:] for r in queries.op11_repair(spark, sf_dir).collect()}
    assert found == {c: plain_repair(ts) for c, ts in turns.items()}


# --- manifest --------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes, arity):
    """(root, proof of each node) by plain levels."""
    proofs, owners = ["" for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for at in range(0, len(nodes), arity):
            run = nodes[at : at + arity]
            for j in range(len(run)):
                for owner in owners[at + j]:
                    proofs[owner] += "".join(run[:j] + run[j + 1 :])
            above.append(sha("".join(run)))
            held.append([o for owned in owners[at : at + arity] for o in owned])
        nodes, owners = above, held
    return nodes[0], proofs


@pytest.mark.parametrize("arity, levels, sizes", [(2, 2, [1, 7, 64, 3]), (3, 1, [10, 1, 27]), (4, 3, [70, 5]), (2, 6, [1]), (2, 1, [33])])
def test_manifest_same_as_plain(spark, arity, levels, sizes):
    rows = [(i * 3 % 101, g or None, f"text {i}", "x") for g, n in zip("abcd", sizes) for i in range(n)]
    rows = [(i, None if g == "b" else g, t, x) for i, g, t, x in rows]
    df = spark.createDataFrame(rows, "id long, group string, text string, pos string").repartition(4)
    found = manifest.build(df, ["id", "group", "text"], "id", "group", arity, levels)
    leaf = {r: sha(f"{len(str(r[0]))}:{r[0]}" + ("-" if r[1] is None else f"{len(r[1])}:{r[1]}") + f"{len(r[2])}:{r[2]}") for r in rows}
    groups = sorted({r[1] for r in rows}, key=lambda g: (g is not None, g))
    ordered = {g: [leaf[r] for r in sorted((r for r in rows if r[1] == g), key=lambda r: (r[0], leaf[r]))] for g in groups}
    trees = {g: plain_tree(nodes, arity) for g, nodes in ordered.items()}
    root, tops = plain_tree([trees[g][0] for g in groups], arity)
    expected = sorted((h, trees[g][0], p + top) for g, top in zip(groups, tops) for h, p in zip(ordered[g], trees[g][1]))
    assert found.root == root
    assert sorted((r["leaf"], r["subroot"], r["proof"]) for r in found.proofs.collect()) == expected
    folded = found.proofs.select(manifest.fold(found).alias("good"), manifest.fold(found, F.sha2("leaf", 256)).alias("bad")).distinct().collect()
    assert {r["good"] for r in folded} == {root} and root not in {r["bad"] for r in folded}


def test_manifest_of_odd_rows(spark, odd, none):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    found = manifest.build(odd, fields, "doc_id", "lang")
    rows = found.proofs.withColumn("folded", manifest.fold(found)).collect()
    assert len(rows) == odd.count() and {r["folded"] for r in rows} == {found.root}
    assert len({r["leaf"] for r in rows}) == odd.select(*fields).distinct().count()
    empty = manifest.build(none, fields, "doc_id", "lang")
    assert empty.root is None and empty.proofs.collect() == [] and empty.proofs.withColumn("f", manifest.fold(empty)).collect() == []


def test_manifest_of_many_equal_rows(spark):
    rows = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("en").alias("lang"), F.lit("same").alias("text"))
    found = manifest.build(rows.unionByName(rows.limit(50).withColumn("lang", F.lit(None).cast("string"))), ["text"], "doc_id", "lang", levels=3)
    shown = found.proofs.groupBy("group").agg(F.countDistinct("position").alias("n"), F.max("position").alias("last"), F.countDistinct(manifest.fold(found)).alias("roots"))
    assert sorted(tuple(r) for r in shown.collect() if r["group"]) == [("en", 3000, 2999, 1)] and shown.count() == 2


def test_op12_same_as_sql(spark, sf_dir):
    df = queries.op12_manifest(spark, sf_dir).persist()
    assert differences(df, connect(sf_dir), queries.ORACLES["op12_manifest"]) == []
    for row in df.select("doc_id", "verified").collect():
        assert row["verified"] == (zlib.crc32(str(row["doc_id"]).encode()) % 7 != 0)


# --- licences --------------------------------------------------------------

CLASS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_notices(text):
    words = CLASS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    found = [
        (i, label) for phrase, (label, _) in licences.PHRASES.items() for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(words), sorted(found)


TEXTS = [
    None, "", " \n", "CC BY cc-by cc  by CC BY ccby", "All rights\nreserved. ALL RIGHTS RESERVED all rights", "the GNU Lesser General Public License",
    "Licensed under CC BY-NC 4.0.", "cc by cc by nc cc", "é general public license é", "general public licenseé", "x" * 70_000 + " cc by " + "y" * 70_000,
    "word " * 40_000 + "cc by" + " word" * 40_000,
]


def test_notices_same_as_plain(spark, monkeypatch):
    for block in (1 << 20, 64, 7):
        monkeypatch.setattr(licences, "BLOCK", block)
        for text in TEXTS if block > 7 else TEXTS[:-2]:
            found = licences.scan_text((text or "").encode())
            assert (found["n_words"], [(n["word"], n["label"]) for n in found["notices"]]) == plain_notices(text)


# An expression, whether it is whole, its ids, its restriction.
EXPRESSIONS = [
    ("MIT", True, ["mit"], 0.1),
    ("GPL-2.0-only OR MIT", True, ["gpl-2.0-only", "mit"], 0.1),
    ("MIT AND GPL-2.0-or-later", True, ["mit", "gpl-2.0-or-later"], 0.8),
    ("MIT OR GPL-2.0-only AND AGPL-3.0-only", True, ["mit", "gpl-2.0-only", "agpl-3.0-only"], 0.1),
    ("(MIT OR GPL-2.0-only) AND LGPL-2.1+", True, ["mit", "gpl-2.0-only", "lgpl-2.1"], 0.6),
    ("GPL-2.0-only WITH Classpath-exception-2.0", True, ["gpl-2.0-only"], 0.4),
    ("GPL-2.0-only WITH Classpath-exception-2.0 OR AGPL-3.0-only", True, ["gpl-2.0-only", "agpl-3.0-only"], 0.4),
    ("LicenseRef-Own", True, ["licenseref-own"], 0.9),
    ("(MIT AND GPL-2.0-only", False, ["mit", "gpl-2.0-only"], 0.8),
    ("MIT AND", False, ["mit"], 0.1),
    ("MIT */ or so", True, ["mit"], 0.1),
    ("MIT.", True, ["mit"], 0.1),
    ("((MIT))", True, ["mit"], 0.1),
    ("MIT)", True, ["mit"], 0.1),
]


@pytest.mark.parametrize("text, whole, ids, restriction", EXPRESSIONS)
def test_expressions(text, whole, ids, restriction):
    found = licences.scan_text(f"# SPDX-License-Identifier: {text}\nnext line AND more".encode())
    (expression,) = found["expressions"]
    assert (expression["whole"], expression["ids"]) == (whole, ids) and abs(expression["restriction"] - restriction) < 1e-12
    assert found["score"] == expression["restriction"] and set(ids) <= set(found["labels"]) and ("malformed" in found["labels"]) == (not whole)


def test_tags_in_prose_and_over_blocks(monkeypatch):
    read = lambda text: [(e["expression"], e["restriction"]) for e in licences.scan_text(text.encode())["expressions"]]
    assert read("License: see the file. Licence: MIT or others. license=Apache-2.0, really") == [("MIT", 0.1), ("Apache-2.0", 0.1)]
    assert read("SPDX-License-Identifier: \nMIT") == [] and read("SPDX-License-Identifier:") == []
    many = "SPDX-License-Identifier: MIT or " * 3000 + "MIT"
    whole = read(many)
    for block in (50, 1000):
        monkeypatch.setattr(licences, "BLOCK", block)
        assert read(many) == whole


def test_scan_of_odd_rows(spark, odd, none, sf_dir):
    rows = licences.scan_licences(odd).collect()
    plain = sorted((str(r["doc_id"]), plain_notices(r["text"])) for r in odd.collect())
    assert sorted((str(r["id"]), (r["n_words"], [(n["word"], n["label"]) for n in r["notices"]])) for r in rows) == plain
    assert licences.scan_licences(none).collect() == []


def test_op13_same_as_plain(spark, sf_dir, small):
    for row in queries.op13_licences(spark, sf_dir).collect():
        n, found = plain_notices(small[row["doc_id"]])
        base = [(w, label) for w, label in found if label in licences.BASE]
        words = [w for w, _ in base]
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (n, len(base), min(words, default=None), max(words, default=None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in base}))
        assert set(row["labels"].split(",")) >= {label for _, label in found} and 0 <= row["score"] <= 1
