"""Licence scan: tags and notice phrases by Aho-Corasick, licence expressions by shunting yard.

Two automata pass over each text once. One reads its words (runs of letters, digits and non-ASCII characters, A-Z
lower-cased) and finds notice phrases wherever their words stand consecutively, overlaps included. The other reads the
characters and finds identifier tags (``SPDX-License-Identifier:``, ``License:`` ...). What follows a tag on its line is read as a
licence expression, as far as it is one: ``and``, ``or``, ``with``, parentheses and licence ids in any case, ``with``
binding closest and ``or`` loosest.

An expression has a restriction from 0 (anything goes) to 1 (no use without leave): the sum of obligations under ``and`` is
its strictest part, a choice under ``or`` its mildest, and an exception (``with``) halves what it is granted from. The
score of a text is the highest restriction of its phrases and expressions, 0 where nothing is found. Labels are the
phrases' labels and the ids of expressions, without a trailing plus sign. After an SPDX tag any id counts; after other tags, which prose uses too, only known
ids do. Where an SPDX tag is followed by something that is no whole expression (a missing bracket, say), its ids are still labels, next to
``malformed``, and the strictest counts.

One row per input row, in one narrow pass: null text is empty, with no words and score 0; repeated rows and null ids give a row each; an
empty table gives an empty result; extra columns are ignored. A text is read in blocks of bounded size that overlap by the longest
phrase, so memory beyond the text itself follows its finds, and blocks change no result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import per_batch

# Notice phrases by words, their label, and their restriction. The first three are the base set.
PHRASES = {
    "cc by": ("cc-by", 0.3),
    "general public license": ("gpl", 0.8),
    "all rights reserved": ("reserved", 1.0),
    "affero general public license": ("agpl", 0.9),
    "apache license": ("apache", 0.1),
    "bsd license": ("bsd", 0.1),
    "cc by nc": ("cc-by-nc", 0.7),
    "cc by nc nd": ("cc-by-nc-nd", 0.8),
    "cc by nc sa": ("cc-by-nc-sa", 0.75),
    "cc by nd": ("cc-by-nd", 0.6),
    "cc by sa": ("cc-by-sa", 0.5),
    "cc0": ("cc0", 0.0),
    "creative commons": ("creative-commons", 0.3),
    "do not redistribute": ("reserved-distribution", 1.0),
    "eclipse public license": ("epl", 0.5),
    "lesser general public license": ("lgpl", 0.6),
    "mit license": ("mit", 0.1),
    "mozilla public license": ("mpl", 0.5),
    "permission is hereby granted free of charge": ("permission", 0.1),
    "public domain": ("public-domain", 0.0),
    "redistribution and use in source and binary forms": ("redistribution", 0.1),
    "the unlicense": ("unlicense", 0.0),
}
BASE = ("cc-by", "gpl", "reserved")

# Tags in front of an expression.
SPDX_TAG = "spdx-license-identifier:"
TAGS = (SPDX_TAG, "license:", "licence:", "license =", "license=")

# Beginnings of known licence ids and their restriction; the longest beginning counts.
KNOWN = {
    "0bsd": 0.0, "afl-": 0.1, "agpl-": 0.9, "apache-": 0.1, "artistic-": 0.3, "bsd-": 0.1, "bsl-1.0": 0.1, "cc-by-": 0.3, "cc-by-nc-": 0.7,
    "cc-by-nc-nd-": 0.8, "cc-by-nc-sa-": 0.75, "cc-by-nd-": 0.6, "cc-by-sa-": 0.5, "cc0-": 0.0, "cddl-": 0.5, "epl-": 0.5, "eupl-": 0.6, "gfdl-": 0.7,
    "gpl-": 0.8, "isc": 0.1, "lgpl-": 0.6, "mit": 0.1, "mpl-": 0.5, "ms-pl": 0.3, "odbl-": 0.5, "ofl-": 0.3, "python-": 0.1, "unlicense": 0.0, "wtfpl": 0.0,
    "zlib": 0.1,
}
UNKNOWN_ID, EXCEPTION = 0.9, 0.5

#: Letters a-z stay, A-Z become them, digits and bytes of non-ASCII characters stay, all else parts words.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
LONGEST = max(len(p.split()) for p in PHRASES)
BLOCK = 1 << 20
TOKEN = re.compile(rb"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
BINDING = {"or": 1, "and": 2, "with": 3}

NOTICE = pa.struct([("word", pa.int64()), ("label", pa.string())])
EXPRESSION = pa.struct([
    ("at", pa.int64()), ("expression", pa.string()), ("ids", pa.list_(pa.string())), ("whole", pa.bool_()), ("restriction", pa.float64()),
])
RESULT = {
    "n_words": pa.int64(), "notices": pa.list_(NOTICE), "expressions": pa.list_(EXPRESSION), "labels": pa.list_(pa.string()), "score": pa.float64(),
}
RESULT_DDL = (
    "n_words long, notices array<struct<word:long,label:string>>, "
    "expressions array<struct<at:long,expression:string,ids:array<string>,whole:boolean,restriction:double>>, "
    "labels array<string>, score double"
)


@functools.cache
def _automata() -> tuple:
    words, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, (label, restriction) in PHRASES.items():
        words.add_word(f" {phrase} ", (len(phrase) + 1, len(phrase.split()), label, restriction))
    for tag in TAGS:
        tags.add_word(tag, tag)
    words.make_automaton()
    tags.make_automaton()
    return words, tags


def _beginnings(licence: str) -> list[str]:
    return [k for k in KNOWN if licence == k or (k.endswith("-") and licence.startswith(k))]


def restriction_of(licence: str) -> float:
    """Restriction of one licence id, by the longest known beginning."""
    known = _beginnings(licence)
    return KNOWN[max(known, key=len)] if known else UNKNOWN_ID


def parse_expression(raw: bytes, at: int = 0, any_id: bool = True) -> dict | None:
    """The licence expression that begins at byte ``at``: its end, text, ids, whether it is whole, and its restriction; None if there is none.

    Shunting yard: operators wait on a stack until one that binds no closer, or a closing bracket, arrives. Reading ends at the first token
    that cannot follow, a line end among them. Without ``any_id`` an unknown id ends it too, and an operator in front of that is not part of it.
    """
    values: list[float] = []
    waiting: list[str] = []
    ids: list[str] = []
    operand, start, end = True, at, at

    def settle(least: int) -> None:
        while waiting and waiting[-1] != "(" and BINDING[waiting[-1]] >= least:
            operator, right, left = waiting.pop(), values.pop(), values.pop()
            values.append(left * EXCEPTION if operator == "with" else max(left, right) if operator == "and" else min(left, right))

    while token := TOKEN.match(raw, at):
        bracket, word = [(part or b"").decode().lower() for part in token.groups()]
        excepted = bool(waiting) and waiting[-1] == "with"
        if bracket == "(":
            if not operand or excepted:
                break
            waiting.append("(")
            end = token.end()
        elif bracket == ")":
            if operand or "(" not in waiting:
                break
            settle(1)
            waiting.pop()
            end = token.end()
        elif word in BINDING:
            if operand:
                break
            settle(BINDING[word])
            waiting.append(word)
            operand = True
        else:
            word = word.rstrip(".:")
            licence = word.rstrip("+")
            if not operand or not (any_id or excepted or _beginnings(licence)):
                break
            values.append(0.0 if excepted else restriction_of(licence))
            if not excepted:
                ids.append(licence)
            operand, end = False, token.start(2) + len(word)
        at = token.end()
    if not ids:
        return None
    if operand and not any_id and waiting and waiting[-1] != "(":
        waiting.pop()
        operand = False
    whole = not operand and "(" not in waiting
    if whole:
        settle(1)
    return {
        "at": start, "expression": raw[start:end].decode().strip(" \t"), "ids": ids, "whole": whole,
        "restriction": values[0] if whole else max(map(restriction_of, ids)), "end": end,
    }


def _blocks(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size; a word is never cut."""
    at = 0
    while at < len(raw):
        stop = min(len(raw), at + BLOCK)
        spaced = raw[at:stop].translate(WORDS)
        while stop < len(raw) and (cut := spaced.rfind(b" ")) < 0:  # one word so far
            stop = min(len(raw), 2 * stop - at)
            spaced = raw[at:stop].translate(WORDS)
        if stop < len(raw):
            spaced = spaced[: cut + 1]
        yield spaced.split()
        at += len(spaced)


def _notices(raw: bytes) -> tuple[int, list[tuple[int, str, float]]]:
    """(words, [(word at which a phrase begins, label, restriction)]) of a text."""
    automaton, found, n, kept = _automata()[0], [], 0, []
    for words in _blocks(raw):
        block = kept + words
        text = " " + " ".join(w.decode("latin-1") for w in block) + " "
        hits = list(automaton.iter(text))
        spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32) if hits else []
        for end, (size, width, label, restriction) in hits:
            first = int(np.searchsorted(spaces, end - size))
            if first + width > len(kept):  # else the block before had it whole
                found.append((n - len(kept) + first, label, restriction))
        n += len(words)
        kept = block[1 - LONGEST :]
    return n, found


def _expressions(raw: bytes) -> list[dict]:
    """What the tags are followed by, in the order of the text; a tag within an expression is part of it."""
    automaton, overlap, past, found = _automata()[1], max(map(len, TAGS)) - 1, 0, []
    for at in range(0, len(raw), BLOCK):
        low = max(0, at - overlap)
        for end, tag in automaton.iter(raw[low : at + BLOCK].lower().decode("latin-1")):
            after = low + end + 1
            if after <= at or after <= past:
                continue
            parsed = parse_expression(raw, after, tag == SPDX_TAG)
            if parsed and (parsed["whole"] or tag == SPDX_TAG):
                past = parsed.pop("end")
                found.append(parsed)
    return found


def scan_text(raw: bytes) -> dict:
    """All finds of one UTF-8 text."""
    n, notices = _notices(raw)
    expressions = _expressions(raw)
    labels = {label for _, label, _ in notices} | {i for e in expressions for i in e["ids"]}
    if any(not e["whole"] for e in expressions):
        labels.add("malformed")
    score = max([value for _, _, value in notices] + [e["restriction"] for e in expressions], default=0.0)
    return {
        "n_words": n, "notices": [{"word": w, "label": label} for w, label, _ in sorted(notices)], "expressions": expressions,
        "labels": sorted(labels), "score": score,
    }


def _scan(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [scan_text(t.as_py() if t.is_valid else b"") for t in batch.column("text")]
    columns = [pa.array([r[name] for r in rows], kind) for name, kind in RESULT.items()]
    return pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", *RESULT])


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, notices, expressions, labels, score) of every row; places count words (notices) and bytes (expressions)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(per_batch(_scan), f"id {kind}, {RESULT_DDL}")
