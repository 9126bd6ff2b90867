"""Conversation structure repair by iterative-deepening A*.

A conversation shall read ``(s?(ua)+)?`` by the first letters of its roles: nothing, or an optional system turn and then pairs of user and
assistant. Faults of a turn, the first counts: ``blank`` (no character but blanks), ``duplicate`` (role and text stood earlier in the
conversation), ``truncated`` (does not end in ``.``, ``!`` or ``?``). Edits, by their letter: D deletes a turn (cost 4, the only edit for
blank and duplicate ones), I inserts an empty user or assistant turn (3), K keeps a turn (0), R gives it the role user or assistant (3); a
truncated turn that is not deleted costs 3 more. The answer is the cheapest row of edits, the first in ASCII order among those.

The search goes depth first through the edits in ASCII order, under a bound of cost that rises by one; what remains to be
paid at least (each turn's cheapest edit) cuts branches, and a table of failed states keeps, for (turn, state), the largest rest of the bound that
did not suffice. As deeper bounds come later and branches in ASCII order, the first accepting path is the answer. Which role I and R give follows
from the state, as the pattern allows one of the two only.

Turns are ordered by number (null first), then by the beginning of role and of text, then by a hash of both: rows alike stand together.
A range sort deals them out, so that a conversation may span partitions. Each partition cuts its stretch of a conversation into blocks
of at most ``BLOCK`` turns. A conversation of one block, inside one partition, is answered there. For blocks of any other, the search runs from each
state of the pattern to each other; a second pass joins blocks one after the other by cost, then ASCII order. That is exact: what is inserted between blocks counts
to the later one, so that no two ways through the same turns begin one with the other, and the order of wholes follows the order of parts. A third pass hashes their texts in order.
These passes see bounded rows per block; only the digest of one conversation is a stream through one task, as SHA-256 wants.

A null role or text counts as one space, so a turn with null text is blank; a null turn number is no number (gaps leaves it out) and comes first. Rows
with a null id are one conversation. A turn whose role is empty fits nowhere and cannot be kept. Rows that ``present`` marks false only
list their conversation: without others it has zeros, no edits and the hash of no text. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import parts, stage

BLOCK = 64
BLANKS = " \t\n\x0b\x0c\r"

# Costs of the edits, and faults by number.
DELETE, INSERT, RENAME, CUT = 4, 3, 3, 3
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

# States of the pattern: nothing read, after system, after user, after assistant. A turn of this letter leads to that state.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = {
    (START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U,
}
WANTED = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
ACCEPTING = (START, AFTER_A)
LEGAL_PAIRS = ("su", "ua", "au")
NAMES = {"u": "user", "a": "assistant"}


def _leads(turns: tuple, entry: int, exit: int) -> bool:
    """Whether edits without an insert at the end lead from one state to the other; a system turn cannot be inserted, nothing leads back to the start."""
    if not turns:
        return entry == exit
    kept = any(letter == "s" and fault in (NONE, TRUNCATED) for letter, fault in turns)
    return exit in (AFTER_U, AFTER_A) or entry == exit or (entry == START and exit == AFTER_S and kept)


@functools.lru_cache(maxsize=1 << 16)
def solve(turns: tuple, entry: int = START, exits: tuple = ACCEPTING, whole: bool = True) -> tuple[int, str] | None:
    """(cost, edits) from state ``entry`` to one of ``exits`` over turns (letter, fault); None where no edits lead there.

    Without ``whole`` the last edit is not an insert: more turns follow, and what is inserted in front of them is theirs.
    """
    n = len(turns)
    if not whole and not any(_leads(turns, entry, e) for e in exits):
        return None
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        fault = turns[i][1]
        least[i] = least[i + 1] + (DELETE if fault in (BLANK, DUPLICATE) else min(DELETE, CUT) if fault == TRUNCATED else 0)
    failed: dict[tuple[int, int], int] = {}

    def search(i: int, state: int, left: int) -> str | None:
        """Edits from turn ``i`` on that cost at most ``left``."""
        if left < least[i] or failed.get((i, state), -1) >= left:
            return None
        if i == n and state in exits:
            return ""
        if i < n:
            letter, fault = turns[i]
            if (rest := search(i + 1, state, left - DELETE)) is not None:
                return "D" + rest
        if (i < n or whole) and (rest := search(i, NEXT[state, WANTED[state]], left - INSERT)) is not None:
            return "I" + rest
        if i < n and fault in (NONE, TRUNCATED):
            more = CUT if fault == TRUNCATED else 0
            if (state, letter) in NEXT and (rest := search(i + 1, NEXT[state, letter], left - more)) is not None:
                return "K" + rest
            if (rest := search(i + 1, NEXT[state, WANTED[state]], left - RENAME - more)) is not None:
                return "R" + rest
        failed[i, state] = left
        return None

    bound = least[0]
    while (edits := search(0, entry, bound)) is None:
        bound += 1
    return bound, edits


def apply_edits(edits: str, state: int, rows: list[tuple[str, str]]) -> tuple[int, list[str]]:
    """(state after, the mended turns as ``role:text``) of rows (role, text)."""
    lines, i = [], 0
    for edit in edits:
        letter = WANTED[state]
        if edit == "I":
            lines.append(f"{NAMES[letter]}:")
        else:
            role, text = rows[i]
            i += 1
            if edit == "D":
                continue
            if edit == "K":
                letter = role[:1]
                lines.append(f"{role}:{text}")
            else:
                lines.append(f"{NAMES[letter]}:{text}")
        state = NEXT[state, letter]
    return state, lines


FACTS = "key string, part int, seq int, open boolean, size int, blank long, duplicate long, truncated long, illegal long, turns long, "
FACTS += "low long, high long, first string, last string, cost long, audit string, sha256 string, "
FACTS += "ways array<struct<cost:int,edits:string>>, roles array<string>, texts array<string>"
WAY = pa.struct([("cost", pa.int32()), ("edits", pa.string())])
FACT_TYPES = {
    "key": pa.string(), "part": pa.int32(), "seq": pa.int32(), "open": pa.bool_(), "size": pa.int32(),
    **dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns", "low", "high"), pa.int64()),
    "first": pa.string(), "last": pa.string(), "cost": pa.int64(), "audit": pa.string(), "sha256": pa.string(),
    "ways": pa.list_(WAY), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()),
}
STATES = (START, AFTER_S, AFTER_U, AFTER_A)


def _batches(rows: Iterator[dict], types: dict, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, pa.schema(list(types.items())))
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, pa.schema(list(types.items())))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for part in parts(batch):
            yield from part.to_pylist()


def _block(key: str, seq: int, rows: list[dict], opened: bool) -> dict:
    """Facts of consecutive turns of a conversation; an open block keeps its texts and all ways through it."""
    numbers = [r["turn"] for r in rows if r["turn"] is not None]
    letters = [r["role"][:1] for r in rows]
    faults = [r["fault"] for r in rows]
    turns = tuple(zip(letters, faults))
    fact = dict.fromkeys(FACT_TYPES) | {
        "key": key, "part": TaskContext.get().partitionId(), "seq": seq, "open": opened, "size": len(rows),
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
        "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(letters, letters[1:])),
        "turns": len(set(numbers)), "low": min(numbers, default=None), "high": max(numbers, default=None),
        "first": letters[0] if rows else None, "last": letters[-1] if rows else None,
    }
    if opened:
        ways = [solve(turns, a, (b,), False) for a in STATES for b in STATES]
        return fact | {
            "ways": [w and {"cost": w[0], "edits": w[1]} for w in ways], "roles": [r["role"] for r in rows], "texts": [r["text"] for r in rows]
        }
    cost, audit = solve(turns)
    text = "\n".join(apply_edits(audit, START, [(r["role"], r["text"]) for r in rows])[1])
    return fact | {"cost": cost, "audit": audit, "sha256": hashlib.sha256(text.encode()).hexdigest()}


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns of a partition as blocks: open where the conversation has several, or may go on in a neighbour."""

    def blocks() -> Iterator[dict]:
        key, held, seq, first = None, [], 0, True
        for row in _rows(batches):
            if row["key"] != key:
                if key is not None:
                    yield _block(key, seq, held, first or seq > 0)
                    first = False
                key, held, seq = row["key"], [], 0
            if row["present"]:
                if len(held) == BLOCK:
                    yield _block(key, seq, held, True)
                    held, seq = [], seq + 1
                held.append(row)
        if key is not None:
            yield _block(key, seq, held, True)

    return _batches(blocks(), FACT_TYPES)


def _by_key(rows: Iterator[dict]) -> Iterator[tuple[str, Iterator[dict]]]:
    """Rows, sorted by key, in runs; a run is read while it is asked for."""
    row = next(rows, None)
    while row is not None:
        key = row["key"]

        def run() -> Iterator[dict]:
            nonlocal row
            while row is not None and row["key"] == key:
                yield row
                row = next(rows, None)

        yield key, run()


JOINED = "key string, part int, seq int, entry int, edits string, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string"
JOINED_TYPES = {
    "key": pa.string(), "part": pa.int32(), "seq": pa.int32(), "entry": pa.int32(), "edits": pa.string(),
    **dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "gaps", "cost"), pa.int64()), "audit": pa.string(),
}


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per open conversation a row with its totals, and per block the state it starts in and its edits.

    Of the ways to a state only the best is carried on: its cost, and its rank in ASCII order among the states' ways. What is left after the last
    block is to insert what the pattern still wants.
    """

    def answers() -> Iterator[dict]:
        for key, run in _by_key(_rows(batches)):
            total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
            low = high = last = None
            places: list[tuple[int, int]] = []
            best: dict[int, tuple[int, int]] = {START: (0, 0)}  # state -> (cost, rank in ASCII order among the states)
            back: list[dict[int, tuple[int, str]]] = []
            for block in run:
                for name in total:
                    total[name] += block[name]
                if block["size"]:
                    if last is not None and last + block["first"] not in LEGAL_PAIRS:
                        total["illegal"] += 1
                    last = block["last"]
                if block["low"] is not None:
                    total["turns"] -= high is not None and high == block["low"]  # a number that goes on from the block before
                    low, high = block["low"] if low is None else low, block["high"]
                places.append((block["part"], block["seq"]))
                step: dict[int, tuple] = {}
                for before, (cost, rank) in best.items():
                    for after in STATES:
                        if way := block["ways"][4 * before + after]:
                            found = (cost + way["cost"], rank, way["edits"], before)
                            step[after] = min(step.get(after, found), found)
                order = {s: r for r, s in enumerate(sorted(step, key=lambda s: step[s][1:3]))}
                best = {s: (found[0], order[s]) for s, found in step.items()}
                back.append({s: (found[3], found[2]) for s, found in step.items()})
            ends = {s: solve((), s) for s in best}
            state = min(best, key=lambda s: (best[s][0] + ends[s][0], best[s][1]))
            cost, segments = best[state][0] + ends[state][0], []
            final = ends[state][1]
            for way in reversed(back):
                before, edits = way[state]
                segments.append((before, edits))
                state = before
            segments.reverse()
            segments[-1] = (segments[-1][0], segments[-1][1] + final)
            for (part, seq), (entry, edits) in zip(places, segments):
                yield dict.fromkeys(JOINED_TYPES) | {"key": key, "part": part, "seq": seq, "entry": entry, "edits": edits}
            gaps = 0 if low is None else high - low + 1 - total.pop("turns")
            total.pop("turns", None)
            yield dict.fromkeys(JOINED_TYPES) | total | {"key": key, "gaps": gaps, "cost": cost, "audit": "".join(e for _, e in segments)}

    return _batches(answers(), JOINED_TYPES)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, sha256) of the mended conversations, text by text."""

    def digests() -> Iterator[dict]:
        for key, run in _by_key(_rows(batches)):
            digest, between = hashlib.sha256(), b""
            for block in run:
                for line in apply_edits(block["edits"], block["entry"], list(zip(block["roles"], block["texts"])))[1]:
                    digest.update(between + line.encode())
                    between = b"\n"
            yield {"key": key, "sha256": digest.hexdigest()}

    return _batches(digests(), {"key": pa.string(), "sha256": pa.string()})


def _faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault``. Repeats are told by the first place of each (conversation, role, text), an aggregate that is combined before the shuffle."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), F.coalesce("turn", F.lit(0)).alias("turn"), F.col("row"))
    rows = rows.withColumns({"blank": bare == "", "sign": F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256), "place": place})
    repeated = (
        rows.filter(F.col("present") & ~F.col("blank")).groupBy("key", "sign")
        .agg(F.min("place").alias("first_place"), F.count(F.lit(1)).alias("times")).filter("times > 1").drop("times")
    )
    fault = (
        F.when(F.col("blank"), BLANK).when(F.col("place") > F.col("first_place"), DUPLICATE)
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    )
    return rows.join(repeated, ["key", "sign"], "left").withColumn("fault", fault.cast("int"))


def repair_conversations(turns: DataFrame, id_col: str = "conv_id", present: Column | None = None) -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256), one row per conversation of turns (id, turn, role, text)."""
    kind = turns.schema[id_col].dataType
    rows = stage(
        turns.select(
            F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias("key"), F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
            F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("present"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "turns",
    )
    beginning = [F.left("role", F.lit(32)).alias("r32"), F.left("text", F.lit(32)).alias("t32"), F.xxhash64("role", "text").alias("hash")]
    order = ["key", "turn", "r32", "t32", "hash", "row"]
    sorted_rows = (
        _faults(rows).select("key", "turn", "role", "text", "present", "fault", "row", *beginning)
        .repartitionByRange(*order).sortWithinPartitions(*order).select("key", "turn", "role", "text", "present", "fault")
    )
    blocks = stage(sorted_rows.mapInArrow(_cut, FACTS), "blocks")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    closed = blocks.filter("not open").withColumn("gaps", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)))
    opened = blocks.filter("open")
    joined = stage(
        opened.drop("roles", "texts", "open", "cost", "audit", "sha256")
        .repartition("key").sortWithinPartitions("key", "part", "seq").mapInArrow(_join, JOINED), "joined"
    )
    edits = joined.filter("seq is not null").select("key", "part", "seq", "entry", "edits")
    digests = (
        opened.select("key", "part", "seq", "roles", "texts").join(edits, ["key", "part", "seq"])
        .repartition("key").sortWithinPartitions("key", "part", "seq").mapInArrow(_digest, "key string, sha256 string")
    )
    long = joined.filter("seq is null").join(digests, "key")
    found = closed.select("key", *numbers, "sha256").unionByName(long.select("key", *numbers, "sha256"))
    return found.select(F.when(F.col("key") != "", F.substring("key", 2, 2**31 - 1)).cast(kind).alias("id"), *numbers, "sha256")
