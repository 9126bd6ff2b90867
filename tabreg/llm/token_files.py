"""Token-id files: documents in ascending id order, entropy-coded by a static range ANS.

``write_tokens`` leaves three Parquet tables under a path:

``model``   token, frequency: one table for all blocks; frequencies sum to 2^20
``blocks``  self-contained blocks of whole documents: shard, block, start within the shard, ids and lengths of
            the documents, coded words, checkpoints
``shards``  shard, number of tokens, tokens of all shards before it

**Coding.** A block interleaves 1,024 coders: token i belongs to lane i mod 1,024, and one array operation moves all lanes
by one token. States are 64 bits and renormalise by 32-bit words into one stream. Every ``CHECKPOINT`` steps the
states, the place in the stream and a CRC of the segment's tokens are kept, so any segment decodes by
itself, in parallel with the others, and a damaged one is noticed; the coders must also end in their start
state.

Texts are tokenised once into a stored table; counts are summed per partition before they are grouped, and only the
frequency table (bounded by the vocabulary) goes to the driver and the tasks. A range partitioning by (id, hash of the ids)
deals the documents; equal ids may be split over shards, so a hot id does no harm. Offsets follow from one sum
per shard.

Null texts count as empty and hold the end id only. Null ids come first. Rows with equal ids follow each other in the
order of their hashes. An empty table gives empty files. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import parts, stage

SCALE = 20
LANES = 1024
BLOCK_TOKENS = 1 << 18
CHECKPOINT = 64
LOWEST = np.uint64(1 << 31)
CACHED_WORDS = 1 << 18
#: Bytes of text whose words are looked up at once: the more, the fewer look-ups of the same word.
TEXT_BYTES = 4 << 20
#: Steps before the model that leave words of lower-case ASCII letters as they are.
PLAIN_NORMALIZERS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase"}
WHITE_SPACE = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = r".,;:!?()[]{}<>|*_-%$#&/\@+=~^" + '"'
BLOCKS_SCHEMA = (
    "shard int, block int, start long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, words binary, "
    "states array<binary>, places array<long>, crcs array<long>"
)


# ---- tokens


class Words:
    """Ids of words between ASCII white space, little-endian. When full, words that are not asked for again are forgotten."""

    def __init__(self, definition: str, kind: str):
        # tasks run side by side already: threads of the library would only wait for each other
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.kind = kind
        content = json.loads(definition)
        # strings that the library takes out of a text before anything else: words that hold one go to it whole
        self.special = tuple(t["content"] for t in content.get("added_tokens") or ())
        if any(re.search(r"\s", a) for a in self.special):
            raise ValueError("an added token holds white space: texts cannot be encoded word by word")
        fits = any(not (core := a.rstrip(MARKS)) or core.isalpha() for a in self.special)
        #: Whether words of ASCII letters meet the model as they are, but for their case: it is then asked for them directly,
        #: and for the marks after them apart. No added token may fit into such a word.
        self.direct = _lowers(content.get("normalizer")) and not fits and _keeps_letters(content)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        suffix = content["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = [i.to_bytes(np.dtype(kind).itemsize, "little") for i in range(max(vocabulary.values(), default=0) + 1)]
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_array(pa.array([t.encode("utf-8", "replace") for t in texts], pa.string())).to_pylist()

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """Ids of each text, as large binary; no text may be null."""
        if len(self.known) >= CACHED_WORDS:
            self.old, self.known = self.known, {}
        split = pc.ascii_split_whitespace(self._plain(texts))
        coded = split.values.dictionary_encode()
        ids = self._ids(coded.dictionary.cast(pa.large_string())).take(coded.indices)
        places = np.frombuffer(ids.buffers()[1], np.int64)[split.offsets.to_numpy()]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(places), ids.buffers()[2]])

    def _plain(self, texts: pa.Array) -> pa.Array:
        """The texts, in lower case where the tokenizer would put ASCII letters in lower case alone."""
        if not self.direct:
            return texts
        low = pc.ascii_lower(texts)
        plain = pc.string_is_ascii(texts)
        for a in self.special:
            plain = pc.and_not(plain, pc.match_substring(low, a.lower()))
        return pc.if_else(plain, low, texts)

    def _ids(self, words: pa.Array) -> pa.Array:
        """Ids of each word. Letters and the marks after them are looked up apart, other words whole."""
        if not self.direct:
            return self._look_up(words)
        cores = pc.ascii_rtrim(words, MARKS)
        plain = pc.ascii_is_alpha(cores)
        cut = plain.to_numpy(zero_copy_only=False).copy()
        wider = np.flatnonzero(~pc.string_is_ascii(cores).to_numpy(zero_copy_only=False))
        cut[wider] = _whole_letters(cores.take(pa.array(wider)))
        cores = pc.if_else(plain, pc.ascii_lower(cores), pc.if_else(pa.array(cut), cores, words))
        # the marks: the last bytes of each word
        size, marks = _sizes(words), _sizes(words) - _sizes(cores)
        ends = np.concatenate(([0], np.cumsum(marks)))
        at = np.arange(ends[-1]) + np.repeat(np.cumsum(size) - ends[1:], marks)
        spelled = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at]
        tails = pa.Array.from_buffers(pa.large_string(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(spelled)])
        ids = [self._look_up(c.dictionary).take(c.indices) for c in (cores.dictionary_encode(), tails.dictionary_encode())]
        return pc.binary_join_element_wise(*ids, pa.scalar(b"", pa.large_binary()))

    def _look_up(self, words: pa.Array) -> pa.Array:
        """Ids of different words, which the library is asked for where they are new."""
        known, old, keys = self.known, self.old, words.to_numpy(zero_copy_only=False).tolist()
        found = [*map(known.get, keys)]
        if missing := [k for k, ids in zip(keys, found) if ids is None]:
            known.update((k, old[k]) for k in missing if k in old)
            self._learn([k for k in missing if k not in old])
            found = [known[k] if ids is None else ids for k, ids in zip(keys, found)]
        return pa.array(found, pa.large_binary())

    def _learn(self, words: list[str]) -> None:
        known, ids_of, tokenize = self.known, self.bytes_of, self.model.tokenize
        wider, others = [], []
        for word in words:
            if not self.direct:
                others.append(word)
            elif word.isascii():
                if word.isalpha():
                    known[word] = b"".join([ids_of[t.id] for t in tokenize(word)])
                else:
                    others.append(word)
            elif "\u03a3" not in word and word.isalpha() and (low := word.lower()).isalpha():
                wider.append((word, low))
            else:
                others.append(word)
        new = list({low for _, low in wider}.difference(known))
        for at in range(0, len(new), 2048):
            self._encode_words(new[at : at + 2048])
        known.update((word, known[low]) for word, low in wider)
        self._encode_each(others)

    def _encode_each(self, some: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
        self.known.update(zip(some, [np.array(e.ids, self.kind).tobytes() for e in found]))

    def _encode_words(self, some: list[str]) -> None:
        """Many words in one call, told apart by the tokens that end words, where the vocabulary marks these."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(some) or (len(ends) and ends[-1] != len(ids)):
            self._encode_each(some)
            return
        for word, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist()):
            self.known[word] = ids[a:b].tobytes()


def _sizes(strings: pa.Array) -> np.ndarray:
    return pc.binary_length(strings).to_numpy(zero_copy_only=False).astype(np.int64)


def _whole_letters(words: pa.Array) -> np.ndarray:
    """Whether words are letters alone, and stay so when they are composed (some are taken apart then) and put in lower case.

    The capital sigma is left out too: in lower case it depends on its place.
    """
    letters = pc.utf8_is_alpha(words)
    for unsteady in "\u0130\u03a3":
        letters = pc.and_not(letters, pc.match_substring(words, unsteady))
    steady = map(unicodedata.is_normalized, repeat("NFC"), words.to_numpy(zero_copy_only=False).tolist())
    return letters.to_numpy(zero_copy_only=False) & np.fromiter(steady, bool, len(words))


def _lowers(normalizer: dict | None) -> bool:
    """Whether a normaliser, as a definition states it, puts texts in lower case."""
    kind = (normalizer or {}).get("type")
    return kind == "Lowercase" or kind == "Sequence" and any(map(_lowers, normalizer["normalizers"]))


def _keeps_letters(content: dict) -> bool:
    """Whether a definition's steps before the model change nothing in a word of lower-case ASCII letters, nor cut it."""
    normalizer = content.get("normalizer") or {}
    steps = normalizer["normalizers"] if normalizer.get("type") == "Sequence" else [normalizer]
    cut = {"type": "Split", "pattern": {"Regex": LETTER_RUNS}, "behavior": "Removed", "invert": True}
    spell = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    before = [{k: v for k, v in x.items() if k != "trim_offsets"} for x in (content.get("pre_tokenizer") or {}).get("pretokenizers", ())]
    return before == [cut, spell] and all(x.get("type") in PLAIN_NORMALIZERS or x == WHITE_SPACE for x in steps)


@lru_cache(maxsize=2)
def _words(definition: str, kind: str) -> Words:
    return Words(definition, kind)


def id_kind(tokenizer_path: str, end_id: int) -> str:
    """Two bytes hold the ids of a vocabulary of up to 65,536, four those of a larger one."""
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True)
    return "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): ids of each text and the end id, little-endian, of the width that ``id_kind`` names.

    For tokenizers that never join text across ASCII white space, as those that drop it: words are then encoded once
    and looked up after.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = id_kind(tokenizer_path, end_id)
    end = pa.scalar(np.array([end_id], kind).tobytes(), pa.large_binary())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(definition.value, kind)
        for batch in (part for whole in batches for part in parts(whole, TEXT_BYTES)):
            ids = words.encode_array(pc.fill_null(batch.column("text"), ""))
            ids = pc.binary_join_element_wise(ids, end, pa.scalar(b"", pa.large_binary())).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), ids], ["id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "id long, ids binary")


# ---- model


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2^SCALE, at least 1 for every token that occurs."""
    present = counts > 0
    if not present.any():
        return np.zeros(len(counts), np.int64)
    if present.sum() > 1 << (SCALE - 1):
        raise ValueError("the vocabulary is too large for the scale")
    room = (1 << SCALE) - int(present.sum())
    share = [int(c) * room // int(counts.sum()) for c in counts.tolist()]
    out = np.where(present, 1 + np.array(share, np.int64), 0)
    out[int(np.argmax(out))] += (1 << SCALE) - int(out.sum())
    return out


def count_tokens(tokens: DataFrame, kind: str) -> DataFrame:
    """(token, n) over all rows of (id, ids of ``kind``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in (part for whole in batches for part in parts(whole)):
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind)
            counts = np.bincount(ids, minlength=len(total))
            counts[: len(total)] += total
            total = counts
        seen = np.flatnonzero(total)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["token", "n"])

    return tokens.select("ids").mapInArrow(work, "token int, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Model:
    def __init__(self, frequency: np.ndarray):
        self.frequency = frequency.astype(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(frequency)[:-1])).astype(np.uint64)
        self.slots = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency)
        #: Of each slot: its token's frequency in the upper half, its place among the token's slots in the lower.
        self.steps = self.frequency[self.slots] << np.uint64(32) | np.arange(len(self.slots), dtype=np.uint64) - self.before[self.slots]


@lru_cache(maxsize=2)
def _model(frequency: bytes) -> Model:
    return Model(np.frombuffer(frequency, "<i8"))


# ---- coder


def encode_block(tokens: np.ndarray, model: Model):
    """(words, states, places, crcs): the stream, and a checkpoint for each segment of CHECKPOINT steps."""
    n = len(tokens)
    steps = -(-n // LANES)
    state = np.full(LANES, LOWEST, np.uint64)
    words: list[np.ndarray] = [np.empty(0, np.uint32)] * steps
    states: list[bytes] = []
    all_slots, top, half = np.uint64(1 << SCALE), np.uint64(63 - SCALE), np.uint64(32)
    at = tokens.astype(np.int64)
    frequency, before = model.frequency[at], model.before[at]
    limit, others = frequency << top, all_slots - frequency
    for step in range(steps - 1, -1, -1):
        own = slice(step * LANES, min(n, (step + 1) * LANES))
        x = state[: own.stop - own.start]
        full = np.flatnonzero(x >= limit[own])
        leaving = x[full]
        words[step] = leaving.astype(np.uint32)  # the lower half
        x[full] = leaving >> half
        # x // f * slots + x % f + before
        x += x // frequency[own] * others[own] + before[own]
        if step % CHECKPOINT == 0:
            states.append(state.astype("<u8").tobytes())
    size = np.cumsum([0, *map(len, words)])
    starts = range(0, steps, CHECKPOINT)
    span = CHECKPOINT * LANES
    crcs = [zlib.crc32(tokens[s * LANES : s * LANES + span].astype("<u4").tobytes()) for s in starts]
    stream = np.concatenate(words).astype("<u4").tobytes() if words else b""
    return stream, states[::-1], [int(size[s]) for s in starts], crcs


def decode_segment(segment: int, n: int, words: bytes, states: list[bytes], places: list[int], crcs: list[int], model: Model) -> np.ndarray:
    """Tokens of one segment of a block of ``n`` tokens; raises where the checksum differs."""
    stream = np.frombuffer(words, "<u4")
    state = np.frombuffer(states[segment], "<u8").astype(np.uint64)
    at, first = places[segment], segment * CHECKPOINT * LANES
    out = np.empty(min(n - first, CHECKPOINT * LANES), np.int64)  # slots, then their tokens
    mask, scale, half, lower = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32), np.uint64(0xFFFFFFFF)
    for done in range(0, len(out), LANES):
        lanes = min(LANES, len(out) - done)
        x = state[:lanes]
        slot = (x & mask).view(np.int64)
        out[done : done + lanes] = slot
        step = model.steps[slot]
        x = (step >> half) * (x >> scale) + (step & lower)
        short = np.flatnonzero(x < LOWEST)
        x[short] = x[short] << half | stream[at : at + len(short)]
        at += len(short)
        state[:lanes] = x
    out = model.slots[out]
    last = segment == len(states) - 1
    ended = (state == LOWEST).all() and at == len(stream) if last else state.astype("<u8").tobytes() == states[segment + 1]
    if not ended or zlib.crc32(out.astype("<u4").tobytes()) != crcs[segment]:
        raise ValueError("a block of token ids is damaged")
    return out


# ---- files


def write_tokens(tokens: DataFrame, path: str, kind: str = "<u4") -> None:
    """Write stored (id, ids of ``kind``) rows in ascending id order under ``path``."""
    spark = tokens.sparkSession
    counted = count_tokens(tokens, kind).toPandas()
    counts = np.zeros(int(counted["token"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["token"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    frequency = frequencies(counts)
    spark.createDataFrame(
        [(int(t), int(frequency[t])) for t in np.flatnonzero(frequency)], "token int, frequency int"
    ).coalesce(1).write.parquet(f"{path}/model")
    shared = spark.sparkContext.broadcast(frequency.astype("<i8").tobytes())
    wide = np.dtype(kind).itemsize

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, shard = _model(shared.value), TaskContext.get().partitionId()
        block = start = size = 0
        ids, own_ids = [], []

        def flush() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(own_ids), kind).astype(np.uint32)
            stream, states, places, crcs = encode_block(flat, model)
            row = {
                "shard": [shard], "block": [block], "start": [start], "n_tokens": [len(flat)], "doc_ids": [ids],
                "doc_tokens": [[len(p) // wide for p in own_ids]], "words": [stream], "states": [states],
                "places": [places], "crcs": [crcs],
            }
            return pa.RecordBatch.from_pydict(row, schema=arrow)

        for batch in (part for whole in batches for part in parts(whole)):
            for key, own in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
                ids.append(key)
                own_ids.append(own)
                size += len(own) // wide
                if size >= BLOCK_TOKENS:
                    yield flush()
                    block, start, size, ids, own_ids = block + 1, start + size, 0, [], []
        if own_ids:
            yield flush()

    arrow = pa.schema([
        ("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("words", pa.binary()),
        ("states", pa.list_(pa.binary())), ("places", pa.list_(pa.int64())), ("crcs", pa.list_(pa.int64())),
    ])
    tie = F.xxhash64("ids")
    dealt = tokens.select("id", "ids", tie.alias("tie")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    dealt.select("id", "ids").mapInArrow(work, BLOCKS_SCHEMA).write.parquet(f"{path}/blocks")
    blocks = spark.read.schema(BLOCKS_SCHEMA).parquet(f"{path}/blocks")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens")).withColumn(
        "offset", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))
    ).write.parquet(f"{path}/shards")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids) from the files: tokens before the document, its tokens, little-endian 32-bit ids."""
    pairs = spark.read.schema("token int, frequency int").parquet(f"{path}/model").toPandas()
    frequency = np.zeros(int(pairs["token"].max()) + 1 if len(pairs) else 1, np.int64)
    frequency[pairs["token"].to_numpy(np.int64)] = pairs["frequency"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(frequency.astype("<i8").tobytes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                b = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                flat = np.concatenate([
                    decode_segment(s, b["n_tokens"], b["words"], b["states"], b["places"], b["crcs"], model)
                    for s in range(len(b["states"]))
                ])
                ends = np.cumsum(b["doc_tokens"])
                starts = ends - np.array(b["doc_tokens"])
                ids = [flat[i:j].astype("<u4").tobytes() for i, j in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(b["doc_ids"], pa.int64()), pa.array(b["offset"] + b["start"] + starts), pa.array(ends - starts),
                    pa.array(ids, pa.binary()),
                ], ["id", "start", "n_tokens", "ids"])

    shards = spark.read.schema("shard int, n_tokens long, offset long").parquet(f"{path}/shards")
    blocks = spark.read.schema(BLOCKS_SCHEMA).parquet(f"{path}/blocks")
    return blocks.join(shards.select("shard", "offset"), "shard").mapInArrow(
        work, "id long, start long, n_tokens long, ids binary"
    )


def encode_documents(docs: DataFrame, tokenizer_path: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, write the files under ``path``, and read them back."""
    tokens = stage(tokenize(docs, tokenizer_path, end_id, id_col, text_col), "tokens")
    write_tokens(tokens, path, id_kind(tokenizer_path, end_id))
    return read_tokens(docs.sparkSession, path)
