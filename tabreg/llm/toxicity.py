"""Toxic spans and document scores by a linear-chain conditional random field.

**Labelled tokens.** Documents are labelled, tokens are not. A greedy cover finds the few words and word beginnings, nearly
absent from clean texts, that explain most toxic ones; in toxic texts words that have them are the toxic tokens, all
others are clean.

**Field.** Two labels per token; the score of a label sequence adds hashed features of each token (word,
beginnings of 3 to 7 characters, last three characters, both neighbours) and a weight per label transition. It is fitted by AdaGrad on the exact
gradient, observed minus expected counts.

**Forward-backward.** Steps are two-by-two matrices. Texts of a batch form one chain, whose step at the
start of a text forgets what was before; products are taken in blocks side by side, then across blocks, so the
longest text costs no more per token than the shortest.

**Scores.** The largest marginal of a text and the expected number and share of toxic tokens, through a
logistic function fitted on the same sample. Spans are runs of tokens with marginals of 0.5 or more, as
offsets of characters.

The fit uses at most ``max_labelled`` rows per class, texts of up to ``max_chars``, first by a hash of the id; scoring covers
whole texts of all rows. Null and empty texts have no tokens and the lowest score. Repeated and null ids keep their rows. With one
class or no labels, or where no toxic word is found, every score is the share of toxic ones among all labels that may be sampled, and
``keep_clean`` keeps all rows and warns. Extra columns are ignored.
"""

from __future__ import annotations

import pickle
import re
import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import parts, per_batch, stage, texts_of

BUCKETS = 1 << 18
BLOCK = 256
TOKENS_AT_ONCE = 1 << 16
CACHED_WORDS = 1 << 17
LONG_WORD = 64
BEGINNINGS = (3, 4, 5, 6, 7)
OWN = 2 + len(BEGINNINGS)  # features of the token itself; its part in its neighbours' features follows
MARKS = ".,;:!?\"'()[]{}<>|*_-–—…«»„“”‘’/\\#"


def _bucket(kind: str, word: str) -> int:
    return zlib.crc32(f"{kind}:{word}".encode("utf-8", "replace")) & BUCKETS - 1


@dataclass
class Vocabulary:
    """Numbers and feature buckets of words (text between white space, lower case, outer marks off).

    Scoring has no use for the words themselves (``keep`` off): then their texts are not kept, and long ones are looked up anew in each call.
    """

    keep: bool = True
    numbers: dict[str, int] = field(default_factory=dict)
    words: list[str | None] = field(default_factory=list)
    long: dict[str, int] = field(default_factory=dict)
    buckets: np.ndarray = field(default_factory=lambda: np.empty((1024, OWN + 2), np.int32))

    def number(self, raw: str) -> int:
        numbers = self.numbers if len(raw) <= LONG_WORD else self.long
        known = numbers.get(raw)
        if known is None:
            known = numbers[raw] = len(self.words)
            word = raw.strip(MARKS) or raw
            if known == len(self.buckets):
                self.buckets = np.concatenate((self.buckets, np.empty_like(self.buckets)))
            self.buckets[known] = [
                _bucket("word", word), *(_bucket(f"first{k}", word[:k]) for k in BEGINNINGS), _bucket("last", word[-3:]),
                _bucket("before", word), _bucket("after", word),
            ]
            self.words.append(word if self.keep else None)
        return known

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all texts on end, tokens per text)"""
        if len(self.words) > CACHED_WORDS:
            self.__init__(self.keep)
        split = [t.lower().split() for t in texts]
        number = self.number
        flat = np.fromiter((number(w) for own in split for w in own), np.int64, sum(map(len, split)))
        if not self.keep:
            self.long.clear()
        return flat, np.array([len(own) for own in split], np.int64)


@dataclass
class Model:
    weights: np.ndarray  # score of label 1, by bucket
    transitions: np.ndarray  # [label before, label]
    scale: tuple[float, ...]  # of what _summary gives
    base: float | None = None  # the score of everything, where nothing could be learned

    def emissions(self, numbers: np.ndarray, starts: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
        own = self.weights[vocabulary.buckets[: len(vocabulary.words)]]
        out = own[:, :OWN].sum(1)[numbers]
        inner = np.ones(len(numbers), bool)
        inner[starts[starts < len(numbers)]] = False
        at = np.flatnonzero(inner)
        out[at] += own[numbers[at - 1], OWN]
        out[at - 1] += own[numbers[at], OWN + 1]
        return out


def marginals(emission: np.ndarray, first: np.ndarray, transitions: np.ndarray, joint: bool = True):
    """(P(label is 1), joint[label before, label]) of each token; ``first`` marks tokens that start a text.

    The joint of a first token is of no meaning; without ``joint`` there is none.
    """
    p, both, _, _ = _marginals(emission, first, transitions, joint)
    return p, both


def text_marginals(emission: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """P(label is 1) of each token, taken ``TOKENS_AT_ONCE`` tokens or so at a time.

    A cut lies before a text where one begins in time. Inside a longer text two runs over its stretches hand on what is known on their left and
    on their right, two numbers per cut, so memory per token is that of a few numbers, whatever the length of a text.
    """
    n, cuts = len(emission), [0]
    starts = np.append(np.flatnonzero(first), n)
    while cuts[-1] < n:
        reach = cuts[-1] + TOKENS_AT_ONCE
        at = int(starts[np.searchsorted(starts, reach, "right") - 1])
        cuts.append(at if at > cuts[-1] else min(reach, n))
    spans = list(zip(cuts, cuts[1:]))
    whole = [b == n or bool(first[b]) for _, b in spans]
    left: tuple[float, float] = (0.5, 0.5)
    lefts, rights = [], [(0.5, 0.5)] * len(spans)
    for (a, b), closed in zip(spans, whole):
        lefts.append(left)
        left = (0.5, 0.5) if closed else _marginals(emission[a:b], first[a:b], transitions, False, left)[2]
    for i in range(len(spans) - 2, -1, -1):
        if not whole[i]:
            a, b = spans[i + 1]
            rights[i] = _marginals(emission[a:b], first[a:b], transitions, False, (0.5, 0.5), rights[i + 1])[3]
    found = [
        _marginals(emission[a:b], first[a:b], transitions, False, left, right)[0] for (a, b), left, right in zip(spans, lefts, rights)
    ]
    return np.concatenate(found) if found else np.zeros(0)


def _marginals(
    emission: np.ndarray, first: np.ndarray, transitions: np.ndarray, joint: bool,
    left: tuple[float, float] = (0.5, 0.5), right: tuple[float, float] = (0.5, 0.5),
):
    """(P, joint or None, what is known after the last token, what is known before the first token) given what is known on either side."""
    n = len(emission)
    rows = -(-n // BLOCK)
    e = np.exp(np.clip(emission, -30, 30))
    step = np.empty((2, 2, rows * BLOCK))
    t = np.exp(transitions)
    for i in range(2):
        for j in range(2):
            step[i, j, :n] = np.where(first, 1.0, t[i, j]) * (e if j else 1.0)
            step[i, j, n:] = float(i == j)
    step = np.ascontiguousarray(step.reshape(2, 2, rows, BLOCK).transpose(3, 0, 1, 2))  # position, i, j, block
    ahead = np.empty_like(step)  # product of the block's steps up to the position
    behind = np.empty_like(step)  # product of the block's steps after the position
    ahead[0] = step[0]
    behind[-1] = np.eye(2)[:, :, None]
    for k in range(1, BLOCK):
        a, s = ahead[k - 1], step[k]
        ahead[k] = a[:, :1] * s[0] + a[:, 1:] * s[1]
        ahead[k] /= ahead[k].max((0, 1))
        s, b = step[-k], behind[-k]
        behind[-k - 1] = s[:, :1] * b[0] + s[:, 1:] * b[1]
        behind[-k - 1] /= behind[-k - 1].max((0, 1))
    whole = step[0][:, :1] * behind[0][0] + step[0][:, 1:] * behind[0][1]
    into, out = np.empty((2, rows)), np.empty((2, rows))
    x, y = left
    for r, (a, b, c, d) in enumerate(whole.reshape(4, rows).T.tolist()):
        into[:, r] = x, y
        x, y = x * a + y * c, x * b + y * d
        x, y = x / (x + y), y / (x + y)
    after_all = (x, y)
    x, y = right
    for r, (a, b, c, d) in zip(range(rows - 1, -1, -1), whole.reshape(4, rows).T[::-1].tolist()):
        out[:, r] = x, y
        x, y = a * x + b * y, c * x + d * y
        x, y = x / (x + y), y / (x + y)
    before_all = (x, y)
    alpha = (into[None, 0, None] * ahead[:, 0] + into[None, 1, None] * ahead[:, 1]).transpose(1, 2, 0).reshape(2, -1)
    beta = (behind[:, :, 0] * out[0] + behind[:, :, 1] * out[1]).transpose(1, 2, 0).reshape(2, -1)
    both = alpha * beta
    p = (both[1] / both.sum(0))[:n]
    if not joint:
        return p, None, after_all, before_all
    before = np.concatenate(([[0.5], [0.5]], alpha[:, :-1]), 1)[:, :n]
    after = beta[:, :n] * np.array([np.ones(n), e])
    pairs = before[:, None] * t[:, :, None] * after[None]
    return p, pairs / pairs.sum((0, 1)), after_all, before_all


def _summary(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each text: 1, log odds of the largest marginal, logs of the expected number and share of toxic tokens."""
    most, total = np.zeros(len(sizes)), np.zeros(len(sizes))
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        most[full] = np.maximum.reduceat(p, starts)
        total[full] = np.add.reduceat(np.where(p >= 0.3, p, 0.0), starts)
    most = np.clip(most, 1e-4, 1 - 1e-4)
    return np.stack((np.ones(len(sizes)), np.log(most / (1 - most)), np.log1p(total), np.log(1e-3 + total / np.maximum(sizes, 20))), 1)


def _first(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(int(sizes.sum()), bool)
    starts = np.cumsum(sizes) - sizes
    out[starts[sizes > 0]] = True
    return out


def beginnings(word: str) -> list[str]:
    """What a word is looked up by: its beginnings, marked by a star, and itself."""
    return [word[:k] + "*" for k in BEGINNINGS if len(word) >= k] + [word]


def cover_words(texts: list[set[str]], toxic: np.ndarray, ratio: float = 8.0, cost: float = 2.0, support: float = 0.01) -> set[str]:
    """Words and beginnings that together explain most toxic texts.

    Each is ``ratio`` times as frequent in toxic texts as in clean ones and adds ``support`` of the toxic ones. A
    clean text that it hits weighs ``cost`` times as much as a toxic one, at equal class sizes.
    """
    total: dict[str, int] = {}
    holds: dict[str, list[int]] = {}
    for at, words in enumerate(texts):
        for w in {b for word in words for b in beginnings(word)}:
            total[w] = total.get(w, 0) + 1
            if toxic[at]:
                holds.setdefault(w, []).append(at)
    even = toxic.sum() / (len(toxic) - toxic.sum())
    least = max(2.0, support * toxic.sum())
    clean = {w: (total[w] - len(at)) * even for w, at in holds.items()}
    left = {w: set(at) for w, at in holds.items() if len(at) >= least and len(at) >= ratio * (clean[w] + 0.5 * even)}
    chosen: dict[str, int] = {}
    uncovered = set(np.flatnonzero(toxic).tolist())
    while left:
        # of equals the longest, which says most
        best = max(left, key=lambda w: (len(left[w] & uncovered) - cost * clean[w], len(left[w]), len(w), w))
        if len(left[best] & uncovered) - cost * clean[best] < least:
            break
        chosen[best] = len(left[best])
        uncovered -= left.pop(best)
    # what is as common as the chosen explains the same texts again: it is toxic as well
    common = 0.5 * float(np.median(list(chosen.values()))) if chosen else 0.0
    stems = tuple(w.rstrip("*") for w in chosen)
    more = {w for w, at in left.items() if len(at) - cost * clean[w] >= max(common, least) and not w.startswith(stems)}
    more = {w for w in more if not any(x.startswith(w.rstrip("*")) for x in stems)}
    return set(chosen) | more


def fit(texts: list[str], toxic: list[int], epochs: int = 4, rate: float = 0.3, decay: float = 1e-6) -> Model:
    """The field and its logistic scale from labelled texts."""
    labels = np.array(toxic, bool)
    base = float(labels.mean()) if len(labels) else 0.0
    empty = Model(np.zeros(BUCKETS), np.zeros((2, 2)), (0.0,) * 4, base)
    if labels.all() or not labels.any():
        return empty
    vocabulary = Vocabulary()
    flat, sizes = vocabulary.tokens(texts)
    ends = np.cumsum(sizes)
    words = [set(map(vocabulary.words.__getitem__, np.unique(flat[e - s : e]).tolist())) for s, e in zip(sizes, ends)]
    # copies of a text speak once
    once = {tuple(sorted(w)): at for at, w in enumerate(words)}.values()
    chosen = cover_words([words[at] for at in once], labels[list(once)])
    if not chosen:
        return empty
    toxic_word = np.array([not chosen.isdisjoint(beginnings(w)) for w in vocabulary.words])
    target = toxic_word[flat] & np.repeat(labels, sizes)
    model = Model(np.zeros(BUCKETS), np.zeros((2, 2)), (0.0,) * 4)
    squares, squares_t = np.full(BUCKETS, 1e-3), np.full((2, 2), 1e-3)
    order = np.random.default_rng(7)
    batches = max(1, int(flat.size // 30_000))
    for _ in range(epochs):
        for own in np.array_split(order.permutation(len(texts)), batches):
            span = np.concatenate([np.arange(ends[d] - sizes[d], ends[d]) for d in own] or [np.empty(0, np.int64)])
            if not len(span):
                continue
            numbers, y = flat[span], target[span].astype(float)
            first = _first(sizes[own])
            starts = np.flatnonzero(first)
            p, joint = marginals(model.emissions(numbers, starts, vocabulary), first, model.transitions)
            slope = y - p
            b = vocabulary.buckets[numbers]
            gradient = sum(np.bincount(b[:, k], slope, BUCKETS) for k in range(OWN))
            at = np.flatnonzero(~first)
            gradient += np.bincount(b[at - 1, OWN], slope[at], BUCKETS) + np.bincount(
                b[at, OWN + 1], slope[at - 1], BUCKETS
            )
            gradient -= decay * len(span) * model.weights
            squares += gradient**2
            model.weights += rate * gradient / np.sqrt(squares)
            change = -joint[:, :, at].sum(2)
            np.add.at(change, (y[at - 1].astype(int), y[at].astype(int)), 1)
            squares_t += change**2
            model.transitions += rate * change / np.sqrt(squares_t)
    first = _first(sizes)
    p = text_marginals(model.emissions(flat, np.flatnonzero(first), vocabulary), first, model.transitions)
    model.scale = _logistic(_summary(p, sizes), labels)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 0.1, clean: float = 4.0) -> tuple[float, ...]:
    """Newton's method with a ridge. Clean texts together weigh ``clean`` times as much as toxic ones, as the sample evens
    the classes out and a clean text lost is the worse error."""
    weight = len(y) * np.where(y, 1 / y.mean(), clean / (1 - y.mean())) / (1 + clean) / len(y)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
        w[1:] = np.maximum(w[1:], 0)  # more toxicity never lowers a score
    return tuple(w.tolist())


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no fit sees: crc32 of the id as text leaves 0 by 5. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_labelled: int = 1500, max_chars: int = 20_000) -> Model:
    """Fit on at most ``max_labelled`` documents of each class (first by a hash of the id) that are not held out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter(
        "id is not null and y in (0, 1)"
    ).filter(~held_out("id")).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    short = texts.filter(F.length("text") <= max_chars)
    ids = short.select("id").join(known, "id").withColumn("h", F.xxhash64("id"))
    # a third of the sample's rows may be lost to no rule: labels are joined with the texts before the bound is taken
    sample = stage(
        ids.filter("y = 1").orderBy("h", "id").limit(max_labelled).unionByName(ids.filter("y = 0").orderBy("h", "id").limit(max_labelled)).select("id", "y").distinct(),
        "sample",
    )
    rows = short.join(sample, "id").select("id", "y", "text").orderBy("id", "y", F.xxhash64("text")).limit(2 * max_labelled)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += texts_of(batch)
            toxic += batch.column("y").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, toxic))], pa.binary())], ["model"])

    # the bounded sample is fitted in one task, so the driver only sees the model
    fitted = rows.coalesce(1).mapInArrow(work, "model binary").collect()
    model = pickle.loads(fitted[0]["model"]) if fitted else fit([], [])
    if model.base is not None:
        # the sample evens the classes out, so its mean says nothing about the texts
        model.base = float(ids.select("id", "y").distinct().agg(F.avg("y")).first()[0] or 0.0)
    return model


_WORKING = Vocabulary(keep=False)


def _score(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score of each text, marginal of each token, tokens per text)"""
    flat, sizes = _WORKING.tokens(texts)
    if model.base is not None:
        return np.full(len(texts), model.base), np.zeros(len(flat)), sizes
    p = np.zeros(0)
    if len(flat):
        first = _first(sizes)
        p = text_marginals(model.emissions(flat, np.flatnonzero(first), _WORKING), first, model.transitions)
    return 1 / (1 + np.exp(-np.clip(_summary(p, sizes) @ np.array(model.scale), -30, 30))), p, sizes


def _spans(text: str, p: np.ndarray) -> list[dict]:
    out: list[dict] = []
    for at, word in enumerate(re.finditer(r"\S+", text.lower() if len(text.lower()) == len(text) else text)):
        if at < len(p) and p[at] >= 0.5:
            if out and out[-1]["last"] == at - 1:
                out[-1].update(end=word.end(), last=at, p=max(out[-1]["p"], float(p[at])))
            else:
                out.append({"start": word.start(), "end": word.end(), "last": at, "p": float(p[at])})
    return [{k: s[k] for k in ("start", "end", "p")} for s in out]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, spans): probability of the toxic label, and the offending characters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "id long, score double, spans array<struct<start: int, end: int, p: double>>"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch)
        scores, p, sizes = _score(shared.value, texts)
        ends = np.cumsum(sizes)
        hot = np.flatnonzero(p >= 0.5)
        marked = set(np.searchsorted(ends, hot, "right").tolist())
        spans = [_spans(t, p[ends[at] - sizes[at] : ends[at]]) if at in marked else [] for at, t in enumerate(texts)]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores), pa.array(spans, kind)], ["id", "score", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(per_batch(work), schema)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, unchanged; all of them, with a warning, where nothing was learned."""
    if model.base is not None:
        warnings.warn("no toxic word was learned from the labels: all rows are kept", stacklevel=2)
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for whole in batches for part in parts(whole)):
            kept = part.filter(pa.array(_score(shared.value, texts_of(part, text_col))[0] < limit))
            if kept.num_rows:
                yield kept

    return docs.mapInArrow(work, docs.schema)
