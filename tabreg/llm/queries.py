"""One query per operator over the standard tables, and SQL twins where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.shared import shared_path
from . import (
    byte_bpe,
    decontaminate,
    edit_counts,
    licences,
    lines,
    manifest,
    preferences,
    repair,
    search,
    substrings,
    token_files,
    toxicity,
)
from .common import read_table, tokenizer_path
from .simhash import simhash_components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query()
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, links at 4 bits or fewer."""
    found = simhash_components(read_table(spark, sf_dir, "documents"), shingle=4, threshold=4)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query()
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    ranks = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    tokens = byte_bpe.encode(read_table(spark, sf_dir, "documents"), ranks)
    return byte_bpe.decode(tokens, ranks).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document as read back from the files: place, number and checksum."""
    tokens = token_files.encode_documents(
        read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), shared_path(spark, "token-files"), end_id=2
    )
    return tokens.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from labelled rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model).withColumnRenamed("id", "doc_id")
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


LINES_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT r, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d
), w AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS nw FROM l
), c AS (
  SELECT *, sum(nw) OVER (PARTITION BY r ORDER BY i) AS upto FROM w
), runs AS (
  SELECT a.r, a.i AS s, min(b.i) AS e FROM c a JOIN c b ON a.r = b.r AND b.i >= a.i AND b.upto - a.upto + a.nw >= 1 GROUP BY a.r, a.i
  UNION
  SELECT b.r, max(a.i) AS s, b.i AS e FROM c a JOIN c b ON a.r = b.r AND b.i >= a.i AND b.upto - a.upto + a.nw >= 1 GROUP BY b.r, b.i
), later AS (
  SELECT r, s, e FROM (
    SELECT runs.*, row_number() OVER (PARTITION BY array_to_string(ls[s + 1 : e + 1], chr(10)) ORDER BY r, s) AS nth
    FROM runs JOIN d USING (r)
  ) WHERE nth > 1
), covered AS (
  SELECT DISTINCT r, unnest(range(s, e + 1)) AS i FROM later
)
SELECT any_value(d.doc_id) AS doc_id, count(*) AS n_lines, count(covered.i) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE covered.i IS NULL), '')) AS kept_sha256
FROM l JOIN d USING (r) LEFT JOIN covered ON l.r = covered.r AND l.i = covered.i
GROUP BY l.r
"""


@query(LINES_SQL)
def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many are later copies of repeated runs, and what is left."""
    found = lines.line_report(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


PREFERENCES_SQL = r"""
WITH t AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS ts
  FROM conversations GROUP BY conv_id
), p AS (
  SELECT a.conv_id, a.ts AS c, list_concat(a.ts[1 : len(a.ts) // 2], list_filter(coalesce(b.ts, []), lambda x: x.turn >= len(a.ts) // 2)) AS r
  FROM t a LEFT JOIN t b ON b.conv_id = a.conv_id + 1
), q AS (
  SELECT *, coalesce(list_position(list_transform(range(1, least(len(c), len(r)) + 1),
    lambda i: c[i].role IS NOT DISTINCT FROM r[i].role AND c[i].text IS NOT DISTINCT FROM r[i].text), false), 0) AS differs FROM p
), n AS (
  SELECT *, CASE WHEN differs = 0 THEN least(len(c), len(r)) ELSE differs - 1 END AS n_shared FROM q
), s AS (
  SELECT conv_id, n_shared, c[1 : n_shared] AS a, c[n_shared + 1 :] AS b, r[n_shared + 1 :] AS d FROM n
)
SELECT conv_id, CAST(n_shared AS INTEGER) AS n_shared,
  coalesce(array_to_string(list_transform(a, lambda x: '<|im_start|>' || coalesce(x.role, 'unknown') || chr(10) || coalesce(x.text, '') || '<|im_end|>' || chr(10)), ''), '') AS prompt,
  coalesce(array_to_string(list_transform(b, lambda x: '<|im_start|>' || coalesce(x.role, 'unknown') || chr(10) || coalesce(x.text, '') || '<|im_end|>' || chr(10)), ''), '') AS chosen,
  coalesce(array_to_string(list_transform(d, lambda x: '<|im_start|>' || coalesce(x.role, 'unknown') || chr(10) || coalesce(x.text, '') || '<|im_end|>' || chr(10)), ''), '') AS rejected,
  coalesce(array_to_string(list_transform(b, lambda x: (13 + length(coalesce(x.role, 'unknown'))) || ':0,' || (11 + length(coalesce(x.text, ''))) || ':' || CASE WHEN x.role = 'assistant' THEN 1 ELSE 0 END), ','), '') AS chosen_mask,
  coalesce(array_to_string(list_transform(d, lambda x: (13 + length(coalesce(x.role, 'unknown'))) || ':0,' || (11 + length(coalesce(x.text, ''))) || ':' || CASE WHEN x.role = 'assistant' THEN 1 ELSE 0 END), ','), '') AS rejected_mask
FROM s
"""


@query(PREFERENCES_SQL)
def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as chosen; rejected is its first half, continued by the next conversation's later turns."""
    lists = preferences.turn_lists(read_table(spark, sf_dir, "conversations"))
    following = lists.select((F.col("id") - 1).alias("id"), F.col("turns").alias("next"))
    half = F.floor(F.size("turns") / 2).cast("int")
    later = F.filter(F.coalesce("next", F.array().cast(preferences.TURNS)), lambda t: t["turn"] >= half)
    pairs = lists.join(following, "id", "left").select(
        "id", F.col("turns").alias("chosen"), F.concat(F.slice("turns", 1, half), later).alias("rejected")
    )

    def text(mask: str):
        return F.array_join(F.transform(mask, lambda r: F.concat_ws(":", r["length"], r["learn"])), ",").alias(mask)

    return preferences.format_pairs(pairs).select(
        F.col("id").alias("conv_id"), "n_shared", "prompt", "chosen", "rejected", text("chosen_mask"), text("rejected_mask")
    )


@query()
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds within a fifth of the item's words."""
    found = decontaminate.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "distance", "first_word", "end_word")


@query()
def op5_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after three edits: its source put in front, a cut in the middle, its language at the end."""
    ranks = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    size = F.coalesce(F.length("text"), F.lit(0))
    edits = F.array(
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("removed"), F.concat(F.col("source"), F.lit("\n")).alias("inserted")),
        F.struct((size / 2).cast("int").alias("at"), F.lit(7).alias("removed"), F.lit(None).cast("string").alias("inserted")),
        F.struct(F.lit(2**31 - 1).alias("at"), F.lit(0).alias("removed"), F.concat(F.lit(" "), F.col("lang")).alias("inserted")),
    )
    docs = read_table(spark, sf_dir, "documents").withColumn("_llm_edits", edits)
    trees = edit_counts.build_trees(docs, ranks, keep=("_llm_edits",)).withColumnRenamed("n_tokens", "n_before")
    # the count before travels as one more column: trees give all others anew
    both = edit_counts.apply_edit_lists(trees, ranks, "_llm_edits", keep=("n_before",))
    return both.select(F.col("id").alias("doc_id"), "n_before", F.col("n_tokens").alias("n_after"), "n_encoded")


@query()
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, how many lie in repeated windows of 35, and a digest of the rest."""
    found = substrings.remove_repeats(read_table(spark, sf_dir, "documents"), length=35)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op6_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 100, its whole text as query."""
    docs = read_table(spark, sf_dir, "documents")
    found = search.search(docs, docs.filter(F.col("doc_id") % 100 == 0), k=10)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


MANIFEST_SQL = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, '=' || lang AS g,
    list_transform([CAST(doc_id AS VARCHAR), source, lang], lambda f: coalesce(strlen(f) || ':' || f, '-')) AS before,
    CAST(n_chars AS VARCHAR) AS n, CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR) AS changed,
    coalesce(strlen(text) || ':' || text, '-') AS body,
    list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS register
  FROM documents
), leaves AS (
  SELECT doc_id, coalesce(g, '') AS g, sha256(array_to_string(before, '') || coalesce(strlen(n) || ':' || n, '-') || body) AS leaf,
    CASE WHEN xor(register, 4294967295) % 7 = 0
      THEN sha256(array_to_string(before, '') || coalesce(strlen(changed) || ':' || changed, '-') || body) END AS tampered
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves
), lv AS (
  SELECT g, 0 AS k, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT g, k + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM lv WHERE n > 1 GROUP BY g, k, i // 2
), subroots AS (
  SELECT g, k AS depth, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM lv WHERE n = 1
), up AS (
  SELECT 0 AS k, i, n, subroot AS h FROM subroots
  UNION ALL
  SELECT k + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY k, i // 2
), walk AS (
  SELECT p.doc_id, p.leaf, p.g, 0 AS phase, 0 AS k, p.i, p.n, s.i AS rank, s.n AS many, subroot, '' AS proof,
    coalesce(p.tampered, p.leaf) AS h FROM placed p JOIN subroots s USING (g)
  UNION ALL
  SELECT doc_id, leaf, w.g, CASE WHEN w.n > 1 THEN phase ELSE 1 END, CASE WHEN w.n > 1 THEN w.k + 1 ELSE 0 END,
    CASE WHEN w.n > 1 THEN w.i // 2 ELSE rank END, CASE WHEN w.n > 1 THEN (w.n + 1) // 2 ELSE many END, rank, many, subroot,
    proof || coalesce(a.h, b.h, ''),
    CASE WHEN w.n = 1 THEN w.h WHEN w.i % 2 = 0 THEN sha256(w.h || coalesce(a.h, b.h, '')) ELSE sha256(coalesce(a.h, b.h) || w.h) END
  FROM walk w LEFT JOIN lv a ON w.phase = 0 AND w.n > 1 AND a.g = w.g AND a.k = w.k AND a.i = xor(w.i, 1)
    LEFT JOIN up b ON w.phase = 1 AND w.n > 1 AND b.k = w.k AND b.i = xor(w.i, 1)
  WHERE w.phase = 0 OR w.n > 1
)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, w.h AS folded_root, w.h = r.h AS verified
FROM walk w, (SELECT h FROM up WHERE n = 1) r WHERE w.phase = 1 AND w.n = 1
"""


@query(MANIFEST_SQL)
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf and proof of every document; a seventh of the rows is checked with n_chars one too high."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    higher = [F.col("n_chars").cast("decimal(20,0)") + 1 if f == "n_chars" else F.col(f) for f in fields]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = manifest.build(
        read_table(spark, sf_dir, "documents"), fields, "doc_id", "lang",
        carry={"tampered": F.when(hit, manifest.digest_of(higher))},
    )
    proofs = found.proofs.withColumn("folded_root", manifest.fold(found, F.coalesce("tampered", "leaf")))
    return proofs.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(found.root).alias("root"), F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.lit(found.root)).alias("verified"),
    )


@query()
def op13_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, places of the base phrases, labels and restriction of every document."""
    found = licences.scan_licences(read_table(spark, sf_dir, "documents"))
    base = F.filter("notices", lambda n: n["label"].isin(*licences.BASE))
    words = F.transform(base, lambda n: n["word"])
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda n: n["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
    )


@query()
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage that follows from its keys: its faults and the cheapest edits that mend it."""
    turns = read_table(spark, sf_dir, "conversations")

    def known(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    draw = (F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20).cast("int")
    text = F.when(draw == 1, F.lit("")).when(draw == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    damaged = turns.select(
        "conv_id", "turn", F.when(draw == 4, F.lit("user")).otherwise(known("role")).alias("role"), text.alias("text"),
        (draw == 0).alias("dropped"), F.explode(F.array_repeat(F.lit(0), F.when(draw == 3, 2).otherwise(1))).alias("copy"),
    )
    found = repair.repair_conversations(damaged, present=~F.col("dropped"))
    return found.select(
        F.col("id").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("sha256").alias("repaired_sha256"),
    )
