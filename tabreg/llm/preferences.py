"""Preference pairs as training text: shared turns once as prompt, two masked completions.

Each pair has a chosen and a rejected conversation. Their longest common prefix of turns (same role and
text, nulls equal) is rendered once; what follows is rendered for either side, with a mask as runs of characters:
(length, learn), where learn is 1 for what the assistant says, its end mark included, and 0 for headers and other
roles. The lengths of a mask sum to the length of its completion.

Turns are ordered by turn number, role and text, null numbers first; repeated turns stay. A null role is rendered as
"unknown", a null text as empty. Identical conversations have empty completions; a pair with one side only has an empty
prompt and an empty completion for the other side. An empty table gives an empty result. Extra columns are
ignored. Only DataFrame functions are used, with one grouping of turns by conversation: its result, one text per
conversation, is all that is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, HEAD, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def turn_lists(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, turns): the ordered turns of each conversation."""
    one = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    return turns.groupBy(F.col(id_col).alias("id")).agg(F.array_sort(F.collect_list(one)).alias("turns"))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("unknown")), F.lit(HEAD))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def _mask(turns: Column, learner: str) -> Column:
    def runs(turn: Column) -> Column:
        learn = F.coalesce(turn["role"] == learner, F.lit(False)).cast("int")
        return F.array(
            F.struct(F.length(_header(turn)).alias("length"), F.lit(0).alias("learn")),
            F.struct(F.length(_body(turn)).alias("length"), learn.alias("learn")),
        )

    return F.flatten(F.transform(turns, runs))


def format_pairs(pairs: DataFrame, learner: str = "assistant") -> DataFrame:
    """(id, n_shared, prompt, chosen, rejected, chosen_mask, rejected_mask) from (id, chosen, rejected) turn lists."""
    none = F.array().cast(TURNS)
    sides = pairs.select("id", *[F.coalesce(F.col(c), none).alias(c) for c in ("chosen", "rejected")])
    least = F.least(F.size("chosen"), F.size("rejected"))
    same = F.zip_with(
        F.slice("chosen", 1, least), F.slice("rejected", 1, least),
        lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]),
    )
    differs = F.array_position(same, False).cast("int")
    cut = sides.withColumn("n_shared", F.when(differs == 0, least).otherwise(differs - 1))

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n_shared") + 1, F.size(side))

    return cut.select(
        "id", "n_shared", _render(F.slice("chosen", 1, F.col("n_shared"))).alias("prompt"),
        _render(rest("chosen")).alias("chosen"), _render(rest("rejected")).alias("rejected"),
        _mask(rest("chosen"), learner).alias("chosen_mask"), _mask(rest("rejected"), learner).alias("rejected_mask"),
    )


def format_preferences(chosen: DataFrame, rejected: DataFrame, id_col: str = "conv_id", learner: str = "assistant") -> DataFrame:
    """Formatted pairs from two tables of turns (id, turn, role, text) that share their ids."""
    pairs = turn_lists(chosen, id_col).withColumnRenamed("turns", "chosen").join(
        turn_lists(rejected, id_col).withColumnRenamed("turns", "rejected"), "id", "full"
    )
    return format_pairs(pairs, learner)
