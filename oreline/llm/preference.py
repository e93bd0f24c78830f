"""Preference formatting: one prompt from the shared turns, two masked completions; native DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is written. The content between the header and the end is what a loss may count.
HEAD, MIDDLE, END = "<|", "|>\n", "<|end|>\n"


def _side(turns: DataFrame, pair_col: str, name: str) -> DataFrame:
    turn = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    return turns.filter(F.col(pair_col).isNotNull()).groupBy(F.col(pair_col).alias("pair_id")).agg(F.sort_array(F.collect_list(turn)).alias(name))


def _written(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.concat(F.lit(HEAD), F.coalesce(t["role"], F.lit("")), F.lit(MIDDLE), F.coalesce(t["text"], F.lit("")), F.lit(END)))


def _spans(turns: Column) -> Column:
    """[start, end) in characters of the assistant's texts with their end marks, in the written completion."""
    size = lambda t: F.length(F.coalesce(t["text"], F.lit("")))
    head = lambda t: F.length(F.coalesce(t["role"], F.lit(""))) + len(HEAD) + len(MIDDLE)
    kind = "struct<at:int,spans:array<struct<start:int,end:int>>>"

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + head(t)
        end = start + size(t) + len(END)
        mine = F.when(t["role"] == "assistant", F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], mine).alias("spans")).cast(kind)

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), F.array().alias("spans")).cast(kind), step)["spans"]


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair_col: str = "pair_id") -> DataFrame:
    """Formats pairs of conversations for preference training.

    ``chosen`` and ``rejected`` hold a row a turn: pair_col, turn, role, text. Turns stand in the order of
    (turn, role, text), nulls first. The longest common prefix of both (equal role and text, null equal to null; turn
    numbers don't count) is written once as the prompt; the rest of each side is its completion. A completion's mask lists
    the character ranges that count for the loss: the assistant's texts and their end marks. All else, the prompt included,
    is masked.

    Returns pair_id, n_common, prompt, chosen, chosen_spans, rejected, rejected_spans, a row for each pair id of either
    side. A side without turns has an empty completion and no spans. Null roles and texts are written as empty. Null pair
    ids take no part. Repeated turns stay repeated. Empty tables give no rows; other columns take no part. One conversation
    is one output row, so its size bounds a row; equal conversations under many ids stay many small groups, and no group
    is larger than a conversation.
    """
    pairs = _side(chosen, pair_col, "c").join(_side(rejected, pair_col, "r"), "pair_id", "full")
    none = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    pairs = pairs.select("pair_id", F.coalesce("c", none).alias("c"), F.coalesce("r", none).alias("r"))
    differs = F.array_position(F.zip_with("c", "r", lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]) & a.isNotNull() & b.isNotNull()), False)
    pairs = pairs.withColumn("n_common", F.when(differs > 0, differs - 1).otherwise(F.size("c")).cast("int"))
    rest = lambda side: F.slice(side, F.col("n_common") + 1, F.greatest(F.size(side) - F.col("n_common"), F.lit(0)))
    pairs = pairs.select("pair_id", "n_common", F.slice("c", 1, F.col("n_common")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    return pairs.select(
        F.col("pair_id").alias(pair_col), "n_common", F.array_join(_written(F.col("p")), "").alias("prompt"),
        F.array_join(_written(F.col("c")), "").alias("chosen"), _spans(F.col("c")).alias("chosen_spans"),
        F.array_join(_written(F.col("r")), "").alias("rejected"), _spans(F.col("r")).alias("rejected_spans"),
    )


def swapped_replies(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations: chosen is the conversation, rejected the same with its last assistant turn (the one of
    the greatest turn number; of these the greatest text) replaced by that of conversation conv_id + 1, or left out if there is none.
    A conversation without assistant turns is rejected unchanged. Rows with a null conv_id take no part."""
    chosen = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").alias("pair_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    last = chosen.filter("role = 'assistant'").groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    own = last.select("pair_id", F.col("last.turn").alias("last_turn"), F.col("last.text").alias("last_text"))
    kept = (
        chosen.join(own, "pair_id", "left")
        .filter(~F.coalesce((F.col("role") == "assistant") & F.col("turn").eqNullSafe(F.col("last_turn")) & F.col("text").eqNullSafe(F.col("last_text")), F.lit(False)))
        .select("pair_id", "turn", "role", "text")
    )
    following = last.select((F.col("pair_id") - 1).alias("pair_id"), F.col("last.text").alias("text"))
    put = own.join(following, "pair_id").select("pair_id", F.col("last_turn").alias("turn"), F.lit("assistant").alias("role"), "text")
    return chosen, kept.unionByName(put)
