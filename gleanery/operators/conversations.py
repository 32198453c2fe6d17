"""Operators on turn tables ``conv_id, turn, role, text``.

One conversation may hold a third of all turns. Conversations too long for one task are
found by a count first; only their windows run over spans of consecutive turn numbers,
and only one narrow row per span meets its neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gleanery.operators.sizing import BROADCAST_BYTES, measured

LONG = 20_000  # turns
SPAN = 1024

_PAIR = ["conv_id", "turn", "user_prompt", "model_response"]


def pair_turns(turns: DataFrame, long: int = LONG, span: int = SPAN) -> DataFrame:
    """Each user turn directly followed by an assistant turn, as one chat event. Rows that
    repeat a turn's number are one turn, the least by role and text."""
    turns = turns.groupBy("conv_id", "turn").agg(F.min(F.struct("role", "text")).alias("said"))
    turns = turns.select("conv_id", "turn", "said.role", "said.text")
    counted = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    long_ones, size = measured(counted.where(F.col("n") > long).select("conv_id"))
    if size == 0:
        return _adjacent(turns, "conv_id")
    long_ones = F.broadcast(long_ones) if size <= BROADCAST_BYTES else long_ones
    usual = _adjacent(turns.join(long_ones, "conv_id", "left_anti"), "conv_id")
    return usual.unionByName(_pairs_in_spans(turns.join(long_ones, "conv_id", "left_semi"), span))


def _adjacent(turns: DataFrame, *within: str) -> DataFrame:
    w = Window.partitionBy(*within).orderBy("turn")
    seen = turns.select(
        "conv_id",
        "turn",
        "role",
        F.col("text").alias("user_prompt"),
        F.lead("role").over(w).alias("next_role"),
        F.lead("text").over(w).alias("model_response"),
    )
    return seen.where((F.col("role") == "user") & (F.col("next_role") == "assistant")).select(*_PAIR)


def _pairs_in_spans(turns: DataFrame, span: int) -> DataFrame:
    """The pairs inside a span, and those across a border: a user turn ending its span
    and the first turn of the next span that has any."""
    placed = turns.withColumn("span_no", F.floor(F.col("turn") / span))
    inside = _adjacent(placed, "conv_id", "span_no")
    ends = placed.groupBy("conv_id", "span_no").agg(
        F.min("turn").alias("head"),
        F.max("turn").alias("turn"),
        F.max_by(F.col("role") == "user", "turn").alias("asks"),
    )
    markers = ends.where("asks").select("conv_id", "turn", "asks").unionByName(
        ends.select("conv_id", F.col("head").alias("turn"), F.lit(False).alias("asks"))
    )
    prompts = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("user_prompt"))
    answers = turns.where(F.col("role") == "assistant").select(
        "conv_id", F.col("turn").alias("next_turn"), F.col("text").alias("model_response")
    )
    across = _followed(markers, span).join(answers, ["conv_id", "next_turn"]).join(prompts, ["conv_id", "turn"])
    return inside.unionByName(across.select(*_PAIR))


def _followed(markers: DataFrame, span: int) -> DataFrame:
    """``conv_id, turn, next_turn``: each asking marker and the span head after it.

    Markers are at most two narrow rows per span; even so they meet in blocks of spans
    first, and only what borders a block meets the rest of its conversation.
    """
    found = []
    for width in (span * SPAN, None):
        block = F.floor(F.col("turn") / width) if width else F.lit(0)
        w = Window.partitionBy("conv_id", "block").orderBy("turn", "asks")
        seen = markers.withColumn("block", block).select(
            "conv_id",
            "turn",
            "asks",
            F.lead("turn").over(w).alias("next_turn"),
            F.lead("asks").over(w).alias("next_asks"),
            F.row_number().over(w).alias("place"),
        )
        found.append(seen.where(F.col("asks") & ~F.col("next_asks")).select("conv_id", "turn", "next_turn"))
        open_ended = F.col("asks") & F.col("next_asks").isNull()
        first = ~F.col("asks") & (F.col("place") == 1)
        markers = seen.where(open_ended | first).select("conv_id", "turn", "asks")
    return found[0].unionByName(found[1])


def truncate_to_last_user(turns: DataFrame, long: int = LONG) -> DataFrame:
    """Turns up to the last user turn; a conversation without one is dropped.

    The cut per conversation is a hash aggregate. Long conversations, which are few, get
    theirs by broadcast and are not shuffled; the rest join theirs.
    """
    cuts = turns.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.max(F.when(F.col("role") == "user", F.col("turn"))).alias("cut")
    )

    def cut(rows: DataFrame, at: DataFrame) -> DataFrame:
        return rows.join(at, "conv_id").where(F.col("turn") <= F.col("cut")).select(*turns.columns)

    long_ones, size = measured(cuts.where(F.col("n") > long).drop("n"))
    cuts = cuts.drop("n")
    if size == 0 or size > BROADCAST_BYTES:
        return cut(turns, cuts)
    long_ones = F.broadcast(long_ones)
    usual = turns.join(long_ones, "conv_id", "left_anti")
    return cut(turns, long_ones).unionByName(cut(usual, cuts))
