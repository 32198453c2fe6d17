"""From hits to prompts and evidence. A question has at most k hits, so groups are small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def gathered(hits: DataFrame) -> DataFrame:
    """Per question its ``hits`` as an array in rank order."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "chunk", "url_key")))
    return hits.groupBy("qid").agg(ranked.alias("hits"))


def joined(field: str, separator: str) -> Column:
    """One field of the gathered hits as text; empty for a question without any."""
    return F.coalesce(F.array_join(F.transform("hits", lambda hit: hit[field]), separator), F.lit(""))


def filled(template: str, first: Column, second: Column) -> Column:
    """``template`` with its two ``{}`` slots filled."""
    before, between, after = template.split("{}")
    return F.concat(F.lit(before), first, F.lit(between), second, F.lit(after))


def assemble_context(hits: DataFrame, queries: DataFrame, template: str) -> DataFrame:
    """One ``model_input`` per question: its chunks in rank order put, with the
    question, into the slots of ``template``. No hits, empty context."""
    context = joined("chunk", "\n\n")
    return queries.join(gathered(hits), "qid", "left").select(
        "qid", "prompt", context.alias("context"), filled(template, context, F.col("prompt")).alias("model_input")
    )


def evidence(hits: DataFrame) -> DataFrame:
    """Per question its chunks and page keys, one line per hit, duplicates kept."""
    return gathered(hits).select(
        "qid", joined("chunk", "\n").alias("chunks"), joined("url_key", "\n").alias("urls")
    )


# Fixed value: layout of the answer shown to the user.
ANSWER_FORMAT = "🧠 Answer:\n{}\n\n⏳ URL:\n{}\n\n"


def answer_block(answers: DataFrame, evidence: DataFrame) -> DataFrame:
    """Displayed answer per question (``qid, answer``) with its source list."""
    block = filled(ANSWER_FORMAT, F.col("answer"), F.coalesce("urls", F.lit("")))
    return answers.join(evidence, "qid", "left").select("qid", block.alias("block"))
