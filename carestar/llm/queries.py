"""Registered queries of this package: ``name -> fn(spark, sf_dir)``, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm import (chat, decontaminate, filter_audit, line_dedup, lm_score, ngram_join, piece_codec, quality_classifier, quality_rules,
                          simhash, substring_dedup, toxicity, whitening)
from carestar.llm.oracles import ORACLE_SQL  # noqa: F401

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"     # vocabulary file of the SentencePiece queries


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and host verdicts of every document."""
    out = quality_rules.apply_quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that each document loses to passages of 50 words of documents before it."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


#: The tool that ``op4`` makes of a question in a conversation.
TOOLS = {"answer": {"question": ("string", True), "words": ("integer", True)}}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as tool traffic, with the faults that real traffic has, all by remainders of conv_id and turn.

    A user's turn calls ``answer``, the turn after a call's is its result when the assistant speaks, a system's turn stays
    a message. By conv_id mod 4 a call waits for the call two turns before (0), for the one two turns later in chains of up
    to four (1), for one that waits for it (2), or for two later calls (3). One call in seven repeats the identifier of the
    call before; one in five has a word count that is text, one in five has none. Of the results, one in five comes before
    its call and one in five answers the call before.
    """
    def named(away: int):
        return F.concat(F.lit("call-"), F.col("turn") + away)

    def remainder(of, by: int):
        return F.pmod(of, F.lit(by))

    both, place = F.col("conv_id") + F.col("turn"), remainder(F.col("turn"), 8)
    kind, fault = remainder(F.col("conv_id"), 4), remainder(3 * F.col("conv_id") + F.col("turn"), 5)
    none = F.array().cast("array<string>")
    after = (F.when(kind == 1, F.when(place < 6, F.array(named(2))).otherwise(none))
             .when(kind == 2, F.when(place < 2, F.array(named(2))).otherwise(F.array(named(-2))))
             .when(kind == 3, F.when(place < 2, F.array(named(4), named(2))).otherwise(none))
             .otherwise(F.array(named(-2))))
    question, words = F.col("text").alias("question"), F.size(F.split(F.trim("text"), r"[ \n]+"))
    arguments = (F.when(fault == 0, F.to_json(F.struct(question, words.cast("string").alias("words"))))
                 .when(fault == 1, F.to_json(F.struct(question)))
                 .otherwise(F.to_json(F.struct(question, words.alias("words")))))
    call = F.struct(F.when(remainder(both, 7) == 0, named(-2)).otherwise(named(0)).alias("id"), F.lit("answer").alias("name"),
                    F.parse_json(arguments).alias("arguments"), after.alias("after"))
    answered = F.when(remainder(both, 5) == 0, named(1)).when(remainder(both, 5) == 1, named(-3)).otherwise(named(-1))
    result = F.struct(answered.alias("tool_call_id"), F.col("text").alias("content"))
    user, reply = F.col("role") == "user", F.col("role") == "assistant"
    return conversations.select(
        "conv_id", "turn", F.when(user, "assistant").when(reply, "tool").otherwise(F.col("role")).alias("role"),
        F.when(user, F.to_json(F.struct(F.array(call).alias("tool_calls")))).when(reply, F.to_json(result))
        .otherwise(F.col("text")).alias("text"))


def op4_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of ``conversations`` as a linked, validated and serialised tool call, result or message."""
    return chat.link(tool_messages(table(spark, sf_dir, "conversations")), TOOLS)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and decoded text."""
    model = piece_codec.read_model(spark, PIECE_MODEL)
    return piece_codec.encode_documents(table(spark, sf_dir, "documents"), model, keep_ids=False, keep_text=False)


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document."""
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines that are no copy or near copy of an earlier one."""
    return line_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the closest passage of each."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every sound embedding on the leading 16 components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step of every order of five filters, per source."""
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {q.__name__: q for q in (
    op1_quality_rules, op2_quality_classifier, op3_substring_dedup, op4_chat_tools, op5_sentencepiece, op6_lm_score, op7_simhash, op8_line_dedup,
    op9_toxicity, op10_decontaminate, op11_whitening, op12_ngram_join, op13_filter_audit)}
