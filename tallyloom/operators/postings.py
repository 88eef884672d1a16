"""From postings to question/answer pairs, best answer scores and topic/score vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.tokens import check_vocabulary, literal_array
from tallyloom.operators.terms import block_number
from tallyloom.scratch import discard, written

QUESTION, ANSWER = 1, 2
NO_PARENT = -1


def split_postings(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Questions, and answers that name a parent."""
    questions = postings.where(F.col("posting_type") == QUESTION)
    answers = postings.where(
        (F.col("posting_type") == ANSWER)
        & F.col("parent_id").isNotNull()
        & (F.col("parent_id") != NO_PARENT)
    )
    return questions, answers


def _whole(posting: DataFrame, name: str, key: str) -> DataFrame:
    return posting.select(F.col(key).alias("qid"), F.struct(*posting.columns).alias(name))


def posting_pairs(postings: DataFrame) -> DataFrame:
    """``qid, question, answer`` for each answer whose question exists.

    Stays flat, so nothing gathers the answers of one question. The answers are the left, streamed
    side: a question with very many of them is read once per task, and the adaptive skew join can
    split it as long as no later operator needs all pairs of a question together; grouping by ``qid``
    right after it undoes the split. Every question row is paired: copies give copies, and different
    questions under one id are all paired rather than refused, as checking would take a shuffle of its own.
    """
    questions, answers = split_postings(postings)
    pairs = _whole(answers, "answer", "parent_id").join(_whole(questions, "question", "id"), "qid")
    return pairs.select("qid", "question", "answer")


def _large_questions(answers: DataFrame, block_answers: int) -> DataFrame:
    """``qid, blocks`` of the questions with more than ``block_answers`` different answers, written down.

    Few questions have that many answers at all; only theirs are told apart.
    """
    counted = answers.groupBy(F.col("parent_id").alias("qid")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_answers)
    many = written(counted.select("qid"), "questions-of-many")
    different = answers.join(many, answers["parent_id"] == many["qid"], "left_semi").distinct()
    blocks = F.ceil(F.count(F.lit(1)) / F.lit(block_answers)).cast("bigint").alias("blocks")
    large = written(different.groupBy(F.col("parent_id").alias("qid")).agg(blocks).where("blocks > 1"), "large-questions")
    discard(many)
    return large


def posting_groups(postings: DataFrame, block_answers: int = 10_000) -> DataFrame:
    """The pairs grouped per question: ``qid, block, question, answers``.

    ``answers`` holds ``answer, copies``: equal answers are added up before anything else, so copies never fill
    an array. A question with more than ``block_answers`` different answers comes in several blocks, each with
    about that many. The block is part of the join and grouping key, which spreads a question
    holding a large share of all answers over many tasks. As with pairs, every question row has groups.
    The answers are read twice, the first time only their parents.
    """
    questions, answers = split_postings(postings)
    large = _large_questions(answers, block_answers)
    distinct = answers.groupBy(*answers.columns).agg(F.count(F.lit(1)).alias("copies"))
    entry = F.struct(F.struct(*answers.columns).alias("answer"), "copies").alias("entry")
    numbered = distinct.select(F.col("parent_id").alias("qid"), "id", entry)
    blocks = F.coalesce("blocks", F.lit(1).cast("bigint"))
    dealt = numbered.join(large, "qid", "left").select(
        "qid", "entry", block_number(F.col("id"), blocks).alias("block")
    )
    # The join may leave the answers partitioned by question, which would do for grouping but not
    # for a question that is too large.
    blocked = dealt.repartition("qid", "block").groupBy("qid", "block").agg(
        F.sort_array(F.collect_list("entry")).alias("answers")
    )
    every_block = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block")
    heads = _whole(questions, "question", "id").join(large, "qid", "left").select(
        "qid", "question", every_block
    )
    return blocked.join(heads, ["qid", "block"]).select("qid", "block", "question", "answers")


def _question_scores(postings: DataFrame, *numbers: tuple[str, Column]) -> DataFrame:
    """``qid, best`` and the given numbers of each answered question; different questions under one id raise.

    Questions and answers meet in one aggregation by question id: a single scan and a single exchange
    of numbers, combined in each task first. A question counts by a fingerprint of its columns.
    """
    is_question = F.col("posting_type") == QUESTION
    parent = F.when(F.col("posting_type") == ANSWER, F.col("parent_id"))
    print_ = F.xxhash64("accepted_answer", "score", F.col("tags").isNull(), "tags")
    reduced = postings.select(
        F.when(is_question, F.col("id")).otherwise(parent).alias("qid"),
        F.when(is_question, print_).alias("print"),
        F.when(~is_question, F.col("score")).alias("answer_score"),
        *[F.when(is_question, number).alias(name) for name, number in numbers],
    ).where((F.col("qid") != NO_PARENT))
    joined = reduced.groupBy("qid").agg(
        F.min("print").alias("low"), F.max("print").alias("high"), F.max("answer_score").alias("best"),
        *[F.max(name).alias(name) for name, _ in numbers],
    )
    conflict = F.raise_error(
        F.concat(F.lit("different questions share id "), F.col("qid").cast("string"))
    )
    best = F.when(F.col("low") == F.col("high"), F.greatest("best", F.lit(0))).otherwise(conflict.cast("int"))
    return joined.where("low IS NOT NULL AND best IS NOT NULL").select(
        "qid", best.alias("best"), *[name for name, _ in numbers]
    )


def posting_highscore(postings: DataFrame) -> DataFrame:
    """Each answered question with ``high_score``, never below 0.

    Copies of a question count once. Two different questions under one id raise, as no rule says
    which of them the answers belong to. Answers come to the join as one row per question.
    """
    questions, _ = split_postings(postings)
    single = questions.select(F.col("id").alias("qid"), "accepted_answer", "score", "tags").distinct()
    scores = _question_scores(postings).withColumnRenamed("best", "high_score")
    return single.join(scores, "qid")


def topic_position(tags, vocabulary: Sequence[str]):
    """Index of the term that equals the whole tag text, -1 for none."""
    found = F.array_position(literal_array(vocabulary), tags)
    return F.coalesce(found, F.lit(0)).cast("int") - 1


def posting_vectors(
    postings: DataFrame, vocabulary: Sequence[str], spread: int = 50_000
) -> DataFrame:
    """``qid, x, y``: topic index times ``spread``, and best answer score.

    Questions without a known topic or without an answer drop out, after the check that no two
    different questions share an id. There is no join: one aggregation brings questions and answers
    together, so neither many answers to one question nor copies of a question make a large partition.
    """
    terms = check_vocabulary(vocabulary)
    if spread <= 0 or spread * (len(terms) - 1) > 2**31 - 1:
        raise ValueError("spread must be positive and keep every x within 32 bits")
    topics = _question_scores(postings, ("topic", topic_position(F.col("tags"), terms)))
    checked = topics.select("qid", "topic", "best").where("topic >= 0")
    return checked.select("qid", (F.col("topic") * F.lit(spread)).alias("x"), F.col("best").alias("y"))
