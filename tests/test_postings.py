from __future__ import annotations

import pytest

from tallyloom.operators import postings as po
from tallyloom.sources.postings import POSTING_SCHEMA, decode_postings, encode_postings

QUESTION = (1, 40, 3, None, 12, "neither topic nor tag")
ANSWER = (2, 41, None, 40, 77, "a remark")
LANGUAGES = ["Java", "C#", "Scala"]


def frame(spark, data):
    return spark.createDataFrame(data, POSTING_SCHEMA)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_kinds(spark):
    questions, answers = po.split_postings(frame(spark, [QUESTION, ANSWER]))
    assert [r["id"] for r in questions.collect()] == [40]
    assert [r["id"] for r in answers.collect()] == [41]


def test_inline_fixture(spark, rows):
    both = frame(spark, [QUESTION, ANSWER])
    pairs = po.posting_pairs(both).collect()
    assert [(p["qid"], tuple(p["question"]), tuple(p["answer"])) for p in pairs] == [
        (40, QUESTION, ANSWER)
    ]
    assert rows(po.posting_highscore(both)) == [(40, 3, 12, QUESTION[5], 77)]
    assert rows(po.posting_vectors(both, LANGUAGES)) == []


def test_decoding(spark, rows):
    decoded = decode_postings(
        lines(
            spark,
            "1,10,,,3,C#",
            "2,11,,10,7",
            "2,12,,10,-4,",
            "1,13,11,,0,Java,extra",
            "1,14,,,+5,,",
            "1,15,,,5,,more",
        )
    )
    assert [f.dataType for f in decoded.schema] == [f.dataType for f in POSTING_SCHEMA]
    assert rows(decoded) == [
        (1, 10, None, None, 3, "C#"),
        (2, 11, None, 10, 7, None),
        (2, 12, None, 10, -4, None),
        (1, 13, 11, None, 0, "Java"),
        (1, 14, None, None, 5, None),
        (1, 15, None, None, 5, ""),
    ]


@pytest.mark.parametrize(
    "line", ["1,x,,,3,C#", "", "1,10", "1,10,,,", "1, 10,,,3", "1,10,,,99999999999", "1,10,a,,3", "1,10,,,3.0"]
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_lines_raise(spark, line, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="is not a valid"):
            decode_postings(lines(spark, line)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_encoding_round_trip(spark, rows):
    data = [QUESTION, ANSWER, (2, 12, None, None, -3, None)]
    assert rows(decode_postings(encode_postings(frame(spark, data)))) == data


MIXED = [
    (1, 1, None, None, 0, "Java"),
    (1, 2, None, None, 0, "C#"),
    (1, 3, None, None, 0, "Java"),
    (1, 4, None, None, 0, "Cobol"),
    (1, 5, None, None, 0, None),
    (1, -1, None, None, 0, "Java"),
    (2, 11, None, 1, 4, None),
    (2, 12, None, 1, 9, None),
    (2, 13, None, 2, -5, None),
    (2, 14, None, 4, 7, None),
    (2, 15, None, 5, 7, None),
    (2, 16, None, None, 50, None),
    (2, 17, None, -1, 50, None),
    (2, 18, None, 99, 50, None),
    (3, 19, None, 1, 70, "Java"),
]


def test_pairs_drop_orphans_and_unanswered(spark):
    pairs = po.posting_pairs(frame(spark, MIXED)).collect()
    assert sorted((p["qid"], p["answer"]["id"]) for p in pairs) == [
        (1, 11), (1, 12), (2, 13), (4, 14), (5, 15),
    ]


def test_high_scores_never_fall_below_zero(spark):
    scored = po.posting_highscore(frame(spark, MIXED)).collect()
    assert sorted((r["qid"], r["tags"] or "", r["high_score"]) for r in scored) == [
        (1, "Java", 9), (2, "C#", 0), (4, "Cobol", 7), (5, "", 7),
    ]


def test_vectors_need_an_exact_topic(spark, rows):
    vectors = po.posting_vectors(frame(spark, MIXED), LANGUAGES, spread=50_000)
    assert sorted(rows(vectors)) == [(1, 0, 9), (2, 50_000, 0)]


def test_copies_of_a_question_count_once(spark, rows):
    data = frame(spark, MIXED + [MIXED[0]] * 5)
    assert sorted(rows(po.posting_vectors(data, LANGUAGES))) == [(1, 0, 9), (2, 50_000, 0)]
    assert po.posting_highscore(data).count() == 4


def test_different_questions_under_one_id_raise(spark):
    data = frame(spark, MIXED + [(1, 1, None, None, 0, "C#")])
    for job in (po.posting_highscore, lambda p: po.posting_vectors(p, LANGUAGES)):
        with pytest.raises(Exception, match="share .*id 1"):
            job(data).collect()


@pytest.mark.parametrize("spread", [0, -1, 2**31])
def test_bad_spread(spark, spread):
    with pytest.raises(ValueError):
        po.posting_vectors(frame(spark, MIXED), LANGUAGES, spread=spread)


def test_a_question_with_an_unknown_topic_conflicts_as_well(spark):
    data = frame(spark, [(1, 1, None, None, 0, "a"), (1, 1, None, None, 0, "b"), (2, 9, None, 1, 3, None)])
    for job in (po.posting_highscore, lambda p: po.posting_vectors(p, ["a"])):
        with pytest.raises(Exception, match="share id 1"):
            job(data).collect()
    # Pairs and groups keep every question row.
    assert po.posting_pairs(data).count() == 2
    assert po.posting_groups(data).count() == 2


def test_copies_of_an_answer_do_not_fill_blocks(spark):
    data = [(1, 1, None, None, 0, "Java")] + [(2, 7, None, 1, 3, None)] * 500
    data += [(2, 100 + i, None, 1, i, None) for i in range(200)]
    groups = po.posting_groups(frame(spark, data), block_answers=50).collect()
    assert max(len(g["answers"]) for g in groups) < 100
    copies = [a["copies"] for g in groups for a in g["answers"] if a["answer"]["id"] == 7]
    assert copies == [500]


def test_high_scores_need_no_sorted_aggregation(spark):
    text = po.posting_highscore(frame(spark, MIXED))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_a_hot_question_is_grouped_in_blocks(spark):
    hot = [(2, 1000 + i, None, 1, i, None) for i in range(700)]
    cold = [(1, q, None, None, 0, "Java") for q in range(1, 400)]
    cold += [(2, 5000 + q, None, q, 3, None) for q in range(2, 399)]
    groups = po.posting_groups(frame(spark, hot + cold), block_answers=100).collect()
    found = sorted((g["qid"], a["answer"]["id"]) for g in groups for a in g["answers"])
    assert found == sorted([(1, a[1]) for a in hot] + [(q, 5000 + q) for q in range(2, 399)])
    assert len([g for g in groups if g["qid"] == 1]) == 7
    assert max(len(g["answers"]) for g in groups) < 200
    assert all(g["question"]["id"] == g["qid"] for g in groups)


def test_groups_without_hot_questions(spark):
    groups = po.posting_groups(frame(spark, MIXED)).collect()
    assert sorted((g["qid"], g["block"], len(g["answers"])) for g in groups) == [
        (1, 0, 2), (2, 0, 1), (4, 0, 1), (5, 0, 1),
    ]
