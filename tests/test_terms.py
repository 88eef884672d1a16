from __future__ import annotations

import random

import pytest

from tallyloom.functions.tokens import check_vocabulary
from tallyloom.operators import terms

W3 = [
    ("1", "Groovy scripts, and nothing but Erlang servers"),
    ("2", "Both Scala and Java compile to bytecode"),
    ("3", "Scala mixes two styles"),
]
W5 = W3 + [
    ("4", "Nobody here prefers Haskell over Java yet"),
    ("5", "Java still pays the rent"),
]
FIVE = ["Scala", "Java", "Groovy", "Haskell", "Erlang"]


def articles(spark, data):
    return spark.createDataFrame(data, "title string, text string")


def test_one_article_counts_once(spark, rows):
    found = terms.mention_count(articles(spark, [("only", "Java Sumatra")]), "Java")
    assert rows(found) == [("Java", 1)]


def test_two_articles_rank(spark, rows):
    data = [("1", "Scala first"), ("2", "Java later, then Scala again")]
    ranked = terms.rank_scan(articles(spark, data), ["Scala", "Java"])
    assert rows(ranked) == [("Scala", 2), ("Java", 1)]


def test_index_has_an_entry_per_mentioned_term(spark, rows):
    index = terms.inverted_index(articles(spark, W3), ["Scala", "Java"])
    assert index.columns == ["term", "title", "text"]
    assert index.select("term").distinct().count() == 2
    assert rows(terms.rank_index(index, ["Scala", "Java"])) == [("Scala", 2), ("Java", 1)]


def test_five_articles_rank_with_ties_in_vocabulary_order(spark, rows):
    expected = [("Java", 3), ("Scala", 2), ("Groovy", 1), ("Haskell", 1), ("Erlang", 1)]
    assert rows(terms.rank_reduce(articles(spark, W5), FIVE)) == expected
    turned = ["Erlang", "Haskell", "Groovy", "Java", "Scala"]
    assert rows(terms.rank_reduce(articles(spark, W5), turned)) == [
        ("Java", 3), ("Scala", 2), ("Erlang", 1), ("Haskell", 1), ("Groovy", 1),
    ]


def test_only_whole_tokens_count_and_each_article_once(spark, rows):
    data = [
        ("a", "Java, and Java"),
        ("b", "Java,"),
        ("c", "java JavaScript"),
        ("d", "x\nJava y"),
        ("e", "Java Java Java"),
        ("f", "  Java"),
        ("g", None),
        ("h", ""),
    ]
    ranked = terms.rank_reduce(articles(spark, data), ["Java"])
    assert rows(ranked) == [("Java", 3)]
    assert rows(terms.mention_count(articles(spark, data), "Java")) == [("Java", 3)]


def test_absent_terms_are_zero_in_the_scan_only(spark, rows):
    vocabulary = ["Clojure", *FIVE]
    scanned = rows(terms.rank_scan(articles(spark, W5), vocabulary))
    assert scanned[-1] == ("Clojure", 0)
    found = rows(terms.rank_reduce(articles(spark, W5), vocabulary))
    assert found == [row for row in scanned if row[1]]


def test_a_term_with_a_space_is_never_a_token(spark, rows):
    data = articles(spark, [("1", "Visual Basic here")])
    assert rows(terms.mention_count(data, "Visual Basic")) == [("Visual Basic", 0)]
    assert rows(terms.rank_scan(data, ["Visual Basic"])) == [("Visual Basic", 0)]


@pytest.mark.parametrize("vocabulary", [["a", "a"], ["a", ""], []])
def test_ambiguous_vocabularies_are_rejected(vocabulary):
    with pytest.raises(ValueError):
        check_vocabulary(vocabulary)


def test_no_articles(spark, rows):
    empty = articles(spark, [])
    assert rows(terms.rank_scan(empty, ["b", "a"])) == [("b", 0), ("a", 0)]
    assert rows(terms.rank_reduce(empty, ["b", "a"])) == []
    assert rows(terms.mention_count(empty, "a")) == [("a", 0)]


def random_articles(count):
    chance = random.Random(3)
    return [
        (f"t{i % (count - 3)}", " ".join(f"w{chance.randrange(400)}" for _ in range(30)))
        for i in range(count)
    ]


def brute_counts(data, vocabulary):
    return {t: sum(t in text.split(" ") for _, text in data) for t in vocabulary}


def test_the_three_rankings_agree_with_brute_force(spark, rows):
    data = random_articles(60)
    vocabulary = [f"w{i}" for i in range(0, 500, 25)]
    frame = articles(spark, data)
    counts = brute_counts(data, vocabulary)
    order = {t: i for i, t in enumerate(vocabulary)}
    expected = sorted(counts.items(), key=lambda c: (-c[1], order[c[0]]))
    assert rows(terms.rank_scan(frame, vocabulary)) == expected
    found = [c for c in expected if c[1]]
    assert rows(terms.rank_reduce(frame, vocabulary)) == found
    index = terms.inverted_index(frame, vocabulary)
    assert rows(terms.rank_index(index, vocabulary)) == found


def test_long_vocabularies_equal_brute_force(spark, rows):
    data = random_articles(60)
    vocabulary = [f"w{i}" for i in range(300)]
    frame = articles(spark, data)
    counts = brute_counts(data, vocabulary)
    expected = sorted(counts.items(), key=lambda c: (-c[1], vocabulary.index(c[0])))
    assert rows(terms.rank_scan(frame, vocabulary)) == expected
    index = terms.inverted_index(frame, vocabulary)
    assert rows(terms.rank_index(index, vocabulary)) == [c for c in expected if c[1]]
    hits = [(t, title, text) for title, text in data for t in set(text.split(" ")) & set(vocabulary)]
    assert sorted(rows(index)) == sorted(hits)


def test_blocks_are_dealt_by_term_and_block(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = terms.inverted_index(articles(spark, [("a", "hot")]), ["hot"])
        text = terms.index_blocks(index)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(term" in text and "SortMergeJoin" in text
    assert any("REPARTITION_BY_COL" in line and "block" in line for line in text.splitlines())


def test_index_blocks_hold_every_title_once_with_its_copies(spark):
    data = [(f"t{i}", "hot") for i in range(500)] + [("same", "hot cold")] * 300
    index = terms.inverted_index(articles(spark, data), ["hot", "cold"])
    blocks = terms.index_blocks(index, block_titles=50).collect()
    hot = [entry for b in blocks if b["term"] == "hot" for entry in b["entries"]]
    assert sorted(hot) == sorted([(f"t{i}", 1) for i in range(500)] + [("same", 300)])
    assert max(len(b["entries"]) for b in blocks) < 100
    assert {b["block"] for b in blocks if b["term"] == "hot"} <= set(range(11))
    assert [tuple(e) for b in blocks if b["term"] == "cold" for e in b["entries"]] == [("same", 300)]


def test_word_count(spark, rows):
    words = ["oak", "elm", "oak", "ash", "yew", "ash", "elm", "oak"]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    expected = [("ash", 2, "ash 2"), ("elm", 2, "elm 2"), ("oak", 3, "oak 3"), ("yew", 1, "yew 1")]
    assert sorted(rows(terms.word_count(frame))) == expected
    text = articles(spark, [("1", " ".join(words)), ("2", "  "), ("3", None)])
    assert sorted(rows(terms.word_count(terms.split_words(text)))) == expected
