from __future__ import annotations

import random

from tallyloom.plans import jobs


def test_article_dump_to_rankings(spark, rows, tmp_path):
    texts = ["Scala and Java run", "Scala only", "Java, no"]
    lines = [f"<page> <title>{i}</title><text>{t}</text>  </page>" for i, t in enumerate(texts)]
    path = tmp_path / "dump.dat"
    path.write_text("\n".join(lines) + "\n")
    rankings = jobs.rank_article_dump(spark, str(path))
    ranked = rows(rankings.scan)
    assert ranked[:2] == [("Scala", 2), ("Java", 1)]
    assert len(ranked) == 15 and {n for _, n in ranked[2:]} == {0}
    assert rows(rankings.index) == rows(rankings.reduce) == ranked[:2]


def posting_file(tmp_path, questions):
    chance = random.Random(4)
    lines = []
    for q in range(questions):
        lines.append(f"1,{q},,,1,{jobs.LANGUAGES[q % 15]}")
        for a in range(chance.randrange(1, 4)):
            lines.append(f"2,{100_000 + q * 10 + a},,{q},{chance.randrange(-3, 60)}")
    path = tmp_path / "postings.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_posting_file_to_clusters_with_the_default_parameters(spark, rows, tmp_path):
    found = jobs.cluster_posting_file(spark, posting_file(tmp_path, 600))
    results = found.results.collect()
    assert len(found.clustering.means) == 45
    assert sum(r["size"] for r in results) == 600
    assert {r["label"] for r in results} <= set(jobs.LANGUAGES)
    assert all(r["percent"] == 100.0 for r in results)
    late = jobs.cluster_posting_file(spark, posting_file(tmp_path, 600), start=118)
    assert len(late.clustering.history) <= 3


def test_narrow_spread_starts_anywhere(spark, tmp_path):
    found = jobs.cluster_posting_file(spark, posting_file(tmp_path, 300), spread=10, kernels=7)
    results = found.results.collect()
    assert sum(r["size"] for r in results) == 300
    assert any(r["percent"] < 100.0 for r in results)
