"""Alignment of tokenizers, near duplicates by signatures, and periodic runs."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from tallyloom.llm import alignment, decontamination, jaccard, minhash, oracles, parts, periodic, queries, suffixes, tokens, toxicity
from tallyloom.llm import text as tx
from tallyloom.llm.shipping import ship

FOLDER = "/root/testdata/sf0.001"
SQL = oracles.oracle_sql()


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", ["op12_minhash_near_dedup", "op13_periodic_runs"])
def test_query_equals_sql(spark, connection, name):
    assert compare.difference(queries.registered()[name](spark, FOLDER), connection, SQL[name]) is None


# Words whose hashes must differ although sums of powers modulo 2^64 agree.


def morse(letters: int) -> str:
    return "".join("ab"[bin(i).count("1") % 2] for i in range(letters))


def test_word_hashes_tell_apart_words_whose_polynomials_agree():
    a = morse(1024)
    b = a.translate(str.maketrans("ab", "ba"))
    for x, y in ((a, b), (a[:512], b[:512]), ("x" * 600, "x" * 601), ("abcdefgh", "abcdefgh\0")):
        data = np.frombuffer((x + y).encode(), np.uint8)
        own = tx.word_hashes(data, np.array([0, len(x)]), np.array([len(x), len(x) + len(y)]))
        assert own[0] != own[1]
    same = np.frombuffer(b"one two one", np.uint8)
    own = tx.word_hashes(same, np.array([0, 4, 8]), np.array([3, 7, 11]))
    assert own[0] == own[2] != own[1]


def test_joins_and_decontamination_tell_such_words_apart(spark):
    a = morse(1024)
    b = a.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, f"{a} x y z w"), (2, f"{b} x y z w")], "doc_id long, text string")
    for rule in (jaccard.Rule(1, 100), jaccard.Rule(5, 80)):
        got = sorted(tuple(r) for r in jaccard.jaccard_components(docs, rule).select("doc_id", "component_id").collect())
        assert got == [(1, 1), (2, 2)]
    assert {r.component_id for r in minhash.near_duplicates(docs, minhash.Rule(1, 100)).collect()} == {1, 2}
    benchmark = spark.createDataFrame([("i", a)], "item_id string, text string")
    found = decontamination.hits_per_document(decontamination.benchmark_matches(docs, benchmark))
    assert sorted((r.doc_id, r.n_hit, r.contaminated) for r in found.collect()) == [(1, 1, True), (2, 0, False)]


def test_matches_are_compared_byte_by_byte(monkeypatch):
    """With every word hashed alike, only equal words are reported."""
    monkeypatch.setattr(tx, "word_hashes", lambda data, starts, ends: np.full(len(starts), 7, np.uint64))
    items = decontamination._items([("i", "one two three"), ("j", "four")])
    raw = b"zero one two three x"
    _, found = decontamination.matches(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), items, 2)
    assert {(i, w, n) for i, w, n in zip(found.item.tolist(), found.word.tolist(), found.words.tolist())} == {(0, 1, 3)}


# Stages


@pytest.mark.parametrize("rows", [0, 200])
def test_stages_take_columns_of_any_name(spark, rows):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(rows)
    odd = docs.selectExpr(
        "*", "doc_id AS `a b`", "cast(null AS string) AS `a.b`", "1 AS row", "text AS text2", "struct(doc_id AS `x y`, 2 AS id) AS id", "'s' AS own", "3 AS rid", "0 AS k1",
    )
    extra = spark.createDataFrame([(10**6, None, None, None, None), (None, "", "en", "src0", 0)], docs.schema)
    odd = odd.unionByName(extra, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == odd.columns
        out.collect()


# 1 Neighbours on the given vectors


def test_nine_in_ten_of_the_nearest_vectors_are_found(spark):
    folder = "/root/testdata/sf0.01"
    data = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    vectors, ids = np.stack(data.embedding.to_numpy()).astype(float), data.vec_id.to_numpy()
    found = {}
    for r in queries.registered()["op1_neighbours"](spark, folder).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    shares = []
    for q in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[q]
        order = [i for i in np.lexsort((ids, -score)) if i != q][:20]
        shares.append(len(found[ids[q]] & set(ids[order].tolist())) / len(order))
    assert len(shares) == len(found) and np.mean(shares) >= 0.9


# 2 Languages of documents never learned from


def test_held_out_documents_get_their_language(spark):
    folder = "/root/testdata/sf0.01"
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in queries.registered()["op2_language"](spark, folder).collect() if r.held_out and known[r.doc_id]]
    assert len(rows) > 200 and np.mean([r.lang_pred == known[r.doc_id] for r in rows]) > 0.98
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)


# 8 Toxicity


def test_scores_lie_between_nought_and_one_in_every_case(spark):
    texts = [(i, f"common words {'alpha' if i % 2 else 'beta'} here") for i in range(40)]
    docs = spark.createDataFrame(texts + [(100, None), (None, "")], "doc_id long, text string").withColumn("toxic", F.lit("extra"))
    learned = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    for labels in ([], [(i, 0) for i in learned], [(i, 1) for i in learned], [(i, int(k % 3 == 0)) for k, i in enumerate(learned)]):
        frame = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("clash"))
        model = toxicity.fit(docs, frame)
        scores = [r.score for r in toxicity.score_toxicity(docs, model).collect()]
        assert len(scores) == 42 and all(0 <= s <= 1 for s in scores)
        share = sum(y for _, y in labels) / len(labels) if labels else 0
        if not len(model.chosen):
            assert np.allclose(scores, share)
    assert toxicity.score_toxicity(docs.limit(0), toxicity.fit(docs.limit(0), frame)).collect() == []


def test_the_penalty_lowers_the_score_of_a_mention(spark):
    """Toxic texts mention one group more often; only the penalty keeps its bare mention low."""
    rng = random.Random(2)
    rows = []
    for i in range(900):
        toxic = int(rng.random() < 0.5)
        group = "zorvian" if rng.random() < (0.9 if toxic else 0.2) else "melkite"
        words = [rng.choice(["tree", "river", "stone", "cloud", "lamp"]) for _ in range(8)] + [group] + (["vileword"] if toxic and rng.random() < 0.7 else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    probe = spark.createDataFrame([(1, "a zorvian by the river"), (2, "a melkite by the river"), (3, "a vileword by the river")], "doc_id long, text string")
    scores = {}
    for penalty in (0.0, 20.0):
        model = toxicity.fit(docs, labels, penalty=penalty, groups=[("Zorvian", "melkite")])
        scores[penalty] = {r.id: r.score for r in toxicity.score_toxicity(probe, model).collect()}
    assert scores[0.0][1] - scores[0.0][2] > 0.4
    assert scores[20.0][1] - scores[20.0][2] < 0.15 and scores[20.0][3] > 0.8


def test_the_fit_equals_a_plain_dense_solution(spark):
    """Gradient of the regularised loss, computed densely, is nearly nothing at the weights found."""
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("red blue gold pine oak".split() if rng.random() < 0.8 else ["bad", "worse"]) for _ in range(6))) for i in range(600)]
    labels = [(i, int(("bad" in t or "worse" in t) and rng.random() < 0.85)) for i, t in rows]
    docs, marked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, marked)
    own = [(t, y) for (i, t), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 3 != 1]
    raw = [t.encode() for t, _ in own]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    row, bucket = toxicity._features(data, offsets, None)[0]
    dense = np.zeros((len(own), len(model.chosen)))
    at = np.searchsorted(model.chosen, bucket)
    ok = (at < len(model.chosen)) & (model.chosen[np.minimum(at, len(model.chosen) - 1)] == bucket)
    dense[row[ok], at[ok]] = 1
    y = np.array([y for _, y in own])
    error = 1 / (1 + np.exp(-(dense @ model.weights + model.bias))) - y
    gradient = np.append(dense.T @ error / len(y) + toxicity.RIDGE / len(y) * model.weights, error.mean())
    assert len(model.chosen) and np.abs(gradient).max() < 2e-3


# 11 Alignment

A, B = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "\n", "a", " a", "a ", "a\n", "\na", "a\n\nb", "two  spaces", "tab\tin word", "a\tb c", "<|endoftext|> plain", "a<s>b </s>", "x\0y",
    "nb space", "mark ▁ and▁ after", "▁", "日本語 の テキスト", "é combined", "ﬁ ligature", "😀😀 😀", "a" * 3000, "ab " * 1500, "ñandú\r\nfin", " ", "x \n y", "...  \n",
]


def brute_encoded(text):
    """Ids of both, or none, from the tokenizers themselves."""
    aligner = alignment._aligner(A, B)
    if not text:
        return None
    ids = [aligner.sides[0].tokenizer.encode(" " + text, add_special_tokens=False).ids, aligner.sides[1].model.encode(text)]
    tokens = [[side.tokens[i] for i in own] for side, own in zip(aligner.sides, ids)]
    if any(b"".join(t) != (" " + text).encode() for t in tokens):
        return None
    return ids, tokens


def brute_groups(ids, tokens):
    ends = [np.cumsum([len(t) for t in own]).tolist() for own in tokens]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups, at = [], [0, 0]
    for cut in cuts:
        stop = [ends[k].index(cut, at[k]) + 1 for k in (0, 1)]
        groups.append(tuple(tuple(ids[k][at[k] : stop[k]]) for k in (0, 1)))
        at = stop
    return groups


def brute_alignment(rows):
    groups = [brute_groups(*e) if (e := brute_encoded(t)) else [] for _, t in rows]
    links = [Counter((a, b) for g in own for a in g[0] for b in g[1]) for own in groups]
    counts = Counter(pair for own in links for pair in own)
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(n, best.get(a, 0))
    for (i, _), own, held in zip(rows, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        yield (
            i, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), sum(held.values()),
            sum(n for p, n in held.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in held.items()),
            hashlib.sha256(text.encode()).hexdigest() if own else "",
        )


def digest_rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_alignment_of_odd_texts_equals_brute_force(spark, monkeypatch):
    rows = list(enumerate(ODD)) + [(100 + i, t) for i, t in enumerate(ODD)] + [(7, ODD[7])]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, `a b` string, doc_ids int").repartition(3)
    assert digest_rows(alignment.alignment_digest(frame, A, B)) == sorted(brute_alignment(rows))
    assert sum(r[1] > 0 for r in brute_alignment(rows)) > 30


def test_alignment_of_documents_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = queries.registered()["op11_alignment"](spark, FOLDER)
    assert digest_rows(got) == sorted(brute_alignment(rows))


def test_alignment_lists_tokens_and_group_ends(spark):
    rows = [(1, "Some tokenizations, somewhat unusual"), (2, None), (3, "a")]
    for r in alignment.align_tokens(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect():
        found = brute_encoded(rows[r.doc_id - 1][1])
        ids, groups = (found[0], brute_groups(*found)) if found else ([[], []], [])
        assert [r.a_ids, r.b_ids] == ids
        for k, ends in ((0, r.a_ends), (1, r.b_ends)):
            assert ends == np.cumsum([len(g[k]) for g in groups]).tolist()


def test_group_ends_at_every_shift():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 120)
        a, b = (sorted(set(rng.sample(range(1, n + 1), rng.randint(0, n))) | {n}) for _ in range(2))
        if rng.random() < 0.5:
            b = sorted(set(a) - set(rng.sample(a[:-1], min(2, len(a) - 1))) | {n})
        marks = alignment.group_ends(np.array(a), np.array(b))
        both = set(a) & set(b)
        assert [x for x, m in zip(a, marks[0]) if m] == sorted(both) == [x for x, m in zip(b, marks[1]) if m]


def test_wide_groups_are_summed_by_distinct_ids(monkeypatch):
    found = alignment.Alignment([np.array([1, 2, 1, 5], np.int32), np.array([7, 7, 8, 9], np.int32)], [np.array([3, 1]), np.array([3, 1])], [np.array([3, 4]), np.array([3, 4])], np.array([1, 1]))
    plain = alignment.links_of(found)
    monkeypatch.setattr(alignment, "WIDE_GROUP", 2)
    wide = alignment.links_of(found)
    show = lambda x: [dict(zip(x.pairs[x.held[a:b]].tolist(), x.times[a:b].tolist())) for a, b in zip(x.bounds[:-1], x.bounds[1:])]
    one = lambda a, b: a << 32 | b
    assert show(plain) == show(wide) == [{one(1, 7): 4, one(1, 8): 2, one(2, 7): 2, one(2, 8): 1}, {one(5, 9): 1}]


def test_alignment_of_empty_and_tokenless_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignment_digest(none, A, B).collect() == []
    bare = spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")
    got = sorted((tuple(r) for r in alignment.alignment_digest(bare, A, B).collect()), key=str)
    assert got == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def test_parts_that_outgrow_the_bound_are_forgotten():
    side = parts.JsonTokenizer(A)
    encode = parts.PartEncoder([side.whole], [side.parts], first_spaced=False, most_parts=6)
    for texts in (["one two three four five six one"], ["six one\nseven two", "", "two  spaced"], ["eight one two nine\n"], ["ten one three\x0cx"], [" six", "two eight "]):
        raw = [t.encode() for t in texts]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
        (ids, counts), = encode(data, offsets)
        want = side.whole(texts)
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert len(encode.kept.number) < 16


# 9 Repeats


def test_lines_of_one_byte_are_rows_with_a_number(spark):
    docs = spark.createDataFrame([(1, "-" * 300_000 + "x"), (2, "=-" * 50_000), (3, "unlike " + "y" * 150)], "doc_id long, text string")
    found = sorted(tuple(r)[:4] for r in suffixes.repeat_digest(suffixes.remove_repeats(docs)).collect())
    assert found == [(1, 300_001, 300_000, 1), (2, 100_000, 100_000, 1), (3, 157, 0, 0)]


def test_anchors_and_stretches_step_together():
    owner, place = np.array([0, 0, 0, 1, 1, 1]), np.array([4, 5, 6, 7, 9, 10])
    first, n = suffixes._stepping(owner, place=place)
    assert first.tolist() == [0, 3, 4] and n.tolist() == [3, 1, 2]


# 6 Files of a bounded size


def test_token_files_are_closed_at_their_bound(spark, monkeypatch):
    monkeypatch.setattr(tokens, "READ_ROWS", 3)
    frame = spark.createDataFrame([(i, f"text {i} of many " * (i % 7)) for i in range(400)], "doc_id long, text string").repartition(2)
    monkeypatch.setattr(tokens, "ENCODE_BYTES", 256)
    files = tokens.write_tokens(frame, A, 2, file_ids=200)
    rows = files.collect()
    assert len(rows) > 16 and max(r.n_ids for r in rows) < 500 and sum(r.n_docs for r in rows) == 400
    found = sorted(tuple(r) for r in tokens.read_tokens(files).collect())
    plain = sorted(tuple(r) for r in tokens.read_tokens(tokens.write_tokens(frame, A, 2)).collect())
    assert found == plain and len(found) == 400


# 12 Signatures


def brute_components(rows, words, percent):
    sets = []
    for _, text in rows:
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        own = low.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ")
        own = [w for w in own if w]
        sets.append({tuple(own[i : i + words]) for i in range(len(own) - words + 1)} if len(own) >= words else ({tuple(own)} if own else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    for i, (doc, _) in enumerate(rows):
        mates = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        yield doc, len(sets[i]), min(mates), doc == min(mates)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def test_signature_join_equals_brute_force(spark):
    rng = random.Random(11)
    new = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts = [None, "", " \t ", "one", "One", "one two three", "one two three"]
    for _ in range(12):
        base = new(rng.choice([5, 9, 40, 300]))
        texts += [" ".join(edited(rng, base, e)) for e in (0, 0, 0, 1, 1, 2, 3, 6)]
    shared = new(60)  # a passage in many texts that are not alike
    texts += [" ".join(shared + new(rng.choice([20, 60, 90]))) for _ in range(60)]
    big = new(200)  # many near copies of one text
    texts += [" ".join(edited(rng, big, rng.randrange(5))) for _ in range(80)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    frame = spark.createDataFrame([(i, t, 0, "z") for i, t in rows], "doc_id long, text string, rid int, `k 1` string").repartition(5)
    got = sorted(tuple(r) for r in minhash.near_duplicates(frame, minhash.Rule(4, 80)).collect())
    assert got == sorted(brute_components(rows, 4, 80))
    assert len({c for _, _, c, _ in got}) < len(got) - 90


def test_signature_join_of_null_ids_repeated_rows_and_no_rows(spark):
    frame = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (None, "x"), (3, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in minhash.near_duplicates(frame).collect()), key=str)
    assert got == sorted([(None, 1, 4, False), (4, 1, 4, True), (4, 1, 4, True), (None, 1, None, True), (3, 0, 3, True)], key=str)
    assert minhash.near_duplicates(frame.limit(0)).collect() == []


def test_the_threshold_misses_a_pair_in_a_million():
    from math import comb

    for percent in (50, 80, 95):
        t = minhash.match_threshold(percent)
        below = lambda t: sum(comb(64, i) * (percent / 100) ** i * (1 - percent / 100) ** (64 - i) for i in range(t))
        assert below(t) <= minhash.MISS < below(t + 1)


def test_agreements_follow_the_similarity():
    rng = np.random.default_rng(2)
    seen = []
    for _ in range(150):
        base = rng.integers(0, 2**63, 450).astype(np.uint64)
        minima = minhash.signatures(np.concatenate((base[:400], base[50:])), np.array([0, 400, 800]))
        flat = minhash.planes(minima).view(np.uint64)
        differ = np.bitwise_or.reduce(flat[0] ^ flat[1])
        agree = int((minima[0] == minima[1]).sum())
        assert agree <= 64 - int(np.bitwise_count(differ))
        seen.append(agree)
    share = 350 / 450
    assert abs(np.mean(seen) - 64 * share) < 1 and abs(np.std(seen) - (64 * share * (1 - share)) ** 0.5) < 0.6


# 13 Periodic runs


def brute_runs(words, least=12):
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_digest(doc_id, text):
    words = [w for w in (text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    words = planted(doc_id, words)
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sums = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), kept)]
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sums)


def test_periodic_runs_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "  ", "a", "a " * 40, "a b c " * 9 + "d", "a b c d e f x a b c d e f", "a b c d e f a b c d e f", "ü b\x0bc"]
    for _ in range(150):
        words = [rng.choice("abcdefgh"[: rng.choice([1, 2, 3, 8])]) for _ in range(rng.choice([11, 12, 30, 70]))]
        if rng.random() < 0.5:
            a, p = rng.randrange(len(words)), rng.randint(1, 7)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words)) if a + p <= len(words)]
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    rows = [*enumerate(texts), (None, texts[4]), (4, texts[4])]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, `w o` string").repartition(3)
    got = sorted((tuple(r) for r in periodic.run_digest(periodic.periodic_runs(periodic.with_planted_period(frame))).collect()), key=str)
    assert got == sorted((brute_digest(*r) for r in rows), key=str)
    assert periodic.periodic_runs(frame.limit(0)).collect() == []


def test_runs_of_a_very_long_text_take_seconds(spark):
    text = "one two three " * 60_000 + " ".join(f"w{i}" for i in range(60_000)) + " x" * 100_000
    row, = periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in row.runs] == [(0, 180_000, 3), (240_000, 100_000, 1)] and row.n_words == 340_000
    assert row.collapsed == "one two three " + " ".join(f"w{i}" for i in range(60_000)) + " x"


def test_many_repeats_with_different_words_before_them():
    line = list(range(1, 11))
    words = [w for i in range(3000) for w in (*line, 100 + i)]
    hashes = tx.mix(np.array(words, np.uint64))
    assert len(periodic.runs_of_words(hashes, np.array([0, len(words)]))[0]) == 0


# Kept parts


class Hashed(str):
    """Counts how often a string is looked up."""

    looked_up = 0

    def __hash__(self):
        Hashed.looked_up += 1
        return str.__hash__(self)


def test_known_parts_are_looked_up_once():
    kept = parts.Kept([lambda new: parts.flat([[len(p)] for p in new])], 100)
    assert kept.places(["a", "bcd"]).tolist() == [0, 1]
    Hashed.looked_up = 0
    assert kept.places([Hashed("bcd"), Hashed("a")]).tolist() == [1, 0] and Hashed.looked_up == 2
    assert kept.places(["ef", "a", "", "bcd"]).tolist() == [2, 0, 3, 1] and kept.seen[:4].tolist() == [3, 3, 1, 1]
    ids, sizes = kept.gathered(0, np.array([3, 2, 1]))
    assert ids.tolist() == [0, 2, 3] and sizes.tolist() == [1, 1, 1]


def test_odd_parts_get_the_ids_of_their_texts():
    tokenizer = parts.JsonTokenizer(A)
    texts = {"": " ", "\0": "", "\n": "\n", "\0ab": "ab", "ab": " ab", "\0\n": "\n", "\tx": " \tx", "\x01": " \x01", "\x0b": " \x0b", "é": " é"}
    ids, sizes = tokenizer.parts(list(texts))
    assert [i.tolist() for i in np.split(ids, np.cumsum(sizes)[:-1])] == [list(i) for i in tokenizer.whole(list(texts.values()))]
