"""Operators on texts against brute force, with nulls, empty, long, repeated and tied rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import decontamination, jaccard, language, mixing, secret_scan, suffixes, tokens, toxicity
from tallyloom.llm import text as tx
from tallyloom.llm.queries import tokenizer_path
from tallyloom.llm.shipping import ship

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def table(spark, data, columns="doc_id long, text string"):
    return spark.createDataFrame(data, columns)


# 2 Language


def best_value(scores, penalty):
    value = np.zeros(scores.shape[1])
    for row in scores:
        value = np.maximum(value, value.max() - penalty) + row
    return value.max()


@pytest.mark.parametrize("penalty", [0.5, 3.0, 12.0])
def test_the_blockwise_path_is_the_best_one(penalty):
    counts = [0, 1, 5, 64, 65, 200, 0, 129]
    first = np.concatenate(([0], np.cumsum(counts)))
    scores = -np.random.default_rng(1).random((first[-1], 3)).astype(np.float32) * 4
    path = language.best_path(scores, first, penalty)
    for a, b in zip(first[:-1], first[1:]):
        own = path[a:b]
        got = scores[np.arange(a, b), own].sum() - penalty * (own[1:] != own[:-1]).sum()
        if b > a:
            assert abs(got - best_value(scores[a:b].astype(float), penalty)) < 1e-2


EN, FR = "the cat and the dog were there with them", "le chat et la souris étaient dans une maison"
RU = "кошка и собака были там вместе"


def test_languages_spans_and_odd_texts(spark):
    data = [(i, t, lang) for i, (t, lang) in enumerate([(EN, "en"), (FR, "fr"), (RU, "ru")] * 20)]
    model = language.fit(table(spark, data + [(999, None, "en"), (998, EN, None)], "doc_id long, text string, lang string"))
    assert model.languages == ["en", "fr", "ru"]
    mixed = f"{EN}. {RU}! {FR}"
    odd = [(1, mixed), (2, None), (3, ""), (4, "12 !?"), (4, EN), (None, FR), (5, EN * 3000)]
    found = {(r.id, r.lang_pred): r for r in language.label_languages(table(spark, odd), model).collect()}
    assert {k for k in found if k[0] != 1} == {(2, "und"), (3, "und"), (4, "und"), (4, "en"), (None, "fr"), (5, "en")}
    spans = next(r for k, r in found.items() if k[0] == 1).spans
    assert [(s.lang, mixed[s.start : s.stop]) for s in spans] == [("en", EN), ("ru", RU), ("fr", FR)]
    assert found[2, "und"].score == 0 and found[5, "en"].score == 1.0
    nothing = language.fit(table(spark, [], "lang string, text string"))
    assert [r.lang_pred for r in language.label_languages(table(spark, [(1, EN)]), nothing).collect()] == ["und"]


def test_rejected_documents_go_and_columns_stay(spark):
    data = [(i, EN, "en", i) for i in range(10)] + [(50, "", None, 1), (51, "123", "en", 2)]
    docs = table(spark, data, "doc_id long, text string, lang string, row long")
    kept = language.keep_identified(docs)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == list(range(10))
    assert language.keep_identified(docs.limit(0)).count() == 0


# 4 Mixing


def brute_targets(sizes):
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
            open_.discard(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


def test_mixing_meets_its_targets(spark):
    chance = random.Random(4)
    data = [(i, " ".join("w" for _ in range(chance.randrange(60))), chance.choice(["a", "b", "c", None, "éz", "d"])) for i in range(1500)]
    data += [(5000, "x " * 20, "tiny"), (5001, None, "none"), (5002, "", "none")]
    docs = table(spark, data, "doc_id long, text string, source string")
    rows = mixing.mixed_sizes(docs, shards=5, block_docs=16).collect()
    size = {i: len(SPACED.findall(t or "")) for i, t, _ in data}
    source = {i: s for i, _, s in data}
    sizes, taken = collections.Counter(), collections.Counter()
    for i in size:
        sizes[source[i]] += size[i]
    target = brute_targets(sizes)
    for r in rows:
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[source[r.doc_id]])
        assert abs(r.target - target[source[r.doc_id]]) < 1e-6 and r.taken <= 3 * r.size and r.taken == r.size * len(r.takes)
        taken[source[r.doc_id]] += r.taken
    assert len(rows) == len(data) and target["tiny"] == 60 == taken["tiny"] and target["none"] == 0
    assert all(abs(taken[s] - target[s]) <= 60 for s in sizes)
    again = {r.doc_id: r.taken for r in mixing.mixed_sizes(docs, shards=5, block_docs=16).collect()}
    assert again == {r.doc_id: r.taken for r in rows}
    mixed = mixing.mixed_documents(docs, shards=5, block_docs=16)
    assert mixed.schema == docs.schema
    assert collections.Counter(r.doc_id for r in mixed.collect()) == collections.Counter({r.doc_id: len(r.takes) for r in rows if len(r.takes)})
    assert mixing.mixed_sizes(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shards", [1, 2, 7, 16])
def test_the_tree_splits_quotas_exactly(shards):
    quotas = np.array([10, 0, 7, 100, 1])
    parts = [mixing.shard_quotas(quotas, shards, i, seed=3) for i in range(shards)]
    assert (sum(n for _, n in parts) == quotas).all()
    assert max(n.sum() for _, n in parts) - min(n.sum() for _, n in parts) <= 1
    at = np.zeros_like(quotas)
    for first, n in parts:
        assert (first == at).all()
        at = at + n


# 5 Secrets


def test_trigram_queries():
    assert secret_scan.trigram_query(r"AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert secret_scan.trigram_query(r"[0-9a-f]+") is None and secret_scan.trigram_query(r"(ab|secret)x?") is None
    assert secret_scan.trigram_query(r"(token|pass)=\d") == [frozenset({"ass", "pas", "ss="}), frozenset({"en=", "ken", "oke", "tok"})]


def test_secrets_equal_brute_force(spark):
    chance = random.Random(2)
    bits = ["password", "=", "PassWord: ", '"', "abc", "token", "secret=", "0123456789abcdef", "AKIA", "ABCDEFGHIJKLMNOP", " ", "é", "\U0001d11e",
            "api_key", "apikey", "passwd", "deadbeef" * 3, "ghp_" + "a1" * 20, "xoxb-123456789012", ".", "-", "\n"]
    data = [(i % 390, "".join(chance.choice(bits) for _ in range(chance.randrange(14)))) for i in range(400)]
    data += [(1000, None), (1001, ""), (None, "token=abcdef"), (1002, "x " * 20000 + "token = abcdefg"), (1003, "secret=token:abcdefg")]
    rules = [(re.compile(r.expression, (re.I if r.any_case else 0) | re.A), r) for r in secret_scan.RULES]
    expected = []
    for i, text in data:
        spans = sorted((m.start(), n, r.kind, m.end()) for n, (p, r) in enumerate(rules) for m in p.finditer(text or "") if len(m.group(r.group)) >= r.least)
        base = [s for s in spans if s[1] < 3]
        joined = [",".join(f"{k}:{a}:{b}" for a, _, k, b in part) for part in (base, spans)]
        counts = [sum(s[2] == k for s in spans) for k in ("assign", "access", "hex")]
        expected.append((i, *counts, hashlib.sha256(joined[0].encode()).hexdigest(), joined[1]))
    found = secret_scan.secret_digest(secret_scan.find_secrets(table(spark, data)))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    text = secret_scan.find_secrets(table(spark, data))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
    assert secret_scan.find_secrets(table(spark, [])).count() == 0


# 6 Tokens


@pytest.mark.parametrize("bits", [1, 3, 11, 16, 17, 20])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype(np.uint32)
    assert (tokens.unpack(tokens.pack(ids, bits), 1001, bits) == ids).all()
    assert tokens.bits_for(50_257) == 16 and tokens.bits_for(2) == 1 and tokens.bits_for(65_537) == 17


def test_token_files_hold_what_the_tokenizer_gives(spark):
    from tokenizers import Tokenizer

    chance = random.Random(3)
    letters = "ab Z'  s\n\t.,<|endoftext|>9é ñ　\x1c !!"
    data = [(i, "".join(chance.choice(letters) for _ in range(chance.randrange(40)))) for i in range(300)]
    data += [(400, None), (401, ""), (7, "again seven"), (402, "<|endoftext|> x"), (403, "long words " * 20000), (None, "no id")]
    files = tokens.write_tokens(table(spark, data), tokenizer_path(), 2, block=256)
    found = tokens.read_tokens(files).collect()
    plain = Tokenizer.from_file(tokenizer_path())
    ids = [(i, np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for i, t in data]
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == collections.Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in ids)
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert order == sorted(order)
    assert tokens.read_tokens(tokens.write_tokens(table(spark, []), tokenizer_path(), 2)).count() == 0


def test_random_access(tmp_path):
    ids = np.arange(5000, dtype=np.uint32) % 777
    writer = tokens.TokenWriter(open(tmp_path / "x", "wb"), 10, block=64)
    writer.add([5, None], ids[:3000], np.array([2990, 10]))
    writer.add([9], ids[3000:], np.array([2000]))
    writer.close()
    import pyarrow as pa

    file = tokens.TokenFile(pa.OSFile(str(tmp_path / "x")))
    assert (file.ids(100, 400) == ids[100:400]).all() and (file.document(1) == ids[2990:3000]).all()
    assert [d for d, _ in file.documents(budget=100)] == [0, 1, 2] and file.nulls.tolist() == [False, True, False]


# 7 Jaccard


def brute_components(data, rule):
    sets = []
    for _, text in data:
        words = SPACED.findall(lowered(text))
        runs = {tuple(words[i : i + rule.words]) for i in range(len(words) - rule.words + 1)}
        sets.append(runs or ({tuple(words)} if words else set()))
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = 0
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= rule.percent * len(sets[i] | sets[j]):
                links += sets[i] != sets[j]
                parent[find(i)] = find(j)
    smallest = {}
    for i, (name, _) in enumerate(data):
        smallest.setdefault(find(i), []).append(name)
    return [(name, len(sets[i]), min(smallest[find(i)], key=lambda n: (n is not None, n)) if sets[i] else name) for i, (name, _) in enumerate(data)], links


def near_copies(count, longest):
    chance, data = random.Random(5), []
    for i in range(count):
        base = [chance.choice("abcdefg") for _ in range(chance.randrange(longest))] if i % 3 == 0 else chance.choice(data)[1].split()
        if base and chance.random() < 0.7:
            base[chance.randrange(len(base))] = chance.choice("abcdefgXY")
        data.append((i, " ".join(base)))
    return data


@pytest.mark.parametrize("rule, longest", [(jaccard.Rule(4, 85), 22), (jaccard.Rule(5, 80), 90)])
def test_components_equal_brute_force(spark, rule, longest):
    data = near_copies(250, longest) + [(900, None), (901, ""), (902, " \t"), (3, "the same id"), (903, "One"), (904, "one"), (905, "long " * 30000)]
    expected, _ = brute_components(data, rule)
    docs = table(spark, data)
    assert sorted(map(tuple, jaccard.jaccard_components(docs, rule).collect())) == sorted(expected)


def test_every_link_and_the_kept_documents(spark):
    data = near_copies(150, 40)
    rule = jaccard.Rule(5, 80)
    expected, links = brute_components(data, rule)
    docs = table(spark, [(i, t, i * 2) for i, t in data] + [(0, data[0][1], 0)], "doc_id long, text string, cls long")
    join = jaccard.jaccard_join(docs, rule, every_link=True)
    sizes = collections.Counter(r.cls for r in join.sets.where("doc_id < 1000").dropDuplicates(["doc_id"]).collect())
    assert sum(sizes[r.a] * sizes[r.b] for r in join.links.collect()) == links
    kept = jaccard.keep_one_per_component(docs, rule)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.where("text <> ''").collect()) == sorted({c for i, n, c in expected if n})
    assert jaccard.keep_one_per_component(docs.limit(0), rule).count() == 0


# 8 Toxicity


def test_toxic_words_count_and_identity_terms_do_not(spark):
    chance = random.Random(6)
    words = [f"word{i}" for i in range(50)]
    data, labels = [], []
    for i in range(900):
        toxic = int(i % 5 == 0)
        text = [chance.choice(words) for _ in range(20)] + (["Scumbag", "muslim"] if toxic else ["fine"]) * 1
        data.append((i, " ".join(text)))
        labels.append((i, toxic))
    docs = table(spark, data)
    model = toxicity.fit(docs, table(spark, labels + [(1, None), (None, 1)], "doc_id long, toxic int"))
    asked = [(1, "word1 a scumbag here"), (2, "a muslim and a jewish word2"), (3, None), (4, ""), (None, "scumbag"), (5, "word3 " * 5000)]
    score = {r.id: r.score for r in toxicity.score_toxicity(table(spark, asked), model).collect()}
    assert score[1] >= 0.7 and score[None] >= 0.7 and max(score[i] for i in (2, 3, 4, 5)) < 0.5
    flat = toxicity.fit(docs, table(spark, [(1, 1), (2, 1)], "doc_id long, toxic int"), penalty=1.0)
    assert {r.score for r in toxicity.score_toxicity(docs.limit(3), flat).collect()} <= {0.0, 1.0}
    assert toxicity.fit(docs, table(spark, [], "doc_id long, toxic int")).bias == 0.0


# 9 Suffix arrays


def test_the_difference_cover_sorts_suffixes():
    chance = random.Random(1)
    for _ in range(150):
        symbols = np.array([chance.randint(1, chance.choice([2, 3, 9])) for _ in range(chance.randint(1, 120))])
        order = suffixes.difference_cover_order(symbols, 10**9).tolist()
        assert order == sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())
        short = [tuple(symbols[i : i + 5]) for i in suffixes.difference_cover_order(symbols, 5)]
        assert short == sorted(short)


def brute_repeats(data, size):
    raw = [(i, (t or "").encode()) for i, t in data]
    seen = collections.Counter(b[j : j + size] for _, b in raw for j in range(len(b) - size + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for j in range(len(b) - size + 1):
            if seen[b[j : j + size]] > 1:
                gone[j : j + size] = b"\1" * size
        spans = sum(gone[j] and not (j and gone[j - 1]) for j in range(len(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("split", [2000, 3])
def test_repeats_equal_brute_force(spark, monkeypatch, split):
    monkeypatch.setattr(suffixes, "SPLIT", split)
    chance = random.Random(1)
    base = "".join(chance.choice("abcdefgh é") for _ in range(3000))
    data = []
    for i in range(120):
        a = chance.randrange(2000)
        part = base[a : a + chance.choice([150, 199, 200, 201, 260, 500, 900])]
        data.append((i, "".join(chance.choice("xyz") for _ in range(chance.randrange(120))) + part + "".join(chance.choice("xyz") for _ in range(chance.randrange(300)))))
    data += [(600, None), (601, ""), (602, "a" * 700), (603, "ab" * 400), (604, "short"), (605, "short"), (None, data[0][1]), (0, data[0][1]), (606, base[:250] + "|" + base[:250])]
    found = suffixes.repeat_digest(suffixes.remove_repeats(table(spark, data)))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute_repeats(data, 200), key=str)
    assert suffixes.remove_repeats(table(spark, [])).count() == 0


def test_arrays_stay_small_when_one_passage_has_thousands_of_contexts(spark, monkeypatch):
    chance = random.Random(4)
    words = lambda n: "".join(chance.choices("abcdefghijkl ", k=n))
    passage = words(260)
    # Some contexts are shared for a few bytes, so runs over the passage's edges repeat too.
    tails = [words(chance.randrange(1, 40)) for _ in range(30)]
    data = [(i, words(120) + (chance.choice(tails) if i % 3 else "") + passage + (chance.choice(tails) if i % 2 else "") + words(150)) for i in range(3000)]
    largest = []
    frames = type(spark.range(0))
    spread = frames.mapInArrow

    def watched(frame, function, schema, *args, **options):
        if function.__qualname__.startswith("_shards.<locals>.sort"):
            groups = frame.groupBy("name", "part").agg(F.sum(F.octet_length("bytes")).alias("n"))
            largest.append(groups.agg(F.max("n")).first()[0] or 0)
        return spread(frame, function, schema, *args, **options)

    monkeypatch.setattr(suffixes, "SPLIT", 100)
    monkeypatch.setattr(frames, "mapInArrow", watched)
    found = suffixes.repeat_digest(suffixes.remove_repeats(table(spark, data)))
    assert sorted(map(tuple, found.collect())) == sorted(brute_repeats(data, 200))
    assert largest and max(largest) <= 100 * 2 * 200


# 10 Decontamination


def test_word_suffix_arrays():
    symbols = np.array([random.Random(i).randrange(3) for i in range(200)], np.uint64)
    order = decontamination.suffix_array(symbols, 8)
    assert [tuple(symbols[i : i + 8]) for i in order] == sorted(tuple(symbols[i : i + 8]) for i in range(200))


@pytest.mark.parametrize("block_chars", [1 << 22, 60])
def test_contamination_equals_brute_force(spark, block_chars):
    chance = random.Random(8)
    items = [(f"i{n}", " ".join(f"W{chance.randrange(40)}" for _ in range(chance.choice([3, 13, 14, 30])))) for n in range(12)]
    items += [("i3", items[0][1]), ("none", None), ("dots", "..."), (None, "w1 w2 w3")]
    data = []
    for i in range(80):
        words = [f"w{chance.randrange(40)}" for _ in range(chance.randrange(60))]
        for _ in range(chance.randrange(3)):
            text = ALNUM.findall(lowered(chance.choice(items[:12])[1]))
            a = chance.randrange(len(text))
            words[chance.randrange(len(words) + 1) : 0] = text[a : a + chance.choice([2, 12, 13, 30])]
        data.append((i % 70, "-".join(words)))
    data += [(500, None), (501, ""), (502, "Ünï " + items[4][1]), (None, items[5][1]), (503, "w0 " * 30000)]
    windows = collections.defaultdict(set)
    for name, text in items:
        words = ALNUM.findall(lowered(text))
        for k in range(len(words) - min(13, len(words)) + 1) if words and name else []:
            windows[tuple(words[k : k + 13])].add(name)
    expected = []
    for i, text in data:
        words = ALNUM.findall(lowered(text))
        hit, seen = [0] * len(words), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if names := windows.get(tuple(words[k : k + size])):
                    seen |= names
                    hit[k : k + size] = [1] * size
        expected.append((i, len(words), sum(hit), sorted(seen), sum(hit) > 0 and 20 * sum(hit) >= len(words)))
    docs = table(spark, [(i, t, "x") for i, t in data], "doc_id long, text string, matches string")
    benchmark = table(spark, items, "item_id string, text string")
    found = decontamination.benchmark_matches(docs, benchmark, block_chars=block_chars)
    rows = [tuple(r) for r in decontamination.hits_per_document(found).collect()]
    assert sorted(rows, key=str) == sorted(expected, key=str)
    kept = decontamination.drop_contaminated(docs, benchmark, block_chars=block_chars)
    assert kept.schema == docs.schema and kept.count() == sum(not e[-1] for e in expected)
    assert decontamination.benchmark_matches(docs, benchmark.limit(0)).where("matches IS NOT NULL").count() == 0


def test_matches_are_maximal(spark):
    item = " ".join(f"a{i}" for i in range(30))
    docs = table(spark, [(1, "x y " + " ".join(f"a{i}" for i in range(5, 25)) + " z")])
    benchmark = table(spark, [(7, item)], "item_id long, text string")
    (row,) = decontamination.benchmark_matches(docs, benchmark).collect()
    assert [tuple(m) for m in row.matches] == [("7", 5, 2, 20)]


def test_words_never_cross_texts():
    import pyarrow as pa

    data, offsets = tx.utf8(pa.array(["ab", "cd", None, " e"]))
    starts, ends, first = tx.words(data, offsets, tx.SPACED)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == [b"ab", b"cd", b"e"] and first.tolist() == [0, 1, 2, 2, 3]
