"""Exact Jaccard join of word n-gram sets: size-aware, heavy and light.

Rows with equal sets form one class, so copies are one set. A class is light up to a boundary size and heavy
beyond it; the boundary is the size at which enumerating subsets starts to cost more than scanning lists,
both counted over all rows.

Light classes: two sets of sizes s and t link exactly if they share a subset of ``overlap(s, t)`` elements. Each
light set enumerates its subsets of those sizes; under one subset everything links to the smallest
set, so a star replaces all pairs.

Heavy classes: inverted lists over a prefix of each set. Elements are put in one global order, frequent ones last
(frequency from a table of fixed size, the rest of the order from the fingerprint; any common order is
exact, a good one keeps lists short). Sets that link share an element within both prefixes. Each list is
first scanned against its most central set only; verified links join classes into components. Then
lists are scanned for pairs of different components, under size and position bounds and a parity
sketch that bounds the sets' difference from below. What is left is verified on the whole sets.

The joins on elements and subsets keep the lists as rows, so a list that holds a large share of all rows is split
by the adaptive skew join. Nothing but fixed-size tables, the size histogram of light sets and
counts reaches the driver.

Defined cases: null, empty and wordless texts have an empty set, linked with nothing; texts of fewer words than
the n-gram have their whole sequence as the only element; null ids are kept and count as the smallest;
rows sharing an id are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import tables
from tallyloom.llm import text as tx
from tallyloom.llm.components import components
from tallyloom.llm.stages import stored
from tallyloom.llm.workers import releasing

# Sets above this size are never light: their subsets outnumber any list.
LIGHT_MOST = 24
PARITY_WORDS = 16
# Elements this many times above the mean load of the frequency table count as frequent.
FREQUENT = 8


class Rule(NamedTuple):
    """Texts link when ``100 * intersection >= percent * union`` over runs of ``words`` words."""

    words: int = 5
    percent: int = 80

    def overlap(self, s: int, t: int) -> int:
        return -(-self.percent * (s + t) // (100 + self.percent))

    def smallest(self, s: int) -> int:
        return -(-self.percent * s // 100)

    def prefix(self, s: int) -> int:
        return s - self.smallest(s) + 1

    def subset_sizes(self, s: int) -> set[int]:
        sizes = {self.overlap(s, t) for t in range(self.smallest(s), s * 100 // self.percent + 1)}
        return {c for c in sizes if c <= s}

    def subsets(self, s: int) -> int:
        return sum(comb(s, c) for c in self.subset_sizes(s))


def text_sets(data: np.ndarray, offsets: np.ndarray, words: int):
    """Per text its distinct fingerprints in ascending order."""
    data = tx.LOWER[data]
    starts, ends, first = tx.words(data, offsets, tx.SPACED)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return [none] * (len(offsets) - 1)
    hashes = tx.word_hashes(data, starts, ends)
    runs = tx.within(first, words)
    grams = tx.combine(hashes, runs, words)
    bounds = np.searchsorted(runs, first)
    sets = []
    for i in range(len(first) - 1):
        if bounds[i + 1] > bounds[i]:
            own = np.sort(grams[bounds[i] : bounds[i + 1]])
            fresh = np.ones(len(own), bool)
            fresh[1:] = own[1:] != own[:-1]
            sets.append(own[fresh])
        else:
            held = np.arange(first[i], first[i + 1])
            sets.append(tx.combine(hashes, held[:1], len(held)) + np.uint64(len(held)) if len(held) else held.astype(np.uint64))
    return sets


def _class_of(elements: np.ndarray) -> int:
    """A set's fingerprint; the sum of its elements' does not depend on their order."""
    total = tx.mix(elements + np.uint64(0x51)).sum(dtype=np.uint64)
    return int(tx.mix(np.array([total + np.uint64(len(elements))], np.uint64)).view(np.int64)[0])


def _parity(elements: np.ndarray) -> list[int]:
    """A bit per slot: whether an odd number of elements falls into it."""
    slots = np.bincount((tx.mix(elements) % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(slots.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def _fine_parity(elements: np.ndarray) -> bytes:
    """The same with two slots or more per element, a power of two, so that any two sketches can be folded alike."""
    slots = max(64, 1 << (2 * len(elements) - 1).bit_length()) if len(elements) else 64
    odd = np.bincount((tx.mix(elements) % np.uint64(slots)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _fold(sketch: np.ndarray, size: int) -> np.ndarray:
    while len(sketch) > size:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def _ordered(elements: np.ndarray, load: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """Elements in the global order, with their loads."""
    loads = load[(elements % np.uint64(len(load))).astype(np.int64)]
    level = np.where(loads > FREQUENT * mean, np.log2(np.maximum(loads, 1)).astype(np.int64), 0)
    order = np.lexsort((elements, level))
    return elements[order], loads[order]


def _frequencies(docs: DataFrame, rule: Rule) -> np.ndarray:
    def run(batches):
        table = np.zeros(tables.SLOTS, np.int64)
        for batch in batches:
            for _, data, offsets in tx.pieces(batch, "text"):
                for elements in text_sets(data, offsets, rule.words):
                    np.add.at(table, (elements % np.uint64(tables.SLOTS)).astype(np.int64), 1)
        yield from tables.as_chunks(table)

    return tables.added_up(docs.select("text").mapInArrow(releasing(run), tables.SHAPE))


def _sets(docs: DataFrame, rule: Rule, load) -> DataFrame:
    """``doc_id, k1, k2, cls, n, scan, parity, fine`` per row; ``scan`` is the load of its prefix."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, k1 bigint, k2 bigint, cls bigint, n bigint, scan bigint, parity array<bigint>, fine binary"

    def run(batches):
        table = load.value
        mean = max(1.0, float(table.mean()))
        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text"):
                found = []
                for s in text_sets(data, offsets, rule.words):
                    scan = 0
                    if 0 < len(s) <= LIGHT_MOST:
                        scan = int(_ordered(s, table, mean)[1][: rule.prefix(len(s))].sum())
                    found.append((_class_of(s), len(s), scan, _parity(s), _fine_parity(s)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), *(pa.array([f[i] for f in found], pa.int64()) for i in range(3)),
                     pa.array([f[3] for f in found], pa.list_(pa.int64())), pa.array([f[4] for f in found], pa.binary())],
                    names=["doc_id", "k1", "k2", "cls", "n", "scan", "parity", "fine"],
                )

    return stored(docs.mapInArrow(releasing(run), shape), "sets")


def light_boundary(sizes: list[tuple[int, int, int]], rule: Rule) -> int:
    """The boundary of least cost, from ``size, sets, list entries scanned`` of the small sizes.

    Light sizes cost their subsets, heavy ones the entries scanned; light sizes near the boundary also
    enter the lists, for their heavy partners.
    """
    def cost(x: int) -> int:
        near = rule.smallest(x + 1)
        return sum(
            n * rule.subsets(s) + (n * rule.prefix(s) if s >= near else 0) if s <= x else scan for s, n, scan in sizes
        )

    return min(range(LIGHT_MOST + 1), key=lambda x: (cost(x), x))


def _postings(docs: DataFrame, rule: Rule, load, boundary: int) -> DataFrame:
    """``light, element, cls, n, pos``: subsets of light sets, prefix elements of the others.

    For a subset ``pos`` is its size. A class comes once per task.
    """
    near = rule.smallest(boundary + 1)
    shape = "light boolean, element bigint, cls bigint, n int, pos int"

    def subsets(elements: np.ndarray):
        n, parts = len(elements), []
        for c in sorted(rule.subset_sizes(n)):
            if n < 2:
                continue
            hashes = tx.mix(elements + np.uint64(0x77))
            left_out = np.array(list(combinations(range(n), n - c)), np.int64).reshape(comb(n, c), n - c)
            sums = hashes.sum(dtype=np.uint64) - hashes[left_out].sum(axis=1, dtype=np.uint64)
            parts.append((tx.mix(sums + np.uint64(c)), np.full(len(sums), c)))
        return parts

    def run(batches):
        table, seen = load.value, set()
        mean = max(1.0, float(table.mean()))
        for batch in batches:
            for _, data, offsets in tx.pieces(batch, "text"):
                out = []
                for s in text_sets(data, offsets, rule.words):
                    cls = _class_of(s)
                    if not len(s) or cls in seen:
                        continue
                    seen.add(cls)
                    if len(s) <= boundary:
                        out += [(True, e, cls, len(s), c) for e, c in subsets(s)]
                    if len(s) >= near:
                        first = _ordered(s, table, mean)[0][: rule.prefix(len(s))]
                        out.append((False, first, cls, len(s), np.arange(len(first))))
                if not out:
                    continue
                sizes = np.array([len(o[1]) for o in out])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([o[0] for o in out], sizes)), pa.array(tx.signed(np.concatenate([o[1] for o in out]))),
                     pa.array(np.repeat(np.array([o[2] for o in out], np.int64), sizes)),
                     pa.array(np.repeat(np.array([o[3] for o in out], np.int32), sizes)),
                     pa.array(np.concatenate([o[4] for o in out]).astype(np.int32))],
                    names=["light", "element", "cls", "n", "pos"],
                )

    return stored(docs.select("text").mapInArrow(releasing(run), shape), "postings")


def _overlap(rule: Rule, s: Column, t: Column) -> Column:
    return F.ceil(F.lit(rule.percent) * (s + t) / F.lit(100 + rule.percent))


def _near_size(rule: Rule, s: Column, t: Column) -> Column:
    return (F.lit(100) * s >= F.lit(rule.percent) * t) & (F.lit(100) * t >= F.lit(rule.percent) * s)


def _may_link(rule: Rule, a: str, b: str) -> Column:
    """False only where the parity sketches prove that the sets differ by too much."""
    differ = sum((F.bit_count(F.col(f"{a}.parity")[i].bitwiseXOR(F.col(f"{b}.parity")[i])) for i in range(PARITY_WORDS)), F.lit(0))
    s, t = F.col(f"{a}.n"), F.col(f"{b}.n")
    return differ <= s + t - 2 * _overlap(rule, s, t)


def _light_links(postings: DataFrame, rule: Rule) -> DataFrame:
    subsets = postings.where("light")
    hubs = subsets.groupBy("element").agg(F.min(F.struct("n", "cls")).alias("hub"), F.max(F.struct("n", "cls")).alias("top")).where("hub.cls <> top.cls")
    pairs = subsets.join(hubs.select("element", "hub"), "element").where("cls <> hub.cls")
    enough = F.lit(100 + rule.percent) * F.col("pos") >= F.lit(rule.percent) * (F.col("n") + F.col("hub.n"))
    return pairs.where(enough).select(F.col("cls").alias("a"), F.col("hub.cls").alias("b")).distinct()


def _finely(pairs: DataFrame, sketch: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a, b`` that the fine sketches do not rule out either."""
    left = sketch.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("fine").alias("left"))
    right = sketch.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("fine").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "left", "right")

    def run(batches):
        for batch in batches:
            s, t = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            allowed = s + t - 2 * -(-rule.percent * (s + t) // (100 + rule.percent))
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint8) for k in (4, 5))
                size = min(len(x), len(y))
                keep[i] = int(np.bitwise_count(_fold(x, size) ^ _fold(y, size)).sum()) <= allowed[i]
            yield batch.select([0, 1]).filter(pa.array(keep))

    return joined.mapInArrow(releasing(run), "a bigint, b bigint")


def _verified(pairs: DataFrame, docs: DataFrame, sketch: DataFrame, rule: Rule) -> DataFrame:
    """``a, b, overlap, n_a, n_b`` of the class pairs that link, checked on the whole sets.

    The sets are computed again from the texts for the classes a fixed-size filter lets through.
    """
    pairs = stored(_finely(pairs, sketch, rule), "pairs")
    if pairs.isEmpty():
        return pairs.select("a", "b", *[F.lit(0).alias(c) for c in ("overlap", "n_a", "n_b")])
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select("b"))
    wanted = docs.sparkSession.sparkContext.broadcast(tables.occupied(ends))

    def run(batches):
        seen, keep = set(), wanted.value
        for batch in batches:
            for _, data, offsets in tx.pieces(batch, "text"):
                out = []
                for s in text_sets(data, offsets, rule.words):
                    cls = _class_of(s)
                    if len(s) and keep[(cls % 2**64) % len(keep)] and cls not in seen:
                        seen.add(cls)
                        out.append((cls, s.tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["cls", "elements"])

    whole = docs.select("text").mapInArrow(releasing(run), "cls bigint, elements binary")
    whole = stored(whole.join(ends.distinct(), "cls", "left_semi").groupBy("cls").agg(F.first("elements").alias("elements")), "whole-sets")
    first = whole.select(F.col("cls").alias("a"), F.col("elements").alias("left"))
    second = whole.select(F.col("cls").alias("b"), F.col("elements").alias("right"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "left", "right")

    def check(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            rows = []
            for i in range(batch.num_rows):
                x, y = np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64)
                rows.append((len(x) + len(y) - len(np.union1d(x, y)), len(x), len(y)))
            numbers = np.array(rows, np.int32).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(numbers[:, i]) for i in range(3))], names=["a", "b", "overlap", "n_a", "n_b"])

    counted = joined.mapInArrow(releasing(check), "a bigint, b bigint, overlap int, n_a int, n_b int")
    enough = F.lit(100 + rule.percent) * F.col("overlap") >= F.lit(rule.percent) * (F.col("n_a") + F.col("n_b"))
    return stored(counted.where(enough), "links", pairs, whole)


class Join(NamedTuple):
    """Rows with their class, and links between classes."""

    sets: DataFrame  # doc_id, k1, k2, cls, n
    links: DataFrame  # a, b


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, k1, k2, text``: the keys tell texts apart."""
    content = F.col(f"`{text}`")
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(content).alias("k1"), F.xxhash64(F.lit(1), content).alias("k2"), content.alias("text"))


def jaccard_join(docs: DataFrame, rule: Rule = Rule(), *, doc_id="doc_id", text="text", every_link: bool = False) -> Join:
    """Classes of equal sets and the links between them.

    By default the links hold each component together and pairs inside a component already found are
    not looked at again; with ``every_link`` they are all pairs of linked classes.
    """
    named = _named(docs, doc_id, text)
    context = docs.sparkSession.sparkContext
    load = context.broadcast(_frequencies(named, rule))
    sets = _sets(named, rule, load)
    small = sets.where(F.col("n").between(1, LIGHT_MOST)).groupBy("n").agg(F.count(F.lit(1)), F.sum("scan"))
    boundary = 0 if every_link else light_boundary([tuple(r) for r in small.collect()], rule)
    postings = _postings(named, rule, load, boundary)

    heavy = postings.where("NOT light")
    shared = heavy.groupBy("element").agg(F.min("cls").alias("low"), F.max("cls").alias("high"), F.count(F.lit(1)).alias("entries"))
    shared = shared.where("low <> high").select("element", "entries")
    lists = stored(heavy.join(shared, "element").select("element", "cls", "n", "pos", "entries").distinct(), "lists")
    light = stored(_light_links(postings, rule), "light-links", postings)
    sketch = sets.groupBy("cls").agg(F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("fine").alias("fine")).join(lists.select("cls").distinct(), "cls", "left_semi")
    sketch = stored(sketch, "sketches")
    both_light = lambda s, t: (s <= boundary) & (t <= boundary)

    def kept(pairs: DataFrame) -> DataFrame:
        """Pairs of classes that their sketches do not rule out."""
        a, b = sketch.alias("a"), sketch.alias("b")
        joined = pairs.join(a, F.col("left") == F.col("a.cls")).join(b, (F.col("right") == F.col("b.cls")) & _may_link(rule, "a", "b"))
        return joined.select(F.col("left").alias("a"), F.col("right").alias("b"))

    links = light
    if not every_link:
        # The most central set of a list: the one whose prefix is shared most widely.
        central = lists.groupBy("cls").agg((F.sum(F.log("entries")) / F.first("n")).alias("r"))
        hubs = lists.join(central, "cls").groupBy("element").agg(F.max(F.struct("r", "cls", "n")).alias("hub")).select("element", "hub.cls", "hub.n")
        x, h = lists.alias("x"), hubs.alias("h")
        near = (F.col("x.element") == F.col("h.element")) & (F.col("x.cls") != F.col("h.cls")) & _near_size(rule, F.col("x.n"), F.col("h.n"))
        star = x.join(h, near & ~both_light(F.col("x.n"), F.col("h.n")))
        ends = (F.col("x.cls"), F.col("h.cls"))
        # Each class is checked against the one it meets in most lists; round two sees to the rest.
        met = star.select(ends[0].alias("cls"), ends[1].alias("other")).groupBy("cls", "other").agg(F.count(F.lit(1)).alias("lists"))
        best = met.groupBy("cls").agg(F.max(F.struct("lists", "other"))["other"].alias("other"))
        star = best.select(F.least("cls", "other").alias("left"), F.greatest("cls", "other").alias("right")).distinct()
        links = stored(links.unionByName(_verified(kept(star), named, sketch, rule).select("a", "b")), "links")
        parts = components(links)
        labelled = lists.join(parts.withColumnRenamed("node", "cls"), "cls", "left").withColumn("part", F.coalesce("root", "cls")).drop("root")
        open_ = labelled.groupBy("element").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("element")
        open_lists = labelled.join(open_, "element")
    else:
        open_lists = lists.withColumn("part", F.col("cls"))
    rows = stored(open_lists.select("element", "cls", "part", "pos").join(sketch.drop("fine"), "cls"), "open-lists")
    x, y = rows.alias("x"), rows.alias("y")
    rest = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    near = (
        (F.col("x.element") == F.col("y.element")) & (F.col("x.cls") < F.col("y.cls")) & (F.col("x.part") != F.col("y.part"))
        & _near_size(rule, F.col("x.n"), F.col("y.n")) & ~both_light(F.col("x.n"), F.col("y.n"))
        & (rest >= _overlap(rule, F.col("x.n"), F.col("y.n"))) & _may_link(rule, "x", "y")
    )
    pairs = x.join(y, near).select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct()
    more = _verified(pairs, named, sketch, rule).select("a", "b")
    links = stored(links.unionByName(more), "links", lists, rows, sketch)
    return Join(sets, links)


def _members(join: Join) -> DataFrame:
    """The rows of ``sets`` with ``first``, the smallest ``doc_id, k1, k2`` of their component."""
    parts = components(join.links).select(F.col("node").alias("cls"), "root")
    name = F.struct("doc_id", "k1", "k2")
    classes = join.sets.where("n > 0").groupBy("cls").agg(F.min(name).alias("first"))
    labelled = stored(classes.join(parts, "cls", "left").select("cls", "first", F.coalesce("root", "cls").alias("root")), "classes")
    firsts = labelled.groupBy("root").agg(F.min("first").alias("first"))
    by_class = labelled.select("cls", "root").join(firsts, "root").select("cls", "first")
    rows = join.sets.select("doc_id", "k1", "k2", "cls", "n")
    filled = rows.where("n > 0").join(by_class, "cls").select("doc_id", "k1", "k2", "n", "first")
    return filled.unionByName(rows.where("n = 0").select("doc_id", "k1", "k2", "n", name.alias("first")))


def jaccard_components(docs: DataFrame, rule: Rule = Rule(), *, doc_id="doc_id", text="text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row; a component is named by its smallest id."""
    rows = _members(jaccard_join(docs, rule, doc_id=doc_id, text=text))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"))


def keep_one_per_component(docs: DataFrame, rule: Rule = Rule(), *, doc_id="doc_id", text="text") -> DataFrame:
    """The document of smallest id of each component, with all its columns; empty sets all stay.

    Rows equal in id and text count as one document, unless their set is empty.
    """
    rows = _members(jaccard_join(docs, rule, doc_id=doc_id, text=text))
    first = F.struct("doc_id", "k1", "k2") == F.col("first")
    kept = rows.where((F.col("n") == 0) | first).groupBy("doc_id", "k1", "k2").agg(F.max("n").alias("n"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select("row", *_named_columns(doc_id, text))
    keyed = whole.join(kept.select(F.col("doc_id").alias("_id"), F.col("k1").alias("_1"), F.col("k2").alias("_2"), "n"),
                       F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("k1") == F.col("_1")) & (F.col("k2") == F.col("_2")))
    # Repeated rows follow each other in one task: the join has put equal keys together.
    one = keyed.where("n > 0").groupBy("_id", "_1", "_2").agg(F.first("row").alias("row"))
    return one.select("row").unionByName(keyed.where("n = 0").select("row")).select("row.*")


def _named_columns(doc_id: str, text: str) -> list[Column]:
    content = F.col(f"row.`{text}`")
    return [F.col(f"row.`{doc_id}`").alias("doc_id"), F.xxhash64(content).alias("k1"), F.xxhash64(F.lit(1), content).alias("k2")]
