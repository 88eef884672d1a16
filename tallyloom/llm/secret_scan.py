"""Secret scans over a trigram inverted index, with DataFrame functions only.

Every rule's regular expression is read for the text any match must contain; that gives a Boolean query over
trigrams: an OR of alternatives, each an AND of trigrams. The index holds a posting ``trigram, document`` for the
trigrams the rules ask for, written for small letters. Postings of one alternative are intersected by counting
them per document; a document that satisfies a rule's query is a candidate, and only candidates are
matched against that rule's expression. Rules without a mandatory trigram scan every document.

Postings are rows, never lists, so a trigram that occurs in a third of all documents is spread like any other
rows; they are counted per document, which holds at most one posting per queried trigram.

Positions come from the pieces between matches: a match starts after the lengths of all pieces and matches
before it, counted in code points.

Defined cases: a null text is empty and has no spans; texts are told apart by a content key, so rows with equal
text, repeated or null ids get a row each; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import product
from re import _parser as sre
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.scratch import written

MOST_ALTERNATIVES = 32
# Literal forms followed at once while reading an expression; beyond it that part counts as unknown.
MOST_FORMS = 64


class Rule(NamedTuple):
    """One kind of secret: an expression, the group that is measured and its least length."""

    kind: str
    expression: str
    least: int = 0
    group: int = 0
    any_case: bool = False


# The three base kinds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
# Public formats of further keys.
FURTHER = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", r"(sk|rk)_live_[A-Za-z0-9]+", 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + FURTHER


def _forms(parsed) -> list[set[str] | None]:
    """A parsed expression as a run of parts: the strings a part can be, or None where unknown."""
    run: list[set[str] | None] = []
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            run.append({chr(value)})
        elif name == "IN":
            members, plain = set(), True
            for kind, member in value:
                if str(kind) == "LITERAL":
                    members.add(chr(member))
                elif str(kind) == "RANGE" and member[1] - member[0] < 8:
                    members |= {chr(c) for c in range(member[0], member[1] + 1)}
                else:
                    plain = False
            run.append(members if plain and len(members) <= 8 else None)
        elif name == "SUBPATTERN":
            run += _forms(value[-1])
        elif name == "BRANCH":
            strings = [_strings(_forms(branch)) for branch in value[1]]
            run.append(set().union(*strings) if all(s is not None for s in strings) else None)
        elif name == "MAX_REPEAT" and value[1] == 1:
            inner = _strings(_forms(value[2]))
            run.append(None if inner is None else inner | {""} if value[0] == 0 else inner)
        elif name == "MAX_REPEAT" and value[0] >= 1:
            run += [*_forms(value[2]), None]
        else:
            run.append(None)
    return run


def _strings(run: list[set[str] | None]) -> set[str] | None:
    """All strings of a run without unknown parts."""
    if any(part is None for part in run):
        return None
    found = {"".join(parts) for parts in product(*run)}
    return found if len(found) <= MOST_FORMS else None


def trigram_query(expression: str) -> list[frozenset[str]] | None:
    """Alternatives of trigrams, small letters, one of which every match contains; None if there is none.

    The stretch of known text that gives the most trigrams is used.
    """
    stretches: list[list[set[str]]] = [[]]
    for part in _forms(sre.parse(expression)):
        if part is None:
            stretches.append([])
        else:
            stretches[-1].append(part)
    best: list[frozenset[str]] | None = None
    for stretch in stretches:
        strings = _strings(stretch)
        if not strings or len(strings) > MOST_ALTERNATIVES:
            continue
        grams = {frozenset(s.lower()[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        grams = {g for g in grams if not any(other < g for other in grams)}
        if all(grams) and (best is None or min(map(len, grams)) > min(map(len, best))):
            best = sorted(grams, key=sorted)
    return best


def _keyed(docs: DataFrame, text: str) -> list[Column]:
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return [content.alias("text"), F.xxhash64(content).alias("k1"), F.xxhash64(F.lit(1), content).alias("k2")]


def trigram_postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram, k1, k2``: the inverted index, for the trigrams asked for."""
    # The lambda binds the lowered text once for all trigrams; lowering may only add candidates.
    asked = F.array(*[F.lit(t) for t in trigrams])
    found = F.transform(F.array(F.lower("text")), lambda low: F.filter(asked, lambda t: F.contains(low, t)))[0]
    hits = texts.select("k1", "k2", found.alias("found"))
    return hits.select("k1", "k2", F.explode("found").alias("trigram")).distinct()


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame | None:
    """``k1, k2, kinds``: per text the indexed rules whose trigram query it satisfies."""
    queries = [(rule.kind, n, gram, len(grams)) for rule in rules for n, grams in enumerate(trigram_query(rule.expression) or []) for gram in sorted(grams)]
    if not queries:
        return None
    spark = texts.sparkSession
    asked = spark.createDataFrame(queries, "kind string, alternative int, trigram string, needed int")
    postings = trigram_postings(texts, sorted({q[2] for q in queries}))
    counted = postings.join(asked, "trigram").groupBy("k1", "k2", "kind", "alternative").agg(F.count(F.lit(1)).alias("n"), F.first("needed").alias("needed"))
    return counted.where("n = needed").groupBy("k1", "k2").agg(F.collect_set("kind").alias("kinds"))


def rule_spans(text: Column, rule: Rule) -> Column:
    """Spans ``start, stop`` of a rule's matches, leftmost and non-overlapping, the short ones dropped."""
    expression = ("(?i)" if rule.any_case else "") + rule.expression
    pieces = F.transform(F.split(text, expression, -1), lambda p: F.char_length(p))
    matches = F.transform(F.regexp_extract_all(text, F.lit(expression), F.lit(0)), lambda m: F.char_length(m))
    measured = matches
    if rule.group:
        measured = F.transform(F.regexp_extract_all(text, F.lit(expression), F.lit(rule.group)), lambda m: F.char_length(m))
    nothing = F.array().cast("array<struct<start:int,stop:int,length:int>>")
    joined = F.arrays_zip(pieces.alias("gap"), matches.alias("size"), measured.alias("length"))
    walked = F.aggregate(
        F.slice(joined, F.lit(1), F.greatest(F.size(matches), F.lit(0))),
        F.struct(F.lit(0).alias("at"), nothing.alias("spans")),
        lambda s, m: F.struct(
            (s["at"] + m["gap"] + m["size"]).alias("at"),
            F.concat(s["spans"], F.array(F.struct((s["at"] + m["gap"]).alias("start"), (s["at"] + m["gap"] + m["size"]).alias("stop"), m["length"].alias("length")))).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return F.filter(walked, lambda s: s["length"] >= rule.least)


def _possible(rule: Rule) -> str:
    """An expression for a first look: a lone run of characters is only looked for at its least length."""
    lone = rule.expression[0] == "[" and rule.expression.index("]") == len(rule.expression) - 2
    return f"{rule.expression[:-1]}{{{rule.least},}}" if lone and rule.expression[-1] == "+" else rule.expression


def _naming(kind: str, number: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("number"), s["stop"].alias("stop"), F.lit(kind).alias("kind"))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, doc_id="doc_id", text="text") -> DataFrame:
    """``doc_id, spans`` per row; ``spans`` holds ``kind, number, start, stop`` in order of start, then rule."""
    keyed = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), *_keyed(docs, text))
    indexed = candidates(keyed, rules)
    if indexed is None:
        joined = keyed.withColumn("kinds", F.lit(None).cast("array<string>"))
    else:
        joined = keyed.join(written(indexed, "secret-candidates"), ["k1", "k2"], "left")
    columns = []
    for number, rule in enumerate(rules):
        possible = F.col("text").rlike(_possible(rule))
        if trigram_query(rule.expression) is not None:
            possible = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        named = F.transform(rule_spans(F.col("text"), rule), _naming(rule.kind, number))
        none = F.array().cast("array<struct<start:int,number:int,stop:int,kind:string>>")
        columns.append(F.when(possible, named).otherwise(none))
    return joined.select("doc_id", F.array_sort(F.concat(*columns)).alias("spans"))


def span_list(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_digest(found: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, the digest of base spans, and all spans as text."""
    kinds = [rule.kind for rule in BASE]
    named = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(named, k))).cast("bigint").alias(f"n_{k}") for k in kinds]
    base = F.filter("spans", lambda s: s["number"] < len(BASE))
    return found.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))
