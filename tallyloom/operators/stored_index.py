"""An inverted index kept as a table bucketed and sorted by term.

A lookup of some terms opens only the files of their buckets and, in them, only the row groups whose terms match; a ranking
reads the number of articles of each block of postings and never the postings. Blocks of one term are spread over the tasks
that write, so a frequent term has several files in its bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.tokens import check_vocabulary
from tallyloom.operators.terms import block_number, vocabulary_frame
from tallyloom.scratch import discard, new_path, written

BUCKETS = 64
# Mentions that one task groups, about, and frequent terms that every task may hold.
SLICE_MENTIONS = 1_000_000
BROADCAST_TERMS = 1_000_000


class StoredIndex(NamedTuple):
    """Where an index lies, and the catalog's name for it."""

    path: str
    buckets: int
    table: str

    def read(self, spark: SparkSession) -> DataFrame:
        """``term, block, articles, entries``."""
        return spark.table(self.table)


def _frequent(mentions: DataFrame, block_titles: int) -> tuple[DataFrame, int]:
    """``term, blocks`` of the terms with more than one block, written down, and the number of all mentions."""
    counting = Observation()
    counted = mentions.groupBy("term").agg(F.count(F.lit(1)).alias("n")).observe(counting, F.sum("n").alias("total"))
    blocks = F.ceil(F.col("n") / F.lit(block_titles)).cast("bigint").alias("blocks")
    frequent = written(counted.where(F.col("n") > block_titles).select("term", blocks), "frequent-terms")
    return frequent, counting.get["total"] or 0


def _dealt_blocks(mentions: DataFrame, frequent: DataFrame, total: int, buckets: int) -> DataFrame:
    """``term, block, articles, entries``; a task has the blocks of few buckets and so writes few files.

    Mentions are shuffled once, to where their block is written: a part is a slice of a bucket. There they are
    ordered, and grouped as they pass. Counting copies in the tasks that read would only fill their memory, as nearly
    all mentions differ.
    """
    spark = mentions.sparkSession
    slices = 1 + total // (buckets * SLICE_MENTIONS)
    known = F.broadcast(frequent) if frequent.count() <= BROADCAST_TERMS else frequent
    block = block_number(F.col("title"), F.coalesce("blocks", F.lit(1).cast("bigint"))).alias("block")
    numbered = mentions.join(known, "term", "left").select("term", block, "title")
    part = F.pmod(F.hash("term"), F.lit(buckets * slices))
    tasks = total // SLICE_MENTIONS
    # A given number would keep the optimiser from putting small parts together.
    many = tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = numbered.repartition(tasks, part, "block") if many else numbered.repartition(part, "block")
    # The hash, a column and so computed once a row, settles most comparisons without a look at the strings.
    marked = dealt.withColumn("mark", F.xxhash64("term", "block"))
    ordered = marked.sortWithinPartitions("mark", "term", "block", "title").select("term", "block", "title")
    return ordered.mapInArrow(_grouping(), "term string, block bigint, articles bigint, entries array<struct<title: string, copies: bigint>>")


def _grouping():
    """Rows ordered by block, term and title as a row per block. Holds a batch of rows and one block's different titles."""

    # Nested, so that workers get it by value and need no copy of this package.
    def group(batches):
        def begins(table, *names):
            """Places of the rows that differ from the one before in one of the columns."""
            new = np.zeros(table.num_rows, dtype=bool)
            new[:1] = True
            for name in names:
                column = table[name].combine_chunks()
                here, before = column[1:], column[:-1]
                differ = pc.fill_null(pc.not_equal(here, before), False)
                new[1:] |= pc.or_(differ, pc.xor(pc.is_null(here), pc.is_null(before))).to_numpy(zero_copy_only=False)
            return np.flatnonzero(new)

        def blocks(table, at):
            copies = table["copies"].to_numpy()
            entries = pa.StructArray.from_arrays([table["title"].combine_chunks(), table["copies"].combine_chunks()], ["title", "copies"])
            lists = pa.ListArray.from_arrays(np.append(at, table.num_rows).astype(np.int32), entries)
            first = table.select(["term", "block"]).take(at).combine_chunks()
            columns = [first["term"], first["block"], pa.array(np.add.reduceat(copies, at)), lists]
            return pa.Table.from_arrays(columns, ["term", "block", "articles", "entries"]).to_batches()

        left = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).append_column("copies", pa.array(np.ones(batch.num_rows, dtype=np.int64)))
            table = table if left is None else pa.concat_tables([left, table])
            titles = begins(table, "block", "term", "title")
            copies = pa.array(np.add.reduceat(table["copies"].to_numpy(), titles))
            table = table.select(["term", "block", "title"]).take(titles).append_column("copies", copies)
            at = begins(table, "block", "term")
            # The last block may go on in the next batch.
            left = table.slice(at[-1]).combine_chunks()
            if len(at) > 1:
                yield from blocks(table.slice(0, at[-1]).combine_chunks(), at[:-1])
        if left is not None:
            yield from blocks(left, np.zeros(1, dtype=np.int64))

    return group


def write_index(
    index: DataFrame, *, title: str = "title", buckets: int = BUCKETS, block_titles: int = 10_000, path: str | None = None
) -> StoredIndex:
    """Writes a flat index (``term`` and a title, a row per mention) to ``path``, by default in the shared folder.

    A term has a block per ``block_titles`` mentions. The index is read twice, the first time only its terms.
    """
    mentions = index.select("term", F.col(title).alias("title")).where("term IS NOT NULL")
    frequent, total = _frequent(mentions, block_titles)
    stored = StoredIndex(path or new_path(index.sparkSession, "term-index"), buckets, f"term_index_{uuid4().hex}")
    blocks = _dealt_blocks(mentions, frequent, total, buckets)
    blocks.write.format("parquet").bucketBy(buckets, "term").sortBy("term", "block").option("path", stored.path).saveAsTable(stored.table)
    discard(frequent)
    return stored


def open_index(spark: SparkSession, path: str, buckets: int) -> StoredIndex:
    """Names an index written earlier, by any session; ``buckets`` is what it was written with."""
    stored = StoredIndex(path, buckets, f"term_index_{uuid4().hex}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(
        f"CREATE TABLE {stored.table} ({columns}) USING parquet "
        f"CLUSTERED BY (term) SORTED BY (term, block) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return stored


def lookup(spark: SparkSession, index: StoredIndex, terms: Sequence[str]) -> DataFrame:
    """``term, title, copies``: the articles that mention each of the terms."""
    found = index.read(spark).where(F.col("term").isin(check_vocabulary(terms)))
    return found.select("term", F.inline("entries")).select("term", "title", "copies")


def rank_stored(spark: SparkSession, index: StoredIndex, vocabulary: Sequence[str]) -> DataFrame:
    """``term, n``: mentioned terms by number of articles, ties in vocabulary order."""
    found = index.read(spark).where(F.col("term").isin(check_vocabulary(vocabulary)))
    counts = found.groupBy("term").agg(F.sum("articles").alias("n"))
    known = vocabulary_frame(spark, vocabulary)
    return known.join(counts, "term").orderBy(F.desc("n"), "position").select("term", "n")
