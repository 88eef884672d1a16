"""Token ids as fixed-width binary files.

Texts are dealt by ranges of ``doc_id`` and encoded in ascending order, files of a bounded size per range. A file holds
its ids packed in the fewest bits that hold the vocabulary, in blocks of ``BLOCK`` ids that start at
byte boundaries, then a footer: the byte offset of every block, and the ids and first token of every
document. Any run of ids is read by reading its blocks only.

Layout, little-endian: blocks | block offsets u64 | document ids i64 | null flags u8 | document starts
u64 (one more than documents) | n_blocks u64, n_docs u64, n_ids u64, block u32, bits u32 | magic 8 bytes.

Defined cases: a null or empty text has the end id only; null ids come first; rows with equal ids follow
each other by their text and keep a row each; an empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm import parts, storage
from tallyloom.llm import text as tx
from tallyloom.llm.workers import releasing
from tallyloom.scratch import new_path, written

BLOCK = 1 << 16
MAGIC = b"TOKBITS1"
TAIL = struct.Struct("<QQQII8s")
# Documents' bytes encoded at once, ids after which a file is closed, and rows given back at once.
ENCODE_BYTES = 4 << 20
FILE_IDS = 1 << 26
READ_ROWS = 1 << 16
# Parts a worker keeps the ids of.
KEPT_PARTS = 700_000


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Each id in ``bits`` bits, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids[:, None] >> np.arange(bits, dtype=ids.dtype)) & ids.dtype.type(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, n: int, bits: int) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8)
    if bits in (8, 16, 32):
        return raw.view(f"<u{bits // 8}")[:n].astype(np.uint32)
    spread = np.unpackbits(raw, count=n * bits, bitorder="little").reshape(n, bits)
    return (spread.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class TokenWriter:
    def __init__(self, stream, bits: int, block: int = BLOCK):
        self.stream, self.bits, self.block = stream, bits, block
        # Ids, null flags and ends of documents come as arrays, one per call.
        self.offsets, self.docs, self.nulls, self.ends = [], [], [], [np.zeros(1, np.int64)]
        self.at, self.n, self.n_docs, self.rest = 0, 0, 0, np.zeros(0, np.uint32)

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def _blocks(self, ids: np.ndarray, last: bool) -> np.ndarray:
        upto = len(ids) if last else len(ids) - len(ids) % self.block
        for start in range(0, upto, self.block):
            self.offsets.append(self.at)
            self._write(pack(ids[start : min(start + self.block, upto)], self.bits))
        return ids[upto:]

    def add(self, docs: pa.Array | list, ids: np.ndarray, counts: np.ndarray) -> None:
        """Documents with their ids one after the other."""
        docs = docs if isinstance(docs, pa.Array) else pa.array(docs, pa.int64())
        self.docs.append(docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.nulls.append(docs.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
        self.ends.append(self.n + np.cumsum(counts))
        self.n += len(ids)
        self.n_docs += len(docs)
        self.rest = self._blocks(np.concatenate((self.rest, ids.astype(np.uint32))), False)

    def close(self) -> None:
        self._blocks(self.rest, True)
        self._write(np.array(self.offsets, "<u8").tobytes())
        for column in (self.docs, self.nulls, self.ends):
            for values in column:
                self._write(values.tobytes())
        self._write(TAIL.pack(len(self.offsets), self.n_docs, self.n, self.block, self.bits, MAGIC))
        self.stream.close()


class TokenFile:
    """Random access to the ids and documents of one file."""

    def __init__(self, handle):
        self.handle = handle
        size = handle.size()
        blocks, docs, self.n_ids, self.block, self.bits, magic = TAIL.unpack(
            storage.read_range(handle, size - TAIL.size, TAIL.size)
        )
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        footer = 8 * blocks + 8 * docs + docs + 8 * (docs + 1)
        self.data_end = size - TAIL.size - footer
        raw = storage.read_range(handle, self.data_end, footer)
        self.offsets = np.append(np.frombuffer(raw, "<u8", blocks), np.uint64(self.data_end)).astype(np.int64)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, 8 * blocks)
        self.nulls = np.frombuffer(raw, np.uint8, docs, 8 * (blocks + docs)).astype(bool)
        self.starts = np.frombuffer(raw, "<u8", docs + 1, 8 * (blocks + docs) + docs).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to before ``stop``."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        low = int(self.offsets[first])
        raw = storage.read_range(self.handle, low, int(self.offsets[last + 1]) - low)
        parts = []
        for b in range(first, last + 1):
            n = min(self.block, self.n_ids - b * self.block)
            parts.append(unpack(raw[self.offsets[b] - low : self.offsets[b + 1] - low], n, self.bits))
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.starts[number + 1]))

    def documents(self, budget: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """Every document's number and ids, from reads of about ``budget`` ids."""
        n, first = len(self.doc_ids), 0
        while first < n:
            last = int(np.searchsorted(self.starts, self.starts[first] + budget, side="right")) - 1
            last = min(n, max(last, first + 1))
            base = int(self.starts[first])
            ids = self.ids(base, int(self.starts[last]))
            for d in range(first, last):
                yield d, ids[self.starts[d] - base : self.starts[d + 1] - base]
            first = last


class Encoder:
    """Ids of whole texts, by the parts between spaces where the tokenizer allows it."""

    def __init__(self, path: str, kept: int = KEPT_PARTS):
        self.tokenizer = parts.JsonTokenizer(path)
        self.vocabulary = self.tokenizer.vocabulary
        self.by_parts = parts.PartEncoder([self.tokenizer.whole], [self.tokenizer.parts], first_spaced=False, most_parts=kept) if self.tokenizer.by_parts else None

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as UTF-8 bytes and offsets, one after the other, and how many each has."""
        if self.by_parts is not None:
            return self.by_parts(data, offsets)[0]
        found = [np.array(i, np.int32) for i in self.tokenizer.whole(parts.as_strings(data, offsets).to_pylist())]
        return np.concatenate([np.zeros(0, np.int32), *found]), np.array([len(i) for i in found], np.int64)

    def ended(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same with ``end_id`` after every text."""
        ids, counts = self(data, offsets)
        stops = np.cumsum(counts + 1)
        out = np.full(stops[-1] if len(stops) else 0, end_id, np.int32)
        inner = np.ones(len(out), bool)
        inner[stops - 1] = False
        out[inner] = ids
        return out, counts + 1


_encoders: dict[tuple[str, int], Encoder] = {}


def _encoder(path: str, kept: int) -> Encoder:
    if (path, kept) not in _encoders:
        _encoders[path, kept] = Encoder(path, kept)
    return _encoders[path, kept]


FILE = "part int, number int, path string, n_docs bigint, n_ids bigint"
_FILE = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int, *, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, file_ids: int = FILE_IDS,
    kept: int = KEPT_PARTS, encode_bytes: int | None = None,
) -> DataFrame:
    """Writes the files and returns their list: ``part, number, path, n_docs, n_ids``, in id order by part, then number.

    ``tokenizer`` names a tokenizers file that every executor has at that place; its path is only read. Workers keep the ids
    of ``kept`` parts, also after the job, and encode ``encode_bytes`` of text at once, ``ENCODE_BYTES`` by default.
    """
    spark = docs.sparkSession
    folder = new_path(spark, "tokens")
    at_once = ENCODE_BYTES if encode_bytes is None else encode_bytes
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # The text's hash parts the copies of one id, should it hold many rows.
    dealt = chosen.repartitionByRange(partitions, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def run(batches):
        encoder, writer, uri, number = _encoder(tokenizer, kept), None, None, 0

        def closed():
            writer.close()
            row = {"part": TaskContext.get().partitionId(), "number": number, "path": uri, "n_docs": writer.n_docs, "n_ids": writer.n}
            return pa.RecordBatch.from_pylist([row], _FILE)

        for batch in batches:
            for rows, data, offsets in tx.pieces(batch, "text", at_once):
                if writer is None:
                    uri, stream = storage.new_file(folder, "ids", ".tok")
                    writer = TokenWriter(stream, bits_for(max(encoder.vocabulary, end_id + 1)), block)
                writer.add(rows.column(0), *encoder.ended(data, offsets, end_id))
                if writer.n >= file_ids:
                    yield closed()
                    writer, number = None, number + 1
        if writer is not None:
            yield closed()

    return written(dealt.mapInArrow(releasing(run), FILE), "token-files")


DOCUMENT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_tokens(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files.

    ``start`` counts the ids of all documents before it: those before it in its file, and those of
    earlier files, a running sum over the list of files.
    """
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with storage.random_access(row["path"]) as handle:
                    file, sums = TokenFile(handle), []
                    for document, ids in file.documents():
                        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        if len(sums) == READ_ROWS or document + 1 == len(file.doc_ids):
                            low, high = document + 1 - len(sums), document + 1
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(file.doc_ids[low:high], mask=file.nulls[low:high]), pa.array(row["before"] + file.starts[low:high]),
                                 pa.array(np.diff(file.starts[low : high + 1])), pa.array(sums, pa.int64())], names=names)
                            sums = []

    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.select("part", "number", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    partitions = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return listed.repartition(partitions, "part", "number").mapInArrow(releasing(run), DOCUMENT)
