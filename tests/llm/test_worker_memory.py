"""What tasks of the pipeline's stages hold at once, and what their workers keep afterwards."""

from __future__ import annotations

import gc
import tracemalloc
import weakref

import numpy as np
import pyarrow as pa

from tallyloom.llm import language, queries, tokens, workers
from tallyloom.llm.shipping import ship


class Shared:
    def __init__(self, value):
        self.value = value


def labelled_batch(rows: int, words: int):
    model = language.Model(["de", "en"], np.random.default_rng(1).random((language.BUCKETS, 2), np.float32), np.ones((language.N_SCRIPTS, 2), bool))
    batch = pa.RecordBatch.from_arrays([pa.array(range(rows)), pa.array([f"some words of number {i} " * words for i in range(rows)])], names=["id", "text"])
    return model, batch


def test_labelling_holds_a_bounded_piece_of_a_batch():
    model, batch = labelled_batch(1000, 100)
    list(language._label(Shared(model), 12.0)([batch.slice(0, 1)]))  # tables that stay
    tracemalloc.start()
    try:
        for _ in language._label(Shared(model), 12.0)([batch]):
            pass
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 120 << 20


def test_pieces_do_not_change_labels(monkeypatch):
    model, batch = labelled_batch(300, 20)
    whole = pa.Table.from_batches(language._label(Shared(model), 12.0)([batch]))
    monkeypatch.setattr(language, "PIECE_BYTES", 1 << 10)
    assert pa.Table.from_batches(language._label(Shared(model), 12.0)([batch])).combine_chunks() == whole.combine_chunks()


def test_a_task_releases_memory_after_its_own_objects_are_gone(monkeypatch):
    held, states = [], []

    def run(batches):
        for batch in batches:
            array = np.zeros(10)
            held.append(weakref.ref(array))
            yield batch

    def release():
        gc.collect()
        states.append([h() for h in held])

    monkeypatch.setattr(workers, "release", release)
    assert list(workers.releasing(run)(iter([1, 2]))) == [1, 2]
    assert states == [[None, None]]


def test_memory_that_a_task_freed_goes_back_to_the_system():
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def run(batches):
        arrays = [np.ones(8_000) for _ in range(2_000)]  # 128 MB in blocks too small to be mapped on their own
        keep.append(np.ones(8_000))
        yield from batches
        del arrays

    keep: list[np.ndarray] = []
    before = resident()
    list(workers.releasing(run)(iter([1])))
    assert resident() - before < 64 << 20


def test_token_files_do_not_depend_on_the_text_encoded_at_once(spark):
    ship(spark)
    frame = spark.createDataFrame([(i, f"text {i} of many " * (i % 7)) for i in range(200)], "doc_id long, text string")
    path = queries.tokenizer_path()
    read = [
        sorted(tuple(r) for r in tokens.read_tokens(tokens.write_tokens(frame, path, 2, **options)).collect())
        for options in ({}, {"kept": 50, "encode_bytes": 128})
    ]
    assert read[0] == read[1] and len(read[0]) == 200
