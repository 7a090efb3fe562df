"""What a task codes at a time."""

import pyarrow as pa

from clickweir.llm import packing


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], ["key", "text"])


def test_portions_cut_large_batches_and_join_small_ones():
    texts = ["a" * 300, None, "", "é" * 50, "b" * 5000, "c", *["d" * 90] * 40, *[None] * 30]
    rows = list(enumerate(texts))
    for cuts in ([len(rows)], [1, 2, 3, 5, 20, len(rows)], list(range(1, len(rows) + 1))):
        batches = [_batch(rows[a:b]) for a, b in zip([0, *cuts], cuts)] + [_batch([])]
        parts = [list(zip(t["key"].to_pylist(), t["text"].to_pylist())) for t in packing.portions(iter(batches), size=1000)]
        assert [r for part in parts for r in part] == rows
        weight = [sum(len((t or "").encode()) + packing.ROW_BYTES for _, t in part) for part in parts]
        assert all(w <= 1000 or len(part) == 1 for w, part in zip(weight, parts))
        assert all(a + b > 1000 for a, b in zip(weight, weight[1:]))
    assert list(packing.portions(iter([]))) == []
