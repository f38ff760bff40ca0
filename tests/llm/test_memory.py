"""What a worker holds while it reads much."""

from __future__ import annotations

import pickle
import tracemalloc

import pyarrow as pa

from docloom.llm import decontamination


def test_a_decontamination_task_holds_little_of_what_it_reads():
    """600,000 words that all differ, and a passage in each of sixty batches: a task held 115 MB of it, and now 46."""
    passage = " ".join(f"item{i}" for i in range(24))
    items = decontamination.Items([(7, passage)])
    assert len(pickle.dumps(items)) < 500_000

    def batches():
        for b in range(60):
            texts = [" ".join(f"w{b}x{d}y{i}" for i in range(100)) for d in range(100)]
            texts[50] += f" {passage} end"
            yield pa.RecordBatch.from_arrays([pa.array(range(b * 100, b * 100 + 100), pa.int64()), pa.array(texts)], ["doc_id", "text"])

    decontamination._forget()
    tracemalloc.start()
    found = [tuple(r.values())[:6] for out in decontamination._searched(items)(batches()) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    decontamination._forget()
    assert found == [(b * 100 + 50, 7, 0, 24, 100, 124) for b in range(60)]
    assert peak < 60_000_000
