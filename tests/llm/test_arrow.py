import pyarrow as pa
import pytest

from dialoom.llm.arrow import bounded


@pytest.mark.parametrize("most", [1, 10, 1000])
def test_rows_stay_whole_and_in_order(most):
    texts = ["a" * n if n % 3 else None for n in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(range(30))], ["t", "n"])
    parts = list(bounded([batch, batch.slice(0, 0)], ["t"], most))
    assert [x for p in parts for x in p.column("n").to_pylist()] == list(range(30))
    assert all(p.num_rows for p in parts)
    assert all(sum(len(x or "") for x in p.column("t").to_pylist()) < most + 30 for p in parts)
