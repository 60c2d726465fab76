import pyarrow as pa
import pytest

from stayvalue.llm.shared import in_parts


@pytest.mark.parametrize("kind", [pa.string(), pa.binary()])
def test_parts_hold_all_rows_in_order(kind):
    texts = ["ab", None, "", "c" * 50, "d", "éé", None, "e" * 9] * 5
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array([t if t is None or kind == pa.string() else t.encode() for t in texts], kind)],
        names=["i", "t"],
    )
    parts = list(in_parts([batch.slice(0, 0), batch.slice(3), batch], 1, size=10))
    rows = [r for part in parts for r in part.column(0).to_pylist()]
    assert rows == [*range(3, len(texts)), *range(len(texts))]
    for part in parts:
        sizes = [len((t if isinstance(t, bytes) else (t or "").encode()) or b"") for t in part.column(1).to_pylist()]
        assert sum(sizes) <= 10 or len(sizes) == 1
