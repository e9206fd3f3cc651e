"""Edited texts leave a task piece by piece."""

import pyarrow as pa
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tallyloom.operators import augment


class Caught:
    """Takes the function a task would run."""

    schema = StructType([StructField("k", LongType()), StructField("t", StringType()), StructField("v", IntegerType())])

    def mapInArrow(self, run, schema):
        return run


def test_a_batch_of_long_texts_is_edited_in_pieces():
    texts = [("the café " * 30_000)[:250_000 + i] for i in range(24)] + ["", "the"]
    batch = pa.RecordBatch.from_pydict({"k": list(range(26)), "t": texts, "v": [1] * 26},
                                       schema=pa.schema([("k", pa.int64()), ("t", pa.string()), ("v", pa.int32())]))
    out = list(augment.synonym_column(Caught(), "k", "t", "v", {"the": ["that"]})(iter([batch])))
    assert max(sum(len(t) for t in b["t"].to_pylist()) for b in out) <= 2 * augment.PIECE
    whole = pa.Table.from_batches(out).to_pydict()
    assert whole["k"] == list(range(26))
    assert whole["t"] == [augment.synonym_replace(t, {"the": ["that"]}, 2, (42, i, 1)) for i, t in enumerate(texts)]
    assert list(augment.synonym_column(Caught(), "k", "t", "v", {"the": ["that"]})(iter([batch.slice(0, 0)])))[0].num_rows == 0
