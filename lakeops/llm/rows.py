"""Apply a function of one text to every row of a column, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROWS_AT_ONCE = 256


def with_function(df: DataFrame, text: str, keep: list[str], make: Callable[[], Callable[[str], tuple]], fields: str) -> DataFrame:
    """The columns ``keep`` of ``df`` and the columns ``fields`` that the function returns for the text (null: empty text).

    ``make`` builds the function once per task, so that automata and patterns need not travel.
    """
    added = StructType.fromDDL(fields)
    schema = StructType([*df.select(*keep).schema.fields, *added.fields])
    types = [pa.int64() if f.dataType.simpleString() == "bigint" else pa.bool_() if f.dataType.simpleString() == "boolean" else pa.string() for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                results = [function(x or "") for x in batch.column(batch.num_columns - 1).to_pylist()]
                columns = [pa.array([r[k] for r in results], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(batch.num_columns - 1)), *columns], schema.names)

    return df.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)
