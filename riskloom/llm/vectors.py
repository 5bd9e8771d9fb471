"""Vectors of one length as matrices inside Arrow batches, and sums over partitions by a tree."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ship_package
from riskloom.session import materialize

#: Partial results that one task folds together.
FAN = 16


def whole_rows(column, size: int):
    """Places and double values of the vectors with ``size`` entries, none of them null or non-finite."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    places = np.flatnonzero(pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) == size)
    entries = column.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
    values = np.asarray(entries, dtype=np.float64).reshape(len(places), size)
    good = np.isfinite(values).all(axis=1)
    return places[good], values[good]


def fold(partials: DataFrame, merge, label: str) -> DataFrame:
    """One row out of many: ``merge`` makes one dictionary of up to ``FAN`` rows' dictionaries, until one is left.

    ``partials`` has a column ``slot``, numbered by partition. Each level is stored, so a lost executor costs its
    own group again, and no task sees more than ``FAN`` rows.
    """
    schema = partials.schema

    def run(table):
        rows = table.to_pylist()
        return pa.Table.from_pylist([{**merge(rows), "slot": rows[0]["slot"] // FAN}], schema=table.schema)

    level = materialize(partials, label)
    ship_package(partials.sparkSession)
    while level.count() > 1:
        level = materialize(level.groupBy(F.floor(F.col("slot") / FAN)).applyInArrow(run, schema), label)
    return level
