"""Python functions as table functions and grouped folds (U-1, U-3, U-4)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def vectorised(fn: Callable[[pd.Series], pd.Series], returns: str) -> Callable[[Column], Column]:
    """A series function as a column function, for what expressions cannot say (U-1)."""

    @F.pandas_udf(returns)
    def apply(values: pd.Series) -> pd.Series:
        return fn(values)

    return lambda column: apply(column)


def expand(df: DataFrame, columns: Sequence[str], fn: Callable, adds: str) -> DataFrame:
    """One row to many by a generator of tuples (U-3).

    ``fn(*values)`` yields tuples for the columns in ``adds``; rows are made
    batch by batch and never gathered.
    """
    added = T.StructType.fromDDL(adds)
    schema = T.StructType([*df.schema.fields, *added.fields])
    columns, names = list(columns), added.names

    def run(frames):
        for frame in frames:
            at, made = [], []
            for i, values in enumerate(zip(*[frame[c] for c in columns])):
                for row in fn(*values):
                    at.append(i)
                    made.append(row)
            out = frame.iloc[at].reset_index(drop=True)
            for j, name in enumerate(names):
                out[name] = [m[j] for m in made]
            yield out

    return df.mapInPandas(run, schema)


def fold_groups(df: DataFrame, keys: Sequence[str], value: str, step: Callable, start, returns: str,
                name: str = "folded", combine: Callable | None = None, slices: int = 64) -> DataFrame:
    """Fold a group with an associative function (U-4).

    Each batch is folded where it is read; only the partial results, one per
    key and slice, are shuffled and folded again, and ``start`` enters once per
    group at the end. So the result depends neither on batches nor on
    partitions. ``combine`` merges partials of another kind than the values;
    every partial then begins with ``start``, which must be neutral for it.
    NULL keys form a group, NULL values are handed to ``step``.
    """
    merge = combine or step
    kind = T._parse_datatype_string(returns)
    keys = list(keys)
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField(name, kind)])
    target = to_arrow_schema(schema)

    def rows_of(batch):
        return zip(zip(*[batch.column(i).to_pylist() for i in range(len(keys))]), batch.column(len(keys)).to_pylist())

    def table(rows):
        columns = list(zip(*[(*k, v) for k, v in rows])) or [()] * len(target)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    def partial(batches):
        for batch in batches:
            out = {}
            for ident, v in rows_of(batch):
                if combine:
                    out[ident] = step(out.get(ident, start), v)
                else:
                    out[ident] = step(out[ident], v) if ident in out else v
            yield table(out.items())

    def final(first):
        def run(batches):
            current, acc, done = None, None, []
            close = (lambda x: x) if combine or not first else (lambda x: step(start, x))
            for batch in batches:
                for ident, v in rows_of(batch):
                    if ident == current:
                        acc = merge(acc, v)
                    else:
                        if current is not None:
                            done.append((current, close(acc)))
                        current, acc = ident, v
                    if len(done) >= 10_000:
                        yield table(done)
                        done = []
            if current is not None:
                done.append((current, close(acc)))
            yield table(done)
        return run

    pieces = df.select(*keys, value).mapInArrow(partial, schema)
    slice_keys = [*keys, "__slice"]
    sliced = pieces.withColumn("__slice", F.spark_partition_id() % slices)
    merged = (sliced.repartition(*slice_keys).sortWithinPartitions(*keys).drop("__slice")
              .mapInArrow(final(False), schema))
    return merged.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(final(True), schema)
