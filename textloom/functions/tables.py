"""Table functions and user callables over Arrow batches.

``register`` makes ``cat_tasks`` known to SQL: a table function from a comment and its code to their
training tasks, joined laterally to a query's rows. ``keep`` and ``apply`` take a user's Python
callables, which get Arrow batches of the columns they name and never single rows; what they
return is checked, so a callable of the wrong length ends with an error and not with shifted rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

#: Longer comments explain their code.
EXPLAINS = 100


class CatTasks:
    """PRJ9: comment to code, code to comment, and code explanation for a long comment."""

    def eval(self, comment: str, code: str) -> Iterator[tuple[str, str, str]]:
        comment, code = comment or "", code or ""
        yield "comment_to_code", comment, code
        yield "code_to_comment", code, comment
        if len(comment) > EXPLAINS:
            yield "code_explanation", code, comment


def register(spark: SparkSession) -> None:
    spark.udtf.register("cat_tasks", udtf(CatTasks, returnType="task_type string, input string, target string"))


def keep(df: DataFrame, predicate: Callable[..., pa.Array], *columns: str) -> DataFrame:
    """The rows for which ``predicate`` of the columns' arrays is true (null is not). The user's columns
    come back as they were, whatever their names."""
    own = df.select(F.struct(*(F.col(quoted(c)) for c in columns)).alias("seen"), F.struct("*").alias("own"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            told = predicate(*b.column(0).flatten())
            told = told.combine_chunks() if isinstance(told, pa.ChunkedArray) else pa.array(told, pa.bool_()) if not isinstance(told, pa.Array) else told
            if len(told) != b.num_rows:
                raise ValueError(f"{len(told)} verdicts for {b.num_rows} rows")
            yield b.filter(told.fill_null(False))

    return own.mapInArrow(work, own.schema).select("own.*")


def apply(df: DataFrame, function: Callable[..., pa.Array], kind: str, name: str, *columns: str) -> DataFrame:
    """``df`` with a column ``name`` (or in its place) of what ``function`` makes of the columns' arrays."""
    own = df.select(F.struct(*(F.col(quoted(c)) for c in columns)).alias("seen"), F.struct("*").alias("own"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = function(*b.column(0).flatten())
            if len(made) != b.num_rows:
                raise ValueError(f"{len(made)} values for {b.num_rows} rows")
            yield pa.RecordBatch.from_arrays([b.column(1), made if isinstance(made, pa.Array) else pa.array(made)], names=["own", "made"])

    schema = T.StructType([own.schema["own"], T.StructField("made", T.DataType.fromDDL(kind))])
    out = own.mapInArrow(work, schema)
    return out.select(*(F.col("own").getField(c).alias(c) for c in df.columns if c != name), F.col("made").alias(name))


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
