"""Small helpers of the operators: inputs, output batches, free column names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, name: str = "text") -> Column:
    return F.col(f"`{name}`").cast("string")


def carried(docs: DataFrame, *columns: Column, carry: bool) -> DataFrame:
    """`columns`, and with `carry` the whole row as the struct `row`, so that a stage can hand
    its input on without a join whatever its columns are called."""
    return docs.select(*columns, *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] * carry)


def schema_of(ddl: str, docs: DataFrame | None) -> StructType:
    """The columns of `ddl`, and `row` as in `carried` if `docs` is given."""
    out = StructType.fromDDL(ddl)
    return out if docs is None else StructType([*out.fields, StructField("row", docs.schema)])


def carried_on(batch: pa.RecordBatch) -> dict:
    return {"row": batch.column("row")} if "row" in batch.schema.names else {}


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | Iterator[dict]], schema: str | StructType) -> DataFrame:
    """`fn` over the Arrow batches of `df`; it gives columns by name (one dict or several),
    in the order of `schema`. Inputs, outputs and memory are bounded by a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                for part in [out] if isinstance(out, dict) else out:
                    yield pa.RecordBatch.from_pydict(part)

    return df.mapInArrow(run, schema)
