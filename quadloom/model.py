"""Data model: the long `facts` frame, the change log and schema metadata.

facts  (namespace, subject, predicate, object_uid, value, value_type, lang, facets)
log    facts + (op, seq, start_ts, commit_ts)

`facts` is the interchange and history form, laid out on disk by predicate.
Wide node frames and (src, dst, facets...) edge frames are the query form.
Facet map values are JSON literals, so their type survives the text form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The untyped star and the mutation kinds of the wire form.
STAR = "_STAR_ALL"
OP_SET, OP_DEL, OP_OVR = "SET", "DEL", "OVR"

# Name of the predicate that carries type labels; pass another one where a
# store uses a different name.
TYPE_PREDICATE = "node.type"

FACETS = T.MapType(T.StringType(), T.StringType())

FACT_SCHEMA = T.StructType(
    [
        T.StructField("namespace", T.LongType()),
        T.StructField("subject", T.LongType()),
        T.StructField("predicate", T.StringType()),
        T.StructField("object_uid", T.LongType()),
        T.StructField("value", T.StringType()),
        T.StructField("value_type", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("facets", FACETS),
    ]
)

LOG_SCHEMA = T.StructType(
    FACT_SCHEMA.fields
    + [
        T.StructField("op", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("start_ts", T.LongType()),
        T.StructField("commit_ts", T.LongType()),
    ]
)

FACT_COLUMNS = FACT_SCHEMA.fieldNames()


def namespace_of(df: DataFrame) -> Column:
    """The tenant of a row; frames without the column belong to tenant 0."""
    return F.col("namespace").cast("long") if "namespace" in df.columns else F.lit(0).cast("long")


def tenant_key(*frames: DataFrame) -> list[str]:
    """The tenant column as a part of a key, where one of the frames has it."""
    return ["namespace"] if any("namespace" in df.columns for df in frames) else []


def with_tenant(df: DataFrame, key: list[str]) -> DataFrame:
    """`df` with the columns of a `tenant_key`; rows without a tenant belong to tenant 0."""
    return df if all(k in df.columns for k in key) else df.withColumn("namespace", namespace_of(df))


def no_facets() -> Column:
    return F.lit(None).cast(FACETS)


def as_facts(df: DataFrame, **columns: Column) -> DataFrame:
    """Project `df` to the facts layout; columns not named are null (namespace 0)."""
    given = {"namespace": F.lit(0), **columns}
    return df.select(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in FACT_SCHEMA.fields
        ]
    )


def value_fact(df: DataFrame, subject: Column, predicate: str, value: Column, value_type: str, **more) -> DataFrame:
    """One value row per input row whose value is not null."""
    rows = as_facts(
        df,
        subject=subject,
        predicate=F.lit(predicate),
        value=value.cast("string"),
        value_type=F.lit(value_type),
        **more,
    )
    return rows.where(F.col("value").isNotNull())


def edge_fact(df: DataFrame, subject: Column, predicate: str, target: Column, **more) -> DataFrame:
    """One edge row per input row whose target is not null."""
    rows = as_facts(
        df,
        subject=subject,
        predicate=F.lit(predicate),
        object_uid=target,
        value_type=F.lit("uid"),
        **more,
    )
    return rows.where(F.col("object_uid").isNotNull())


def wide_to_facts(
    df: DataFrame,
    subject: str,
    values: dict[str, tuple[str, str]] | None = None,
    edges: dict[str, str] | None = None,
    keep_nulls: bool = False,
    namespace: str | None = None,
) -> DataFrame:
    """Wide node rows to facts in one pass: `values` maps predicate -> (column, type),
    `edges` maps predicate -> uid column. One generator, no union of scans."""
    cells = [
        F.struct(
            F.lit(p).alias("predicate"),
            F.lit(None).cast("long").alias("object_uid"),
            F.col(c).cast("string").alias("value"),
            F.lit(t).alias("value_type"),
        )
        for p, (c, t) in (values or {}).items()
    ] + [
        F.struct(
            F.lit(p).alias("predicate"),
            F.col(c).cast("long").alias("object_uid"),
            F.lit(None).cast("string").alias("value"),
            F.lit("uid").alias("value_type"),
        )
        for p, c in (edges or {}).items()
    ]
    ns = F.col(namespace).cast("long") if namespace else F.lit(0).cast("long")
    rows = df.select(ns.alias("namespace"), F.col(subject).cast("long").alias("subject"), F.inline(F.array(*cells)))
    if not keep_nulls:
        rows = rows.where(F.col("value").isNotNull() | F.col("object_uid").isNotNull())
    return rows.select(
        "namespace",
        "subject",
        "predicate",
        "object_uid",
        "value",
        "value_type",
        F.lit(None).cast("string").alias("lang"),
        no_facets().alias("facets"),
    )
