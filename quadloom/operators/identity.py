"""Assigning uids to blank labels and putting them everywhere the label occurs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quadloom.functions import uid as uids
from quadloom.plans.rank import positions
from quadloom.plans.spread import spread_key


def blank_labels(triples: DataFrame) -> DataFrame:
    """Distinct blank labels in subject or object position, from one scan."""
    both = triples.select(F.explode(F.array_compact(F.array("subject", "object"))).alias("label"))
    return both.where(F.col("label").startswith("_:")).distinct()


def assign(labels: DataFrame, first_uid: int = 1) -> DataFrame:
    """label -> uid, dense from `first_uid` in label order; no task sees all labels."""
    ranked = positions(labels.select("label"), [F.col("label").asc()], out="_pos")
    return ranked.select("label", (F.col("_pos") + F.lit(first_uid - 1)).alias("uid"))


def propagate(triples: DataFrame, assigned: DataFrame) -> DataFrame:
    """Replace blank labels in subject and object by the text of the assigned uid.
    Rows without a blank label in a position are spread instead of joined on null."""
    names = triples.columns
    text = assigned.select(F.col("label").alias("_label"), uids.to_text(F.col("uid")).alias("_text"))
    out = triples
    for position in ("subject", "object"):
        others = [F.col(c) for c in ("subject", "predicate", "value") if c in names]
        blank = F.coalesce(F.col(position).startswith("_:"), F.lit(False))
        out = out.withColumn("_key", spread_key(F.col(position), blank, *others))
        out = out.join(text, F.col("_key") == F.col("_label"), "left")
        out = out.withColumn(position, F.coalesce("_text", position)).select(*names)
    return out


def complete_blank(nodes: DataFrame, key: str, uid: str = "uid") -> DataFrame:
    """Rows with an empty uid get a blank label derived from their key column."""
    empty = uids.classify(F.col(uid)) == "empty"
    return nodes.withColumn(uid, F.when(empty, uids.blank_label(F.col(key))).otherwise(F.col(uid)))
