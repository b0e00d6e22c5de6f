"""A bounded sample of labelled texts for fitting a model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import held_out


def _known(labels: DataFrame, label: str, doc_id: str) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from, one for each id."""
    known = labels.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    )
    known = known.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.min("label").alias("label"))


def label_counts(
    docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str
) -> dict[int, int]:
    """How many ids with a text that has words have each of the labels 0 and 1, of all that
    ``labelled_sample`` chooses from."""
    known = _known(labels, label, doc_id).filter(F.col("label").isin(0, 1))
    # of rows with one id the least text counts; it has words if its blanks end before it does
    start = F.regexp_extract(F.col(text), r"^[\t-\r ]*[^\t-\r ]?", 0).alias("start")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), start)
    rows = rows.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min("start").alias("start"))
    rows = rows.filter(F.col("start").rlike(r"[^\t-\r ]"))
    return {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, doc_id: str, text: str
) -> DataFrame:
    """(doc_id, label, text) of at most ``per_class`` rows for each of the labels 0 and 1.

    Held-out rows, null ids and other labels are left out. Rows are chosen by a hash of their
    id, so the same rows come out each time. Of rows with one id the least label and text count.
    """
    known = _known(labels, label, doc_id)
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value)
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # at most two times per_class rows
    rows = rows.join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
