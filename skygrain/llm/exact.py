"""Exact dedup by skew-safe combining, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from skygrain.plans.durable import materialize

SALTS = 64


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def content_groups(base: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per different text: ``digest, text, keep_id, group_size``.

    Three merges, each on the digest and the full text: within a task before any shuffle, then per salt (the salt is
    constant within a task, so a group has at most ``salts`` rows after it), then over the salts. However many rows
    share a text, no task receives more than one row per map task and salt.
    """
    salted = base.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    merged = salted.groupBy("digest", "salt", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return merged.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def _base(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("digest", digest(F.col("text")))


def _groups(base: DataFrame, salts: int) -> tuple[DataFrame, DataFrame | None]:
    """(one row per digest, the rows of the digests that several texts share or None)."""
    summary = materialize(
        content_groups(base, salts).groupBy("digest").agg(
            F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
        ),
        "exact-groups",
    )
    shared = summary.filter("texts > 1").select("digest")
    return summary, None if shared.isEmpty() else base.join(shared, "digest", "left_semi")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """Which row of each group of identical texts stays.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept, digest``. The row with the largest id stays.
    A null text counts as empty; texts are compared as they are, without any change. Repeated rows of the winning id
    are all marked kept (``drop_copies`` leaves one). A group whose ids are all null has a null ``keep_id`` and is
    kept. An empty table gives an empty result; other columns are ignored, whatever their names.

    Rows find their group by digest. Where different texts share a digest (``digest`` is a parameter so that tests
    can force this), the rows of those digests are matched by the full text instead.
    """
    base = _base(docs, id_col, text_col, digest)
    summary, apart = _groups(base, salts)
    clear = base.select("doc_id", "digest").join(
        summary.filter("texts = 1").select("digest", "keep_id", "group_size"), "digest"
    )
    if apart is not None:
        clear = clear.unionByName(
            apart.join(content_groups(apart, salts), ["digest", "text"]).select(*clear.columns)
        )
    return clear.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )


def drop_copies(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated equal rows one stays."""
    base = _base(docs, "doc_id", "text", digest)
    summary, apart = _groups(base, salts)
    stays = summary.filter("texts = 1").select("keep_id", "digest")
    if apart is not None:
        stays = stays.unionByName(content_groups(apart, salts).select("keep_id", "digest"))
    hashed = docs.withColumn("_digest", digest(F.coalesce(F.col("text"), F.lit(""))))
    won = hashed["_digest"].eqNullSafe(stays["digest"]) & hashed["doc_id"].eqNullSafe(stays["keep_id"])
    return hashed.join(stays, won, "left_semi").dropDuplicates(["doc_id", "_digest"]).drop("_digest")
