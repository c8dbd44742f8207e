"""Exact deduplication by sorting content.

Rows are range-partitioned on the start of their normalised text (Spark samples the splitters),
each partition is sorted externally on the whole text, and every row is compared in full with
the row before it. Runs of equal rows are groups of copies.

A text with a large share of all rows would lie in one range. Such texts are found first by a
count with map-side combine, and their rows are scattered over several ranges by a hash of the
identifier; the runs of one hot text are then put together by its digest and length. There are
at most ``PARTS_PER_RANGE`` times as many hot texts as shuffle partitions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, shuffle_parts, whole_text

# A text is hot when it has more than 1/PARTS_PER_RANGE of the rows of an average range.
PARTS_PER_RANGE = 4

# Texts with fewer rows than this are no burden to a task.
LEAST_HOT = 500

# Characters of the text in the range key; the whole text decides within a range.
LEAD = 24


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only. Texts of plain ASCII take the quicker way to the same result."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def _sorted_runs(docs: DataFrame, id_col: str, text_col: str, keep: str, scratch: Scratch):
    """Rows in content order; ``first`` marks the first row of each run of equal texts, the one
    that ``keep`` asks for. The row itself is nested, so no column of it can clash."""
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    norm = ascii_lower(whole_text(f"`{text_col}`"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.xxhash64(norm).alias("h"),
        F.substring(norm, 1, LEAD).alias("lead"),
    )
    counts = scratch.write(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = max(LEAST_HOT, total // (shuffle_parts(docs.sparkSession) * PARTS_PER_RANGE))
    hot = counts.where(F.col("n") > most).select(
        "h", F.ceil(F.col("n") / most).cast("int").alias("pieces")
    )
    ident = F.col("row").getField(id_col)
    order = F.col("id").asc_nulls_last() if keep == "min" else F.col("id").desc_nulls_last()
    content = Window.partitionBy("lead", "h", "salt").orderBy("norm", order)
    return (
        rows.join(F.broadcast(hot), "h", "left")
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64(ident), F.col("pieces")), F.lit(0)))
        .repartitionByRange("lead", "h", "salt")
        .withColumn("norm", ascii_lower(F.coalesce(F.col("row").getField(text_col), F.lit(""))))
        .withColumn("id", ident)
        .withColumn("first", F.coalesce(F.lag("norm").over(content) != F.col("norm"), F.lit(True)))
        .withColumn("run", F.sum(F.col("first").cast("long")).over(content))
        .withColumn("hot", F.col("pieces").isNotNull())
    )


def _digest() -> tuple[Column, Column]:
    return F.sha2("norm", 256).alias("sha"), F.octet_length("norm").alias("size")


def _hot_groups(firsts: DataFrame, keep: str) -> DataFrame:
    """The row to keep of each hot text, from the first rows of its runs. A few rows per hot
    text, so at most a few thousand."""
    known = F.col("id").isNull() if keep == "min" else F.col("id").isNotNull()
    best = F.min if keep == "min" else F.max
    return firsts.where("hot").groupBy("h", "sha", "size").agg(
        best(F.struct(known, "id", "salt")).alias("best"),
        F.sum("run_rows").alias("hot_rows"),
    )


def exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min"
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept and text_sha256.

    Texts are equal if they are the same after lower-casing A-Z; a null text is an empty one. Of
    equal texts the row with the smallest (``keep='max'``: largest) identifier stays. Rows with a
    null identifier stay only if none of their copies has one. Of rows repeated with the same
    identifier and text exactly one is kept. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    narrow = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"))
    one_run = Window.partitionBy("lead", "h", "salt", "run")
    best = F.min if keep == "min" else F.max
    rows = scratch.write(
        _sorted_runs(narrow, "i", "t", keep, scratch)
        .select("id", "lead", "h", "salt", "run", "first", "hot", *_digest())
        .withColumn("run_keep", best("id").over(one_run))
        .withColumn("run_rows", F.count(F.lit(1)).over(one_run))
    )
    hot = F.broadcast(_hot_groups(rows.where("first"), keep))
    chosen = F.col("best.id").eqNullSafe(F.col("id")) & (F.col("best.salt") == F.col("salt"))
    return rows.join(hot, ["h", "sha", "size"], "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("best").isNull(), F.col("run_keep"))
        .otherwise(F.col("best.id"))
        .alias("keep_id"),
        F.coalesce("hot_rows", "run_rows").alias("group_size"),
        (F.col("first") & (F.col("best").isNull() | chosen)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min"
) -> DataFrame:
    """The rows of ``docs`` that ``exact_copies`` keeps, with all their columns."""
    scratch = Scratch(docs.sparkSession)
    firsts = scratch.write(
        _sorted_runs(docs, id_col, text_col, keep, scratch)
        .where("first")
        .select("row", "id", "h", "salt", "hot", F.lit(1).cast("long").alias("run_rows"), *_digest())
    )
    hot = F.broadcast(_hot_groups(firsts, keep))
    chosen = F.col("best.id").eqNullSafe(F.col("id")) & (F.col("best.salt") == F.col("salt"))
    return (
        firsts.join(hot, ["h", "sha", "size"], "left")
        .where(F.col("best").isNull() | chosen)
        .select("row.*")
    )
