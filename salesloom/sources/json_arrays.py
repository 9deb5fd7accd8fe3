"""One large JSON array read by many tasks.

The text source cuts a file at every `}`, wherever its splits lie, so each task reads its own byte range. Whether such a fragment begins inside a
text, and at which depth, depends on all that comes before. Therefore every fragment is turned into a transition: for both
states at its start (outside or inside a text) the state at its end and the change of depth. Transitions compose, so those of a split
give one row, the rows of a file's splits are composed along the file, and every fragment then knows its depth. A `}` that returns to depth 1
ends an item of the array; the fragments up to it are put together again, however many splits they lie in.

Windows run over the fragments of one split and over the splits of one file (one row for each split), never over a whole file's
fragments. An item must fit into memory, an array need not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.session import shared_dir

_BLANK = " \t\r\n﻿"


def _depth_change(pieces: Column, parity: int) -> Column:
    """Opened minus closed brackets in the pieces between quotes that lie outside of texts."""
    outside = F.array_join(F.filter(pieces, lambda _, i: i % 2 == parity), "")
    without = lambda signs: F.length(F.translate(outside, signs, ""))
    return without("]}") - without("{[")


def fragments(spark: SparkSession, path: str, larger_than: int = 0) -> DataFrame:
    """file, split, place (order inside the split), value and its transition: flip, depth_0, depth_1 by the state at the start.

    The `}` behind a fragment belongs to it, except for a file's last fragment (`last`), which has none."""
    rows = spark.read.text(path, lineSep="}").filter(F.col("_metadata.file_size") > larger_than).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"), "value",
    )
    held = f"{shared_dir(spark, 'json-fragments')}/rows"
    # Quotes and brackets count where no backslash stands before them.
    pieces = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    rows.select("*", (F.size(pieces) - 1).alias("quotes"), _depth_change(pieces, 0).alias("d0"), _depth_change(pieces, 1).alias("d1")).write.parquet(held)
    rows = spark.read.parquet(held)
    ends = rows.groupBy("file").agg(F.max(F.struct("split", "place")).alias("end"))
    last = F.coalesce((F.col("split") == F.col("end.split")) & (F.col("place") == F.col("end.place")), F.lit(False))
    flip = F.col("quotes") % 2
    closes = F.when(last, 0).otherwise(1)
    return rows.join(ends, "file").select(
        "file", "split", "place", "value", last.alias("last"), flip.alias("flip"),
        (F.col("d0") - F.when(flip == 0, closes).otherwise(0)).alias("depth_0"),
        (F.col("d1") - F.when(flip == 1, closes).otherwise(0)).alias("depth_1"),
    )


def placed(rows: DataFrame) -> DataFrame:
    """Fragments with the state and depth behind them: inside (a text), depth."""
    in_split = Window.partitionBy("file", "split").orderBy("place")
    before, until = in_split.rowsBetween(Window.unboundedPreceding, -1), in_split.rowsBetween(Window.unboundedPreceding, 0)
    turned = rows.withColumn("turned", F.coalesce(F.sum("flip").over(before), F.lit(0)) % 2)
    change = lambda start: F.when((F.col("turned") + start) % 2 == 0, F.col("depth_0")).otherwise(F.col("depth_1"))
    splits = turned.groupBy("file", "split").agg(
        (F.sum("flip") % 2).alias("flips"), F.sum(change(0)).alias("whole_0"), F.sum(change(1)).alias("whole_1")
    )
    along = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("state", F.coalesce(F.sum("flips").over(along), F.lit(0)) % 2)
    own = F.when(F.col("state") == 0, F.col("whole_0")).otherwise(F.col("whole_1"))
    splits = splits.select("file", "split", "state", F.coalesce(F.sum(own).over(along), F.lit(0)).alias("deep"))
    known = turned.join(splits, ["file", "split"])
    own = F.when((F.col("turned") + F.col("state")) % 2 == 0, F.col("depth_0")).otherwise(F.col("depth_1"))
    return known.select(
        "file", "split", "place", "value", "last",
        ((F.col("turned") + F.col("state") + F.col("flip")) % 2 == 1).alias("inside"),
        (F.col("deep") + F.sum(own).over(until)).alias("depth"),
    )


def items_of_arrays(spark: SparkSession, path: str, larger_than: int = 0) -> DataFrame:
    """file, items (array of JSON texts) for every stretch of a file's array up to the end of an object; elements that are
    no objects come along with the object behind them.

    A file whose root is no array gives one row with `items` NULL. An array that does not end raises."""
    rows = placed(fragments(spark, path, larger_than))
    ends = ~F.col("inside") & (F.col("depth") == 1) & ~F.col("last")
    # Backwards, so that the frame only grows: the end that comes next is the last one met.
    backwards = Window.partitionBy("file", "split").orderBy(F.col("place").desc()).rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(ends, F.struct("split", "place")), ignorenulls=True).over(backwards)
    marked = rows.withColumn("own", own)
    # Fragments behind a split's last item belong to the first item that ends in a later split.
    firsts = marked.groupBy("file", "split").agg(F.min(F.when(ends, F.struct("split", "place"))).alias("first"))
    behind = Window.partitionBy("file").orderBy(F.col("split").desc()).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select("file", "split", F.last("first", ignorenulls=True).over(behind).alias("later"))
    marked = marked.join(firsts, ["file", "split"]).withColumn("item", F.coalesce("own", "later"))
    text = F.concat("value", F.when(F.col("last"), F.lit("")).otherwise(F.lit("}")))
    begins = F.min(F.struct("split", "place"))
    chunks = marked.groupBy("file", "item").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("split", "place", text.alias("text")))), lambda f: f["text"]), "").alias("text"),
        begins.alias("begin"), F.bool_or("last").alias("last"),
        F.max(F.when(F.col("last"), F.struct("depth", "inside"))).alias("end"), F.min("depth").alias("lowest"),
    )
    heads = rows.groupBy("file").agg(F.min(F.struct("split", "place")).alias("head"))
    chunks = chunks.join(heads, "file").withColumn("is_head", F.col("begin") == F.col("head"))
    bare = F.btrim(F.col("text"), F.lit(_BLANK))
    roots = chunks.filter("is_head").select("file", bare.startswith("[").alias("is_array"))
    return _judged(chunks.withColumn("bare", bare).join(roots, "file"))


def _judged(chunks: DataFrame) -> DataFrame:
    bare = F.col("bare")
    closed = F.when(F.col("last"), F.regexp_replace(bare, r"\]$", "")).otherwise(bare)
    # The first stretch opens the array; every other one goes on behind a comma, but for the end alone.
    follows = F.col("is_head") | bare.startswith(",") | (F.col("last") & (closed == ""))
    items = F.from_json(F.concat(F.lit("["), F.substring(closed, 2, 2**31 - 1), F.lit("]")), "array<string>")
    complete = ~F.col("last") | ((F.col("end.depth") == 0) & ~F.col("end.inside") & bare.endswith("]"))
    problem = F.concat(F.lit("the JSON array cannot be read: "), F.col("file"))
    found = F.when(follows & complete & items.isNotNull() & (F.col("lowest") >= 0), items).otherwise(F.raise_error(problem))
    arrays = chunks.filter("is_array").select("file", found.alias("items"))
    others = chunks.filter("NOT is_array AND is_head").select("file", F.lit(None).cast("array<string>").alias("items"))
    return arrays.unionByName(others)
