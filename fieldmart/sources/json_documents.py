"""Documents of JSON files that hold one array or object, read by many tasks.

Spark's reader gives a file without line breaks between documents to one task. Here the file is
read as text cut at every closing brace, which Spark splits like lines. Whether a piece starts
inside a string follows from the number of quotes before it, how deep it lies from the braces
outside strings, and which document it belongs to from the documents that end before it: three
running counts. Each is a window inside one block of a file (the part of a file that one task has
read) plus the totals of the blocks before, a table of one row per block. The pieces of a document
are then joined again; only one document at a time is gathered.

A file is a list of objects, or an envelope whose first key is "data" with a list of objects, or
objects one after another. Elements that are no objects, and what is left of a broken file, are
rows with a reason. Layout between the documents is dropped, inside them it is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldmart.session import materialized

# The start of an envelope, and the reasons given for what is no document.
ENVELOPE = r'^\s*\{\s*"data"\s*:\s*\['
NOT_AN_OBJECT = "record is not a JSON object"
BROKEN = "not a JSON list or object of records"

_BLOCK = ["file", "block"]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between closing braces, in order: file, block, at, piece, file_size."""
    read = spark.read.option("lineSep", "}").text(path)
    return read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece"), F.col("_metadata.file_size").alias("file_size"))


def _running(df: DataFrame, count: str, name: str) -> DataFrame:
    """Add the sum of `count` over the pieces of the file before this one."""
    totals = df.groupBy(*_BLOCK).agg(F.sum(count).alias("_total"))  # one row per block
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*_BLOCK, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carried"))
    earlier = Window.partitionBy(*_BLOCK).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(count).over(earlier), F.lit(0))
    return df.withColumn("_inside", inside).join(carried, _BLOCK).withColumn(
        name, F.col("_inside") + F.col("_carried")).drop("_inside", "_carried")


def _opened(segments: Column, first: int) -> Column:
    """Opening braces and brackets less closing brackets in every second segment between quotes."""
    text = F.array_join(F.filter(segments, lambda s, i: i % 2 == first), "")
    return F.length(F.translate(text, "]", "")) - F.length(F.translate(text, "{[", ""))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, number, document, element, malformed): the objects of the files, in order.

    `element` tells members of a list or an envelope from objects that stand alone.
    """
    pieces = _pieces(spark, path)
    plain = F.regexp_replace("piece", r"\\.", "")  # without escaped quotes
    segments = F.split(plain, '"')
    pieces = materialized(pieces.repartition("file", "block").select(
        "*", (F.size(segments) - 1).alias("quotes"), _opened(segments, 0).alias("opened_even"), _opened(segments, 1).alias("opened_odd")), "json-pieces")
    bytes_read = F.sum(F.octet_length("piece") + 1)
    end = pieces.groupBy("file").agg(
        F.max_by("at", F.struct("block", "at")).alias("_last"), F.min_by("piece", F.struct("block", "at")).alias("_head"),
        (bytes_read > F.max("file_size")).alias("_open"))  # the last piece has no brace behind it
    shape = end.select("file", F.when(F.col("_open"), F.col("_last")).alias("_last"), F.when(F.rlike("_head", F.lit(ENVELOPE)), "envelope").when(
        F.rlike("_head", F.lit(r"^\s*\[")), "list").otherwise("objects").alias("shape"))
    quoted = _running(pieces, "quotes", "quotes_before").join(shape, "file")
    in_string = F.col("quotes_before") % 2 == 1
    last = F.coalesce(F.col("at") == F.col("_last"), F.lit(False))
    closed = F.when(((F.col("quotes_before") + F.col("quotes")) % 2 == 0) & ~last, 1).otherwise(0)
    deep = quoted.withColumns({"opened": F.when(in_string, F.col("opened_odd")).otherwise(F.col("opened_even")), "closed": closed})
    deep = _running(deep.withColumn("_moved", F.col("opened") - F.col("closed")), "_moved", "depth")
    outer = F.when(F.col("shape") == "envelope", 2).when(F.col("shape") == "list", 1).otherwise(0)  # depth in which documents open
    ends = (F.col("closed") == 1) & (F.col("depth") + F.col("opened") - 1 == outer)
    numbered = _running(deep.withColumn("_ends", F.when(ends, 1).otherwise(0)), "_ends", "number")
    grouped = numbered.groupBy("file", "number", "shape").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "piece"))).alias("pieces"), F.max("_ends").alias("whole"))
    text = F.concat(F.array_join(F.col("pieces.piece"), "}"), F.when(F.col("whole") == 1, "}").otherwise(""))
    first = F.col("number") == 0
    bare = F.when(first & (F.col("shape") == "envelope"), F.regexp_replace(text, ENVELOPE, "")).when(
        first & (F.col("shape") == "list"), F.regexp_replace(text, r"^\s*\[", "")).otherwise(text)
    # what stands before a document's brace, or is left behind the last one
    before = F.when(F.col("whole") == 1, F.regexp_extract(bare, r"^[^{]*", 0)).otherwise(bare)
    document = F.when(F.col("whole") == 1, F.substring(bare, F.length(before) + 1, F.length(bare)))
    tail = F.when(F.col("whole") == 1, before).otherwise(F.regexp_replace(
        before, F.when(F.col("shape") == "envelope", F.lit(r"(?s)\].*$")).otherwise(F.lit(r"\]\s*$")), ""))
    left = F.filter(F.transform(F.split(tail, ","), lambda t: F.trim(F.regexp_replace(t, r"\s+", " "))), lambda t: t != "")
    broken = F.when((F.col("whole") == 0) & F.contains(tail, F.lit("{")), F.array(F.lit(BROKEN))).otherwise(
        F.transform(left, lambda t: F.lit(NOT_AN_OBJECT)))
    element = (F.col("shape") != "objects").alias("element")
    found = grouped.select("file", "number", document.alias("document"), element, broken.alias("_broken"))
    whole = found.filter("document is not null").select("file", "number", "document", "element", F.lit(None).cast("string").alias("malformed"))
    rest = found.select("file", "number", F.lit(None).cast("string").alias("document"), "element", F.explode("_broken").alias("malformed"))
    return whole.unionByName(rest)


def land_documents(spark: SparkSession, path: str, target: str) -> DataFrame:
    """The documents as text files of one document per line, which every later read splits; returns the table.

    Line breaks inside a document are layout, as JSON strings hold none.
    """
    lines = documents(spark, path).filter("document is not null").select(F.regexp_replace("document", r"[\r\n]+", " ").alias("value"))
    lines.write.mode("overwrite").text(target)
    return spark.read.text(target)
