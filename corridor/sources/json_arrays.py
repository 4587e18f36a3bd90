"""Elements of large JSON arrays, cut out by many tasks whatever the layout of the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corridor.session import settle

# pieces are put in order within blocks of 2 to this power
BLOCK_BITS = 16


def _depth_change(text: Column) -> Column:
    """Opening less closing brackets."""
    return F.length(F.translate(text, "]}", "")) - F.length(F.translate(text, "[{", ""))


def _running(column: str, block: Window) -> Column:
    return F.sum(column).over(block.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, element, text): the objects of the array each file holds, numbered from 0 in their order.

    Files are read in pieces that end with a closing brace, so an uncompressed file is split between
    tasks even if it is one line; a compressed one is unpacked by one task and spread after that. A
    piece may begin inside a string. What it adds to the depth is counted for both cases; sums over
    the pieces before it then tell how many quotes stand before it, how deep it lies, and how many
    elements have ended. Sums run within blocks of pieces and over one row for each block.

    The array must hold objects; numbers, nulls and lists of them between the objects are left out.
    A file that begins with anything but a bracket fails, an empty one has no elements. The last element of a file cut off in the middle
    comes out as far as it goes. An element is put together by one task and must fit there.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    # an escape never reaches over the end of a piece: no string escapes a brace
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    string, rest_of_string = r'"[^"]*("|$)', r'^[^"]*("|$)'
    pieces = pieces.withColumn("block", F.shiftright("row", BLOCK_BITS)).withColumns(
        {
            "quotes": F.length(bare) - F.length(F.translate(bare, '"', "")),
            "plain": _depth_change(F.regexp_replace(bare, string, "")),
            "quoted": _depth_change(F.regexp_replace(F.regexp_replace(bare, rest_of_string, ""), string, "")),
        }
    )
    keys = ["file", "split", "block"]
    inside = Window.partitionBy(*keys).orderBy("row")
    # per piece, for a block that begins outside (0) or inside (1) a string: whether the piece's own
    # brace counts, and the depth after it
    pieces = pieces.withColumn("after", _running("quotes", inside) % 2)
    even_before = (F.col("after") + F.col("quotes")) % 2 == 0
    for case, (first, second) in enumerate((("plain", "quoted"), ("quoted", "plain"))):
        change = F.when(even_before, F.col(first)).otherwise(F.col(second))
        pieces = pieces.withColumn(f"change{case}", change - (F.col("after") == case).cast("int"))
    for case in (0, 1):
        pieces = pieces.withColumn(f"depth{case}", _running(f"change{case}", inside))
    pieces = settle(pieces.drop("quotes", "plain", "quoted"), "json_pieces")

    # one row for each block, so a window over a file's blocks is small
    in_file = Window.partitionBy("file").orderBy("split", "block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy(*keys).agg(
        F.max_by("after", "row").alias("quotes"),
        F.sum("change0").alias("change0"),
        F.sum("change1").alias("change1"),
        F.max("row").alias("last"),
        F.min_by(F.regexp_extract("value", r"^[\s\x{FEFF}]*(\S?)", 1), "row").alias("head"),
    )
    blocks = blocks.withColumn("case", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    blocks = blocks.withColumn("change", F.when(F.col("case") == 0, F.col("change0")).otherwise(F.col("change1")))
    no_array = (F.row_number().over(in_file) == 1) & ~F.col("head").isin("[", "")
    wrong = F.raise_error(F.concat(F.lit("not a JSON array: "), F.col("file"))).cast("bigint")
    blocks = blocks.select(
        *keys,
        "case",
        F.when(no_array, wrong).otherwise(F.coalesce(F.sum("change").over(before), F.lit(0))).alias("deep"),
        # the text after the last brace of a file has none of its own
        F.when(F.row_number().over(Window.partitionBy("file").orderBy(F.desc("split"), F.desc("block"))) == 1, F.col("last"))
        .otherwise(-1).alias("last"),
    )
    blocks = settle(blocks, "json_blocks")

    depth = F.col("deep") + F.when(F.col("case") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    ends = (F.col("after") == F.col("case")) & (depth == 1) & (F.col("row") != F.col("last"))
    placed = pieces.join(blocks, keys).select(*keys, "row", "value", ends.cast("int").alias("ends"))
    ended = placed.groupBy(*keys).agg(F.sum("ends").alias("n"))
    ended = settle(ended.select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("done")), "json_ends")
    numbered = placed.withColumn("number", _running("ends", inside) - F.col("ends")).join(ended, keys)
    whole = numbered.groupBy("file", (F.col("done") + F.col("number")).alias("element")).agg(
        F.sort_array(F.collect_list(F.struct("split", "row", "value")))["value"].alias("parts"),
        F.max("ends").alias("ends"),
    )
    joined = F.concat(F.array_join("parts", "}"), F.when(F.col("ends") == 1, "}").otherwise(""))
    text = F.regexp_replace(joined, r"^[^{]+", "")
    return whole.select("file", "element", text.alias("text")).filter("text <> ''")


def documents(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """The elements under a schema; fields of an element that cannot be parsed are NULL."""
    return elements(spark, path).select(F.from_json("text", schema).alias("document")).select("document.*")
