"""Elements of large JSON-array files, read by byte ranges: no row and no task holds a file.

A file is read as text that ends at each closing brace, which Spark splits at
any byte. Whether a brace is structure or part of a string, and how deep it
lies, depends on all text before it; that state is carried between splits:

1. Each segment tells how many quotes it holds (escapes aside) and, for both
   cases of beginning inside a string or not, how its brackets change the depth.
   Numbers of preceding quotes within the split turn the two cases per segment
   into two per split.
2. A table of one row per split composes these in file order: whether the split
   begins inside a string, and at what depth.
3. With the true state each segment knows its depth; a brace that returns to
   the array's own depth ends an element. Ends are counted per split and summed
   over the splits before, which numbers the elements across splits.
4. The segments of an element are joined: an element is the largest thing that
   one row holds.

Elements must be objects, as records are. A file that is no array, is cut off,
or holds another kind of element fails the job, before anything is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import apply_required_conf, work_folder

NOT_AN_ARRAY = "JSON file is not an array of objects"
SPLIT = ("file", "block")
QUOTE = '"'


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _segments(spark: SparkSession, path: str, split_bytes: int | None) -> DataFrame:
    """Text up to each closing brace, where it lies, its quotes, and its change of depth by beginning outside or inside a string."""
    reader = spark.newSession()
    apply_required_conf(reader)
    if split_bytes is not None:
        reader.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        reader.conf.set("spark.sql.files.openCostInBytes", str(split_bytes))
    lines = reader.read.option("lineSep", "}").text(path)
    # no escape spans a segment: a backslash never stands before a brace
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    raw = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), "value", plain.alias("plain")
    )
    change = []
    for begin in ("", QUOTE):
        outside = F.regexp_replace(F.concat(F.lit(begin), F.col("plain")), r'(?s)"[^"]*("|$)', "")
        change.append(_count(outside, "{") + _count(outside, "[") - _count(outside, "]"))
    quotes = _count(F.col("plain"), QUOTE)
    return raw.select(*SPLIT, "seq", "value", (quotes % 2).alias("odd"), *[c.alias(f"change{i}") for i, c in enumerate(change)])


def read_array_elements(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """``payload``: the text of each element of the JSON-array files at ``path``, as it is spelt there.

    ``split_bytes`` sets the bytes of a split (default: the session's). The
    segments are written once, below ``spark.checkpoint.dir``.
    """
    folder = work_folder(spark, "json-array")
    inside = Window.partitionBy(*SPLIT).orderBy("seq")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    segments = _segments(spark, path, split_bytes)
    flipped = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2  # quotes before it in its split
    segments = segments.withColumn("flipped", flipped)
    # a split that begins inside a string swaps the two cases; the brace after a segment counts if it is outside
    for start in (0, 1):
        begins = (F.col("flipped") + start) % 2
        brace = F.when((begins + F.col("odd")) % 2 == 0, 1).otherwise(0)
        segments = segments.withColumn(f"step{start}", F.when(begins == 0, F.col("change0")).otherwise(F.col("change1")) - brace)
    segments.drop("change0", "change1").write.parquet(folder)
    segments = spark.read.parquet(folder)

    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = segments.groupBy(*SPLIT).agg((F.sum("odd") % 2).alias("odd"), F.sum("step0").alias("step0"), F.sum("step1").alias("step1"))
    splits = splits.withColumn("start", F.coalesce(F.sum("odd").over(order), F.lit(0)) % 2)
    step = F.when(F.col("start") == 0, F.col("step0")).otherwise(F.col("step1"))
    # at the end of a file the array is closed, and the text after its last brace was counted as one more
    closed = F.sum(step).over(Window.partitionBy("file")) == -1
    depth = F.when(closed, F.coalesce(F.sum(step).over(order), F.lit(0))).otherwise(F.raise_error(F.lit(NOT_AN_ARRAY)))
    splits = splits.select(*SPLIT, "start", depth.alias("depth"))

    known = segments.join(splits, list(SPLIT))
    known = known.withColumn("step", F.when(F.col("start") == 0, F.col("step0")).otherwise(F.col("step1")))
    after = F.col("depth") + F.sum("step").over(inside)
    outside = (F.col("start") + F.col("flipped") + F.col("odd")) % 2 == 0
    known = known.select(*SPLIT, "seq", "value", (outside & (after == 1)).cast("int").alias("ends"))
    ended = known.groupBy(*SPLIT).agg(F.sum("ends").alias("n")).select(*SPLIT, F.coalesce(F.sum("n").over(order), F.lit(0)).alias("ended"))
    numbered = known.join(ended, list(SPLIT))
    number = F.col("ended") + F.coalesce(F.sum("ends").over(before), F.lit(0))
    numbered = numbered.select("file", number.alias("number"), "ends", F.struct("block", "seq", "value").alias("part"))

    elements = numbered.groupBy("file", "number").agg(F.max("ends").alias("whole"), F.array_sort(F.collect_list("part")).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "}")
    # An element follows the array's bracket (the first one) or a comma; what is left at the end must be the closing bracket.
    lead = F.when(F.col("number") == 0, F.lit(r"^\s*\[\s*\{")).otherwise(F.lit(r"^\s*,\s*\{"))
    tail = F.when(F.col("number") == 0, F.lit(r"^\s*\[\s*\]\s*$")).otherwise(F.lit(r"^\s*\]\s*$"))
    elements = elements.select("number", (F.col("whole") == 1).alias("whole"), joined.alias("text"))
    sound = F.when(F.col("whole"), F.regexp(F.col("text"), lead)).otherwise(F.regexp(F.col("text"), tail))
    checked = F.when(~F.coalesce(sound, F.lit(False)), F.raise_error(F.lit(NOT_AN_ARRAY))).when(
        F.col("whole"), F.array(F.concat(F.regexp_replace("text", r"^\s*[,\[]\s*", ""), F.lit("}")))
    ).otherwise(F.array().cast("array<string>"))
    return elements.select(F.explode(checked).alias("payload"))
