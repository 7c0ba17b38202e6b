"""Raw registry files: headerless, ``;``-separated, latin1, quoted with ``"``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql.window import WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The dialect of the published files. A quote inside quotes is doubled, so the escape
# character is the quote itself; short rows are padded with nulls and long rows cut.
DIALECT = {"sep": ";", "encoding": "ISO-8859-1", "quote": '"', "escape": '"', "header": "false", "mode": "PERMISSIVE"}


def as_text(schema: StructType) -> StructType:
    """Same columns, every one read as text; typing happens afterwards, leniently."""
    return StructType([StructField(name, StringType(), True) for name in schema.names])


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime) of the input files; hidden ones are left out, contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


def located_lines(lines: DataFrame) -> DataFrame:
    """(line, file, block, place) from a batch of text lines with ``value``, ``file`` and ``block``: decoded, and in the
    order of the block."""
    text = F.decode(F.col("value").cast("binary"), DIALECT["encoding"])
    return lines.select(text.alias("line"), "file", "block", F.monotonically_increasing_id().alias("place"))


# Inside quotes; a quote there is doubled.
_INSIDE = r'(?:[^"]++|"")*+'
# Complete fields, each with its separator, then a field whose quotes stay open.
_LEAVES_OPEN = rf'(?:(?:"{_INSIDE}"[^;]*+|[^";][^;]*+|);)*+"{_INSIDE}$'
OPENS = f"^{_LEAVES_OPEN}"
STAYS_OPEN = rf'^{_INSIDE}(?:$|"[^;]*+;{_LEAVES_OPEN})'


def whole_records(lines: DataFrame) -> DataFrame:
    """(line, file, block): records put together from lines, where a quoted field may go on in the next line.

    ``lines`` comes from ``located_lines``. A line maps the state before it (a quoted field is open or not) to the state
    after it. In files without a line that opens one nothing is done. In the others, the maps are composed per block
    of the file, then over the blocks, so no task reads more than a block of lines; only the lines of broken
    records meet again.
    """
    quoted = F.contains("line", F.lit('"'))
    mapped = lines.withColumns(
        {"if_closed": quoted & F.col("line").rlike(OPENS), "if_open": ~quoted | F.col("line").rlike(STAYS_OPEN)}
    )
    # A second look at these few lines' files only. Names of files are few, as the driver lists them all. They are broadcast, so that no
    # line is shuffled by its file, and so that Spark leaves out what follows if there are none.
    affected = F.broadcast(mapped.where("if_closed").select("file").distinct())
    intact = mapped.join(affected, "file", "left_anti").select("line", "file", "block")
    doubtful = mapped.join(affected, "file", "left_semi")

    within = Window.partitionBy("file", "block").orderBy("place")
    ending = _composed(doubtful, within.rowsBetween(Window.unboundedPreceding, 0))
    last = ending.groupBy("file", "block").agg(F.max(F.struct("place", "if_closed", "if_open")).alias("last"))
    blocks = last.select("file", "block", "last.if_closed", "last.if_open")
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    entered = _composed(blocks, above).select("file", "block", F.col("if_closed").alias("entered_open"))

    own_maps = doubtful.withColumns({"own_closed": F.col("if_closed"), "own_open": F.col("if_open")})
    before = _composed(own_maps, within.rowsBetween(Window.unboundedPreceding, -1)).join(entered, ["file", "block"])
    is_open = F.when(F.col("entered_open"), F.col("if_open")).otherwise(F.col("if_closed"))
    placed = before.withColumn("open_before", is_open).withColumn(
        "open_after", F.when(F.col("open_before"), F.col("own_open")).otherwise(F.col("own_closed"))
    )
    broken = F.col("open_before") | F.col("open_after")
    # records are told apart by the number of records that end before them, per block, then over the blocks
    ended = (~F.col("open_after")).cast("long")
    ends = placed.groupBy("file", "block").agg(F.sum(ended).alias("ends"))
    offsets = ends.select("file", "block", F.coalesce(F.sum("ends").over(above), F.lit(0)).alias("offset"))
    own = F.coalesce(F.sum(ended).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.withColumn("own", own).where(broken).join(offsets, ["file", "block"])
    in_order = F.array_sort(F.collect_list(F.struct("block", "place", "line")))
    joined = numbered.groupBy("file", (F.col("own") + F.col("offset")).alias("record")).agg(
        F.array_join(F.transform(in_order, lambda x: x["line"]), "\n").alias("line"), F.min("block").alias("block")
    )
    columns = ["line", "file", "block"]
    return intact.unionByName(placed.where(~broken).select(*columns)).unionByName(joined.select(*columns))


def _composed(rows: DataFrame, window: WindowSpec) -> DataFrame:
    """``if_closed`` and ``if_open`` of all rows of the window together, each row being such a map.

    A map that gives one state either way settles it; those after the last such one keep or turn it."""
    order = F.row_number().over(Window.partitionBy(*_keys(rows)).orderBy(_place(rows)))
    turns = (F.col("if_closed") & ~F.col("if_open")).cast("long")
    so_far = F.sum(turns).over(Window.partitionBy(*_keys(rows)).orderBy(_place(rows)))
    with_turns = rows.withColumns({"_n": order, "_turns": so_far})
    settled = F.when(F.col("if_closed") == F.col("if_open"), F.struct("_n", F.col("if_closed").alias("state"), "_turns"))
    found = with_turns.withColumns(
        {"_last": F.last(settled, ignorenulls=True).over(window), "_all": F.coalesce(F.max("_turns").over(window), F.lit(0))}
    )
    odd = (F.col("_all") - F.coalesce("_last._turns", F.lit(0))) % 2 == 1
    closed = F.coalesce("_last.state", F.lit(False))
    opened = F.coalesce("_last.state", F.lit(True))
    return found.withColumns({"if_closed": closed != odd, "if_open": opened != odd}).drop("_n", "_turns", "_last", "_all")


def _keys(rows: DataFrame) -> list[str]:
    return ["file", "block"] if "place" in rows.columns else ["file"]


def _place(rows: DataFrame) -> str:
    return "place" if "place" in rows.columns else "block"


def text_lines(reader, path: str) -> DataFrame:
    """Raw lines with the file and block they lie in, for a batch or stream reader."""
    return reader.format("text").load(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def read_raw(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All fields as text. Files are read in splits whether or not quoted fields hold line breaks."""
    return parse_lines(whole_records(located_lines(text_lines(spark.read, path))), "line", schema)


# A field in quotes, with what follows it up to the next separator.
_QUOTED_FIELD = rf'(^|;)"{_INSIDE}"[^;]*+'
OK = "ok"


def fault_of(line: Column, fields: int) -> Column:
    """Why a record does not fit a table of so many columns: ``empty``, ``unclosed``, ``short`` or ``long``; ``ok`` if it does."""
    plain = F.regexp_replace(line, _QUOTED_FIELD, "$1")
    found = F.length(plain) - F.length(F.replace(plain, F.lit(";"))) + 1
    return (
        F.when(F.trim(line) == "", "empty").when(line.rlike(OPENS), "unclosed").when(found < fields, "short")
        .when(found > fields, "long").otherwise(OK)
    )


def read_judged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All fields as text, with ``reason``, and ``file``, ``block`` and ``line`` for the records that do not fit."""
    records = whole_records(located_lines(text_lines(spark.read, path)))
    judged = records.withColumn("reason", fault_of(F.col("line"), len(schema)))
    parsed = judged.withColumn("r", F.from_csv("line", _all_text(schema), _line_options()))
    bad = F.col("reason") != OK
    return parsed.select("r.*", "reason", *[F.when(bad, F.col(c)).alias(c) for c in ("file", "block", "line")])


def _line_options() -> dict[str, str]:
    return {k: v for k, v in DIALECT.items() if k not in ("header", "encoding")}


def _all_text(schema: StructType) -> str:
    return ", ".join(f"{name} string" for name in schema.names)


def parse_lines(df: DataFrame, line: str, schema: StructType) -> DataFrame:
    """The same dialect applied to a text column, for lines that are already in a table."""
    return df.select(F.from_csv(line, _all_text(schema), _line_options()).alias("r")).select("r.*")


def file_category(name: Column) -> Column:
    """Table a file belongs to: its name without extension and without trailing digits."""
    stem = F.regexp_replace(name, r"(.)\.[^.]*$", "$1")
    return F.regexp_replace(stem, r"\d+$", "")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)
