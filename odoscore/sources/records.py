"""CSV records out of lines, where a quoted field may hold line breaks and files are read in splits.

A reader of one split does not know whether it starts inside a quoted field.  So every line is a function of that
answer: it tells whether a field is open behind the line if none was open before it, and if one was.  Such functions compose,
within a split and then over the splits of a file, and the start of the file is known.  Only files in which some line
leaves a field open take this way; in all others every line is a record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUOTE = '"'
#: Options under which a record's text is parsed: quotes inside quotes are doubled, line breaks are kept.
CSV_OPTIONS = {"escape": QUOTE, "multiLine": "true"}
_SPLIT = ["file_name", "split_start"]


def open_after(line: Column | str, inside: bool) -> Column:
    """Whether a quoted field is open behind a line; ``inside`` tells whether one was open before it.

    A quote opens a field only as its first character.  In a quoted field two quotes are one character and a single one closes it;
    what follows up to the next comma is taken as it stands.
    """
    line = F.col(line) if isinstance(line, str) else line

    def behind(is_open: Column, piece: Column) -> Column:
        quoted = F.when(is_open, piece).when(F.startswith(piece, F.lit(QUOTE)), F.substr(piece, F.lit(2)))
        return F.when(quoted.isNull(), False).otherwise(~F.contains(F.replace(quoted, F.lit(QUOTE * 2), F.lit("")), F.lit(QUOTE)))

    counted = F.aggregate(F.split(line, ","), F.lit(inside), behind)
    return F.when(F.contains(line, F.lit(QUOTE)), counted).otherwise(F.lit(inside))


def split_lines(raw: DataFrame, value: str = "value") -> DataFrame:
    """Rows split at line feeds -> one row per line, with the characters that end it (``ending``).

    A carriage return ends a line as well, alone or before the line feed.
    """
    text = F.col(value)
    returned = F.endswith(text, F.lit("\r"))
    body = F.when(returned, F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    pieces = F.when(F.contains(body, F.lit("\r")), F.split(body, "(?<=\r)")).otherwise(F.array(body))
    others = [c for c in raw.columns if c != value]
    lines = raw.select(*others, returned.alias("_crlf"), F.explode(pieces).alias("_piece"))
    inner = F.endswith("_piece", F.lit("\r"))
    return lines.select(
        *others,
        F.when(inner, F.substr("_piece", F.lit(1), F.length("_piece") - 1)).otherwise(F.col("_piece")).alias(value),
        F.when(inner, "\r").when(F.col("_crlf"), "\r\n").otherwise("\n").alias("ending"),
    )


def _state(anchor: Column, flips: Column, before: Column) -> Column:
    """Open or not, behind functions whose last constant was ``anchor`` (null: none) with that parity of ``flips`` since."""
    return F.coalesce(anchor, before) != flips


def _composed(df: DataFrame, outside: str, inside: str, by: list[str], order: str) -> DataFrame:
    """``df`` with ``anchor`` and ``flips`` of the functions (outside, inside) up to and with each row of its group."""
    up_to = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swap = (F.col(outside) & ~F.col(inside)).cast("int")
    constant = F.col(outside) == F.col(inside)
    counted = df.withColumn("_swaps", F.sum(swap).over(up_to))
    last = F.last(F.when(constant, F.struct(F.col(outside).alias("value"), "_swaps")), ignorenulls=True).over(up_to)
    known = counted.withColumn("_last", last)
    since = F.col("_swaps") - F.coalesce(F.col("_last._swaps"), F.lit(0))
    return known.withColumn("anchor", F.col("_last.value")).withColumn("flips", since % 2 == 1).drop("_swaps", "_last")


def record_lines(lines: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(file_name, split_start, row_pos, record_split, record_pos, unclosed) of every line of files with open lines.

    A record is named by its first line.  ``unclosed`` marks the lines behind a quote that the file never closes: each is
    a record of its own, so no group is larger than a record that a well-formed file holds.
    """
    by_split = Window.partitionBy(*_SPLIT).orderBy("row_pos")
    inside = F.when(F.col("quoted"), open_after("value", True)).otherwise(F.lit(True))
    narrow = lines.select(*_SPLIT, "row_pos", F.col("opens"), inside.alias("stays"))
    behind = store(_composed(narrow, "opens", "stays", _SPLIT, "row_pos"))
    # One row per split; the file begins outside any field.
    splits = behind.groupBy(*_SPLIT).agg(F.max_by(F.struct("anchor", "flips"), "row_pos").alias("f"))
    outside = F.lit(False)
    splits = splits.select(
        *_SPLIT, _state(F.col("f.anchor"), F.col("f.flips"), outside).alias("opens"), _state(F.col("f.anchor"), F.col("f.flips"), ~outside).alias("stays")
    )
    in_file = Window.partitionBy("file_name").orderBy("split_start")
    after = _composed(splits, "opens", "stays", ["file_name"], "split_start").withColumn("after", _state(F.col("anchor"), F.col("flips"), outside))
    entry = store(after.select(*_SPLIT, F.coalesce(F.lag("after").over(in_file), outside).alias("entry"), "after"))
    before = F.lag(F.struct("anchor", "flips")).over(by_split)
    placed = behind.withColumn("_b", before).join(entry.select(*_SPLIT, "entry"), _SPLIT)
    starts = ~_state(F.col("_b.anchor"), F.coalesce(F.col("_b.flips"), outside), F.col("entry"))
    placed = placed.select(*_SPLIT, "row_pos", F.when(starts, F.col("row_pos")).alias("_start"))
    # A line that continues a record of an earlier split takes the last start before its own.
    last = placed.groupBy(*_SPLIT).agg(F.max("_start").alias("_start")).join(entry, _SPLIT)
    start = F.when(F.col("_start").isNotNull(), F.struct("split_start", F.col("_start").alias("row_pos")))
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file_name").orderBy("split_start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = store(last.select(
        *_SPLIT, F.last(start, ignorenulls=True).over(earlier).alias("_earlier"),
        F.when(F.last("after").over(whole), F.last(start, ignorenulls=True).over(whole)).alias("_unclosed"),
    ))
    own = F.struct("split_start", F.last("_start", ignorenulls=True).over(by_split.rowsBetween(Window.unboundedPreceding, 0)).alias("row_pos"))
    found = placed.withColumn("_own", own).join(last, _SPLIT)
    record = F.when(F.col("_own.row_pos").isNotNull(), F.col("_own")).otherwise(F.col("_earlier"))
    found = found.withColumn("_r", record).withColumn("unclosed", F.coalesce(F.col("_r") == F.col("_unclosed"), outside))
    place = F.when(F.col("unclosed"), F.struct("split_start", "row_pos")).otherwise(F.col("_r"))
    return found.withColumn("_r", place).select(
        *_SPLIT, "row_pos", F.col("_r.split_start").alias("record_split"), F.col("_r.row_pos").alias("record_pos"), "unclosed"
    )


def records(lines: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Lines with their position -> records (file_name, split_start, row_pos, value, unclosed), placed at their first line.

    ``lines`` are stored and have file_name, split_start, row_pos, value, ending, ``quoted`` (has a quote) and ``opens`` (leaves a
    field open if none was).  Without an open line anywhere they are the records themselves.
    """
    broken = store(lines.where("opens").select("file_name").distinct())
    plain = lines.select(*_SPLIT, "row_pos", "value", F.lit(False).alias("unclosed"))
    if broken.isEmpty():
        return plain
    some = lines.join(broken, "file_name", "left_semi")
    met = some.select(*_SPLIT, "row_pos", "value", "ending").join(record_lines(some, store), [*_SPLIT, "row_pos"])
    line = F.struct("split_start", "row_pos", "value", "ending")
    grouped = met.groupBy("file_name", "record_split", "record_pos").agg(F.array_sort(F.collect_list(line)).alias("of"), F.max("unclosed").alias("unclosed"))
    inner = F.transform(F.slice("of", 1, F.size("of") - 1), lambda x: F.concat(x["value"], x["ending"]))
    text = F.concat(F.array_join(inner, ""), F.element_at("of", -1)["value"])
    joined = grouped.select(
        "file_name", F.col("record_split").alias("split_start"), F.col("record_pos").alias("row_pos"), text.alias("value"), "unclosed"
    )
    return plain.join(broken, "file_name", "left_anti").unionByName(joined)
