"""Mixing sources to target weights.

Every row gets a hash-random key.  Rows are ranged by key within their source; prefix sums of sizes come from
sums of key cells, so a source that holds a third of all rows is spread over as many tasks as its rows ask
for.  Each source is taken in whole epochs and then cut at its exact budget, inside a row if need be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, set_aside, stored, without, word_count

#: 48 bits of an MD5 as a number.
_KEY_HEX = 12
ADDED = ["size", "source_size", "target", "taken"]


def random_key(id_col: str, seed: int) -> Column:
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    return F.substring(F.md5(named.cast("binary")), 1, _KEY_HEX)


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(source, source_size, rows) -> the same with ``no``, ``weight`` and ``target``.

    Sources in code-point order, null last, weigh ``weights``, repeating.  A target stops at ``most`` times its
    source's size, and the excess goes to the others by weight: there is one level so that every target is
    min(cap, level * weight).  It is found where the sources, by cap per weight, first fit under it.
    The windows see one row per source.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("no", F.row_number().over(rank))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("no") - 1) % len(weights) + 1).cast("int"))
    capped = named.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * most)
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "no")
    below, above = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(below), F.lit(0))) / F.sum("weight").over(above)
    levelled = capped.withColumn("level", level).withColumn("at", F.row_number().over(filling))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("at"))
    chosen = F.min_by("level", fits).over(whole)
    return levelled.select(
        "source", "source_size", "rows", "no", "weight",
        F.least(F.col("cap").cast("double"), chosen * F.col("weight")).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    size_col: str = "size",
    id_col: str = "doc_id",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    seed: int = 0,
    rows_per_cell: int = 4_000,
) -> DataFrame:
    """``docs`` (with ``source``) plus ``source_size``, ``target`` and ``taken`` (of the row, repeats counted).

    A null size counts as 0.  A source whose sizes are all 0 takes nothing.  Rows with one id keep the order
    of their size; rows equal in id and size are alike to the cut.  Null is a source of its own.
    An empty table gives an empty result.  Input columns with the names of added ones are replaced.
    """
    docs = without(docs, [n for n in ADDED if n != size_col])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    sized = F.coalesce(F.col(size_col), F.lit(0)).cast("long")
    keyed = stored(docs.withColumn(size_col, sized).withColumn("__key", random_key(id_col, seed)))
    sizes = keyed.groupBy("source").agg(F.sum(size_col).alias("source_size"), F.count("*").alias("rows"))
    plan = stored(targets(sizes, weights, most)).withColumn("__cells", F.ceil(F.col("rows") / rows_per_cell))
    budget = F.floor(F.col("target"))
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = plan.select(
        F.col("source").alias("__source"), "source_size", "target", F.col("no").alias("__no"), "__cells",
        whole.alias("__epochs"), (budget - whole * F.col("source_size")).alias("__rest"),
    )
    share = F.conv("__key", 16, 10).cast("double") / float(16**_KEY_HEX)
    rows = keyed.join(plan, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rows = rows.withColumn("__cell", F.floor(share * F.col("__cells")))
    place = ["__no", "__cell"]
    ahead = Window.partitionBy("__no").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*place).agg(F.sum(size_col).alias("__sum"))
    sums = sums.select(*place, F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__ahead"))
    within = Window.partitionBy(*place).orderBy("__key", F.col(f"`{id_col}`"), size_col)
    before = F.sum(size_col).over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col(size_col)
    cut = F.greatest(F.lit(0), F.least(F.col(size_col), F.col("__rest") - F.col("__ahead") - F.col("__before")))
    return (
        rows.withColumn("__before", before).join(sums, place)
        .select(*columns, "source_size", "target", (F.col("__epochs") * F.col(size_col) + cut).cast("long").alias("taken"))
    )


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words of a text with the white space between them."""
    pieces = F.slice(F.regexp_extract_all(text, F.lit(f"(?:{WORD}|[\\x20\\x09-\\x0D]+)"), F.lit(0)), F.lit(1), n * 2)
    return F.trim(F.array_join(pieces, ""))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, whole ones as often as they are taken, and cut ones as their first words.

    Sizes are words.  ``n_chars``, if there, follows a cut text.
    """
    held, restore = set_aside(docs, ADDED)
    mixed = mix_sources(held.withColumn("__size", word_count("text")), size_col="__size", **options)
    whole = F.when(F.col("__size") > 0, F.floor(F.col("taken") / F.col("__size"))).otherwise(F.lit(0)).cast("int")
    part = F.when(F.col("__size") > 0, F.col("taken") % F.col("__size")).otherwise(F.lit(0)).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    rows = mixed.withColumn("__part", F.explode(copies))
    cut = F.col("__part") > 0
    rows = rows.withColumn("text", F.when(cut, first_words(F.col("text"), F.col("__part"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return restore(rows)
