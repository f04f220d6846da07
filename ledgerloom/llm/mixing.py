"""Mixing sources to target weights along a time-varying curriculum.

Each source has a share of all words (its *target*) and a schedule: a
piecewise-linear weight over training time 0..1.  A source's demand up to time
t is its target times the integral of its weight up to t over the whole
integral.  Its documents, in a fixed shuffled order, supply that demand one
after the other and start again when all are used; the document that supplies
word number c is trained at the time t at which the source's demand reaches c,
that is, at the inverse of the cumulative demand.  Sorting all copies by that
time (a range sort) gives the training order: at every time the sources appear
at the rates that their schedules ask for, and in total each gives its target.

Everything is joins, aggregates and windows.  The running sum of sizes within a
source goes in two steps (sums per source and hash bucket, then within a
bucket), so a source with a third of all rows is spread over 4,096 groups.

Defined cases: null or empty text has size 0 and takes 0 words; a null source is
a source of its own, ordered last; documents of one source are ordered by
md5(doc_id), then doc_id, then md5(text), and rows equal in all of these are
interchangeable; extra columns are kept by ``mix`` and ignored by
``allocation``; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import GAP, WORD, id_text, store

BASE_WEIGHTS = (5, 2, 1)
REPEATS = 3                     # a source gives at most this many times its words
#: Weight at times 0, 1/2 and 1 of the sources of each base weight: the heavy ones fade, the light ones come late.
KNOTS = {5: (1.5, 1.0, 0.5), 2: (1.0, 1.0, 1.0), 1: (0.5, 1.0, 1.5)}


def sized(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Per row: doc_id, source, size and the keys of the fixed order; with ``carry`` the whole row too."""
    text = F.col("text").cast("string")
    place = F.md5(id_text(F.col("doc_id")).cast("binary"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source_key"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        # The order within a source is that of the hex digits, so their first three name a bucket.
        place.alias("place"), F.substring(place, 1, 3).alias("bucket"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("text_md5"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))


def targets(sizes: DataFrame, weights: tuple = BASE_WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Per source: source_key, weight, source_size, target.

    Water filling: with sources by rising ratio of cap to weight, the first k
    stop at their caps, where k is the number of sources whose cap is below the
    share that the rest of the words leaves them.  One row per source goes
    through the windows, whatever the number of documents.
    """
    total = sizes.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = total.select("*", weight.alias("weight"), (F.col("source_size") * repeats).alias("cap"))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    here = rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = ranked.select(
        "*", F.sum("source_size").over(every).alias("words"), F.sum("weight").over(every).alias("weight_sum"),
        (F.sum("cap").over(here) - F.col("cap")).alias("caps_before"),
        (F.sum("weight").over(here) - F.col("weight")).alias("weight_before"))
    # If the sources before this one stop at their caps, a unit of weight gets this much from here on.
    unit = (F.col("words") - F.col("caps_before")).cast("double") / (F.col("weight_sum") - F.col("weight_before"))
    stops = F.col("cap").cast("double") <= unit * F.col("weight")
    filled = level.select("*", unit.alias("unit"), stops.alias("stops"))
    final_unit = F.min(F.when(~F.col("stops"), F.struct(F.col("caps_before"), F.col("unit")))).over(every)["unit"]
    return filled.select("source_key", "weight", "source_size",
                         F.when(F.col("stops"), F.col("cap").cast("double"))
                         .otherwise(final_unit * F.col("weight")).alias("target"))


def demand_time(share: Column, knots: Column) -> Column:
    """The time at which ``share`` (0..1) of a source's demand is reached.

    ``knots`` holds the weights at 0, 1/2 and 1; on each half the demand is a
    quadratic, inverted in the form that also holds for a constant weight.
    """
    a, b, c = (F.element_at(knots, i) for i in (1, 2, 3))
    first, second = (a + b) / 4, (b + c) / 4
    need = share * (first + second)

    def within(need: Column, start: Column, end: Column) -> Column:
        root = F.sqrt(F.greatest(start * start + (end - start) * F.lit(4.0) * need, F.lit(0.0)))
        return F.when(need <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * need / (start + root))

    return F.when(need <= first, within(need, a, b)).otherwise(F.lit(0.5) + within(need - first, b, c))


def placed(sizes: DataFrame, rows: DataFrame, weights: tuple, repeats: int, knots: dict) -> DataFrame:
    """``rows`` with weight, source_size, target, offset, number (in source and bucket) and the words that each copy gives (``copies``).

    ``offset`` is the number of the source's words before the row's first copy.
    Copy k starts at offset + k * source_size; the copy at which the target is
    reached is cut there, so a source's taken words are its target, rounded.
    """
    plan = targets(sizes, weights, repeats)
    sums = sizes.groupBy("source_key", "bucket").agg(F.sum("size").alias("bucket_size"))
    upto = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sums.select("source_key", "bucket", (F.sum("bucket_size").over(upto) - F.col("bucket_size")).alias("before"))
    starts = starts.join(plan, "source_key")
    fixed = Window.partitionBy("source_key", "bucket").orderBy("place", "doc_id", "text_md5")
    inside = fixed.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offset = F.col("before") + F.sum("size").over(inside) - F.col("size")
    goal = F.round("target").cast("long")
    copy = lambda k: F.greatest(F.lit(0).cast("long"), F.least(
        F.col("size"), goal - F.col("source_size") * k - F.col("offset")))
    return rows.join(starts, ["source_key", "bucket"]).withColumns({"offset": offset, "number": F.row_number().over(fixed)}).withColumn(
        "copies", F.array(*[copy(k) for k in range(repeats)]))


def position(offset: Column, knots: dict) -> Column:
    curves = F.coalesce(*[F.when(F.col("weight") == float(w), F.array(*[F.lit(float(x)) for x in v])) for w, v in knots.items()])
    return demand_time(F.least(F.lit(1.0), offset.cast("double") / F.col("target")), curves)


def copied(rows: DataFrame, knots: dict, *keep: str) -> DataFrame:
    """One row per copy: ``keep``, source_size, target, place, copy, words and position, its time (null where it gives no words)."""
    each = rows.select(*keep, "source_size", "target", "weight", "offset", "place", F.posexplode("copies").alias("copy", "words"))
    at = position(F.col("offset") + F.col("copy") * F.col("source_size"), knots)
    return each.withColumn("position", F.when(F.col("words") > 0, at)).drop("weight", "offset")


def allocation(docs: DataFrame, weights: tuple = BASE_WEIGHTS, repeats: int = REPEATS, knots: dict = KNOTS) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken, position (of its first copy; null if none is taken).

    All taken copies are range-sorted by their time, as ``mix`` sorts its rows; a document's taken words are
    those of its copies in that order, and documents come in the order of their first ones, those without last.
    """
    sizes = store(sized(docs), "mix-sizes")
    document = ["source_key", "bucket", "number", "doc_id", "source", "size"]
    each = copied(placed(sizes, sizes, weights, repeats, knots), knots, *document, "text_md5").filter("words > 0 OR copy = 0")
    order = each.orderBy(F.col("position").asc_nulls_last(), "place", "copy", "doc_id", "text_md5")
    # A copy's place in the order.
    order = order.withColumn("at", F.monotonically_increasing_id())
    found = order.groupBy(*document, "source_size", "target").agg(
        F.sum("words").alias("taken"), F.min("position").alias("position"), F.min("at").alias("at"))
    return found.orderBy("at").select("doc_id", "source", "size", "source_size", "target", "taken", "position")


def first_words(text: Column, n: Column) -> Column:
    """The text up to its ``n``-th word's end."""
    pieces = n + F.when(text.rlike("^" + GAP), 2).otherwise(1)
    rest = F.element_at(F.split(text, GAP, pieces.cast("int")), pieces.cast("int"))
    return F.rtrim(F.substring(text, F.lit(1), F.length(text) - F.length(rest)))


def mix(docs: DataFrame, weights: tuple = BASE_WEIGHTS, repeats: int = REPEATS, knots: dict = KNOTS) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, one row per taken copy, sorted by training time."""
    rows = placed(sized(docs), sized(docs, carry=True), weights, repeats, knots)
    each = copied(rows, knots, "row", "size").filter("words > 0").drop("source_size", "target")
    cut = F.col("words") < F.col("size")
    text = F.when(cut, first_words(F.col("row")["text"], F.col("words"))).otherwise(F.col("row")["text"])
    each = each.withColumn("text", text)
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(cut, F.length("text").cast(kind)).otherwise(F.col("row")["n_chars"])
    return each.orderBy("position", "place", "copy").select(
        *[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
