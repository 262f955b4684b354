"""Mixing sources to target weights by hash thresholds, found with histograms instead of a sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll import session
from tillroll.llm.tables import words

#: The hash of a document has 36 bits, read as LEVELS digits of DIGIT bits each.
DIGIT, LEVELS = 12, 3


def ranked_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, ..., ``cycle``, repeating, over the sources by code point, null last.

    ``sources`` has one row per source, so the window holds as many rows as there are sources.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return sources.select("source", ((place - 1) % cycle + 1).cast("bigint").alias("weight"))


def targets(sizes: DataFrame, most: int = 3) -> DataFrame:
    """Target size per source: shares of the whole by weight, none above ``most`` times its source.

    ``sizes`` has one row per source: source, weight, source_size. What a capped source cannot
    take is shared by weight among the others until none is above its cap. Then all capped
    sources have a lower size per weight than the others, so one pass over the sources in that
    order finds them. Sums are of integers; only the last division is rounded.
    """
    everything = Window.partitionBy()
    by_ratio = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    so_far = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cap = F.col("source_size") * most
    total = F.sum("source_size").over(everything)
    rest = total - (F.sum(cap).over(so_far) - cap)
    weight = F.sum("weight").over(everything) - (F.sum("weight").over(so_far) - F.col("weight"))
    tried = sizes.select("*", cap.alias("cap"), rest.alias("rest"), weight.alias("rest_weight"))
    # A source is capped if its share of what the sources before it leave is above its cap.
    capped = F.col("rest") * F.col("weight") > F.col("cap") * F.col("rest_weight")
    tried = tried.withColumn("free", F.when(~capped, F.struct("rest", "rest_weight")))
    first_free = F.first("free", ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    share = F.col("weight") * first_free["rest"].cast("double") / first_free["rest_weight"]
    return tried.select(
        "source", "weight", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(share).alias("target")
    )


def mix(docs: DataFrame, weights: DataFrame | None = None, most: int = 3, id_col: str = "doc_id") -> DataFrame:
    """How many words of each document a mix with the given source weights takes.

    ``docs`` has an id, text and source; ``weights`` has source and weight (positive; a source
    without one is left out), by default ``ranked_weights``. Returns one row per document:
    doc_id, source, size, source_size, target, taken.

    A source whose target is above its size is taken whole as often as fits; the rest of the
    target goes to the documents with the lowest hashes. The threshold comes from histograms:
    words are summed by source and first hash digit, the digit in which the budget ends is
    looked into by the next digit, and so on, and the documents of the last one are taken if
    that comes nearer to the target. Thresholds are nested: a larger budget takes what a
    smaller one took. Null texts and texts without words have size 0 and take 0. Rows that
    share an id share its hash; rows without one have a hash of their text. Hot sources are
    summed before they are shuffled.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), *_measured(id_col))
    rows = session.staged(rows, "mixing-sizes")
    plan = _plan(rows, weights, most).withColumnRenamed("source", "p_source")
    return rows.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * _times()).alias("taken")
    )


def _measured(id_col: str) -> list[Column]:
    """source, size and h of a row of documents."""
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.coalesce(F.col("text"), F.lit(""))))
    digits = F.conv(F.substring(F.md5(key), 1, 9), 16, 10)
    return [F.col("source"), words(F.col("text")).alias("size"), digits.cast("bigint").alias("h")]


def _times() -> Column:
    """How often a row (h) is taken by its source's plan."""
    return F.col("repeats") + (F.col("h") < F.col("prefix")).cast("bigint")


def _plan(rows: DataFrame, weights: DataFrame | None, most: int, in_parts: bool = False) -> DataFrame:
    """source, source_size, target, repeats and prefix (the first hash not taken once more) of every source.

    If ``in_parts``, the source of a row is a struct of source and part, and so is that of the plan.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    if in_parts:
        parts = session.staged(sizes.withColumnsRenamed({"source": "both", "source_size": "part_size"}), "mixing-parts")
        sizes = parts.groupBy(F.col("both.source").alias("source")).agg(F.sum("part_size").alias("source_size"))
    if weights is None:
        weights = ranked_weights(sizes.select("source"))
    weights = weights.select(F.col("source").alias("w_source"), "weight")
    sizes = sizes.join(weights, F.col("source").eqNullSafe(F.col("w_source"))).drop("w_source")
    plan = targets(sizes, most)
    repeats = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size")))
    plan = plan.withColumn("repeats", repeats.cast("bigint")).withColumn(
        "budget", F.col("target") - F.col("repeats") * F.col("source_size")
    )
    if in_parts:
        share = F.when(F.col("source_size") > 0, F.col("part_size") / F.col("source_size")).otherwise(0.0)
        plan = plan.join(parts, F.col("source").eqNullSafe(F.col("both.source"))).withColumn("budget", F.col("budget") * share)
        plan = plan.drop("source", "part_size").withColumnRenamed("both", "source")
    plan = plan.withColumn("prefix", F.lit(0).cast("bigint"))
    for level in range(LEVELS):
        plan = session.staged(_narrowed(rows, plan, level), "mixing-plan")
    return plan


def _narrowed(rows: DataFrame, plan: DataFrame, level: int) -> DataFrame:
    """Extend each source's threshold ``prefix`` by one digit, spending ``budget`` on lower ones.

    At the last level ``prefix`` becomes the threshold itself: the first hash not taken.
    """
    bound = plan.select(F.col("source").alias("p_source"), "prefix")
    inside = rows.join(bound, F.col("source").eqNullSafe(F.col("p_source")))
    inside = inside.filter(_high(F.col("h"), level) == F.col("prefix"))
    bins = inside.groupBy("source", _high(F.col("h"), level + 1).alias("bin")).agg(F.sum("size").alias("bin_size"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("before", F.sum("bin_size").over(upto) - F.col("bin_size"))
    bins = bins.withColumnRenamed("source", "b_source")
    ends = (
        plan.join(bins, F.col("source").eqNullSafe(F.col("b_source")), "left")
        .filter(F.col("before").isNull() | (F.col("before") <= F.col("budget")))
        .groupBy(*plan.columns)
        .agg(F.max(F.struct("bin", "before", "bin_size")).alias("end"))
    )
    budget = F.col("budget") - F.coalesce(F.col("end.before"), F.lit(0))
    prefix = F.coalesce(F.col("end.bin"), F.col("prefix") * (1 << DIGIT))
    if level == LEVELS - 1:
        nearer = F.coalesce(2 * budget >= F.col("end.bin_size"), F.lit(False))
        prefix = prefix + nearer.cast("bigint")
    kept = [c for c in plan.columns if c not in ("budget", "prefix")]
    return ends.select(*kept, budget.alias("budget"), prefix.alias("prefix"))


def _high(h: Column, digits: int) -> Column:
    """The first ``digits`` digits of a hash."""
    return F.shiftright(h, DIGIT * (LEVELS - digits))


def repeated(
    docs: DataFrame, weights: DataFrame | None = None, most: int = 3, id_col: str = "doc_id", part_col: str | None = None
) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns, each as often as the mix takes it.

    Documents without words carry no weight in the mix and stay once, so that none is lost
    for being empty. If there is a ``part_col``, a language say, each part of a source is taken in
    proportion to its size: it has a threshold of its own, and sources keep their targets.
    """
    key = F.col("source") if part_col is None else F.struct("source", F.col(part_col).alias("part"))
    measured = [key.alias("source"), *_measured(id_col)[1:]]
    plan = _plan(session.staged(docs.select(*measured), "mixing-sizes"), weights, most, part_col is not None)
    plan = plan.select("repeats", "prefix", F.col("source").alias("p_source"))
    rows = docs.select(F.struct(*docs.columns).alias("_mix_row"), *measured)
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("p_source")))
    times = F.when(F.col("size") == 0, 1).otherwise(_times()).cast("int")
    copies = F.explode(F.array_repeat(F.lit(True), times)).alias("_mix_copy")
    return joined.select("_mix_row", copies).select("_mix_row.*")
