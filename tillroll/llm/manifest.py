"""Merkle manifest of a dataset: a digest per row, per source and for all, and a proof for every row.

Rows are numbered within their source. The digits of a number name the runs a row belongs to
on each level, so one digit after the other is grouped away and the children become an
array of nested structs, up to blocks of FAN ** DIGITS rows. The digests of blocks are
numbered like rows and rolled up again, until one is left. Back down, blocks and what stands
above them meet in one grouping; transforming and exploding the nested structs gives every row its path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll import session

#: Children of a node, and levels that are nested in one block.
FAN, DIGITS = 16, 3
BLOCK = FAN**DIGITS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"
#: Low bits of a generated row number, which count the rows of a task.
_IN_TASK = 33


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of a row: of each value its UTF-8 byte count, a colon and itself; of a null, a dash."""
    texts = [column.cast("string") for column in columns]
    sized = [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.sha2(F.concat(*sized), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, start, lambda below, run: F.sha2(F.concat(run["left"], below, run["right"]), 256))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings on a path, from the leaf to the root and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), ""), 256)


def proofs(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "source",
    carried: Mapping[str, Column] | None = None,
) -> DataFrame:
    """doc_id, source, leaf, path, subroot and root of every row of ``docs``, and ``carried``.

    A leaf is the digest of ``columns``. Within a source, leaves stand by ascending id, rows without an id
    first; rows that share an id stand by their leaf, and equal ones are leaves of their own. Every FAN
    consecutive nodes become their digest (the last run may be shorter, even one) until one
    is left, the subroot; a lone leaf is its own. Subroots by source, null first and then
    bytewise, give the root likewise. An element of ``path`` has the other digests of a run, those to the
    left and those to the right of the node joined each; levels on which nothing is left to
    join do not occur. Null and empty values differ. An empty table has no rows.

    No task sees more than a block of a source, so a hot source is spread. The numbers
    come from a sort by ranges and a count per task; what is written on the way is removed.
    """
    extra = dict(carried or {})
    with ExitStack() as stack:

        def kept(df: DataFrame, label: str) -> DataFrame:
            return stack.enter_context(session.temporary(df, label))

        rows = docs.select(
            F.col(group_col).alias("source"),
            F.col(id_col).alias("doc_id"),
            leaf([F.col(c) for c in columns]).alias("hash"),
            F.struct(F.lit(0).alias("none"), *[value.alias(name) for name, value in extra.items()]).alias("extra"),
            # Tells rows apart that are alike in all else, so that also these are dealt over several tasks.
            F.monotonically_increasing_id().alias("seq"),
        )
        rows = _numbered(kept(rows, "leaves"), "source", ["doc_id", "hash", "seq"], kept)
        rows = rows.withColumn("payload", F.struct("doc_id", "extra"))
        leaves = _tiers(rows, "source", kept, "leaf-blocks")
        subroots = leaves[-1].select(F.lit(0).alias("all"), "source", "hash")
        subroots = _numbered(subroots, "all", ["source"], kept).withColumn("payload", F.struct("source"))
        tops = _tiers(subroots, "all", kept, "source-blocks")
        up = F.struct(F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
        found = _emitted(tops[-1].withColumn("up", up), "all")
        for tier in reversed(tops[:-1]):
            found = _emitted(_attached(tier, found, "all"), "all")
        named = F.struct("up.path", F.col("hash").alias("subroot"), "up.root")
        found = found.select("payload.source", F.lit(0).cast("bigint").alias("rank"), named.alias("up"))
        for tier in reversed(leaves):
            found = _emitted(_attached(tier, found, "source"), "source")
        out = found.select("payload.doc_id", "source", F.col("hash").alias("leaf"), "up.*", *[f"payload.extra.{c}" for c in extra])
        return session.staged(out, "proofs")


def _numbered(rows: DataFrame, group: str, order: list[str], kept) -> DataFrame:
    """``rows`` with their rank within the group, from 0, and the group's total.

    Sorted by ranges, so no task has a group as such; each task's rows are counted by group,
    and the counts before it are added. Spark broadcasts the counts if they are few.
    """
    placed = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = kept(placed.withColumn("at", F.monotonically_increasing_id()), "placed")
    task = F.shiftright("at", _IN_TASK)
    counts = placed.groupBy(group, task.alias("task")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    of_group = Window.partitionBy(group)
    before = F.coalesce(F.sum("n").over(of_group.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = counts.select(
        F.col(group).alias("its_group"), "task", (before - F.col("first")).alias("shift"), F.sum("n").over(of_group).alias("total")
    )
    shifts = kept(shifts, "shifts")
    same = F.col(group).eqNullSafe(F.col("its_group")) & (task == F.col("task"))
    ranked = placed.join(shifts, same).withColumn("rank", F.col("at") + F.col("shift"))
    return ranked.drop("its_group", "task", "at", "shift")


def _tiers(items: DataFrame, group: str, kept, label: str) -> list[DataFrame]:
    """Blocks of the items, blocks of these blocks' digests, and so on until each group has one block."""
    tiers = []
    while True:
        tiers.append(kept(_rolled(items, group), f"{label}-{len(tiers)}"))
        if tiers[-1].filter(F.col("total") > BLOCK).isEmpty():
            return tiers
        total = F.ceil(F.col("total") / BLOCK).cast("bigint")
        items = tiers[-1].select(group, F.col("block").alias("rank"), total.alias("total"), "hash", F.struct(F.lit(0).alias("none")).alias("payload"))


def _rolled(items: DataFrame, group: str) -> DataFrame:
    """Group, block, total, hash and children of each block of (group, rank, total, hash, payload).

    All levels of a block are grouped where its rows have met once.
    """
    digits = [F.expr(f"CAST(rank div {FAN**level} % {FAN} AS INT)") for level in range(DIGITS)]
    node = F.struct(digits[0].alias("digit"), "hash", "payload").alias("node")
    digits = [digit.alias(f"digit_{level}") for level, digit in enumerate(digits)][1:]
    block = F.expr(f"rank div {BLOCK}").alias("block")
    rows = items.select(group, block, "total", *digits, node).repartition(group, "block")
    for level in range(1, DIGITS + 1):
        above = [f"digit_{k}" for k in range(level, DIGITS)]
        rows = rows.groupBy(group, "block", "total", *above).agg(F.array_sort(F.collect_list("node")).alias("children"))
        joined = F.sha2(F.array_join("children.hash", ""), 256)
        digest = F.when(_joins(level), joined).otherwise(F.col("children.hash")[0]).alias("hash")
        if above:
            node = F.struct(F.col(above[0]).alias("digit"), digest, "children").alias("node")
            rows = rows.select(group, "block", "total", *above[1:], node)
        else:
            rows = rows.select(group, "block", "total", digest, "children")
    return rows


def _joins(level: int) -> Column:
    """Whether a group of so many items has several nodes below a level, which are then joined."""
    return F.col("total") > FAN ** (level - 1)


def _attached(blocks: DataFrame, above: DataFrame, group: str) -> DataFrame:
    """``blocks`` and the path from each up: both meet in one grouping by group and block."""
    kinds = dict(blocks.dtypes) | dict(above.dtypes)
    both = blocks.select(group, "block", "total", "children", F.lit(None).cast(kinds["up"]).alias("up")).union(
        above.select(
            group,
            F.col("rank").alias("block"),
            F.lit(None).cast("bigint"),
            F.lit(None).cast(kinds["children"]),
            "up",
        )
    )
    values = ("total", "children", "up")
    return both.groupBy(group, "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def _emitted(blocks: DataFrame, group: str) -> DataFrame:
    """Group, rank, hash, payload and up of every item of (group, block, total, children, up)."""
    rows = blocks.withColumn("rank", F.col("block"))
    for level in range(DIGITS, 0, -1):
        rows = rows.select(group, "rank", "total", "up", F.col("children.hash").alias("run"), "children")
        rows = rows.select(group, "rank", "total", "up", "run", F.posexplode("children").alias("place", "child"))
        place = F.col("place")
        own = F.struct(
            F.array_join(F.slice("run", F.lit(1), place), "").alias("left"),
            F.array_join(F.slice("run", place + 2, F.lit(FAN)), "").alias("right"),
        )
        path = F.when(_joins(level), F.concat(F.array(own), "up.path")).otherwise(F.col("up.path"))
        up = F.struct(path.alias("path"), "up.subroot", "up.root").alias("up")
        rank = (F.col("rank") * FAN + F.col("child.digit")).alias("rank")
        inner = [F.col("child.children").alias("children")] if level > 1 else [F.col("child.payload").alias("payload")]
        rows = rows.select(group, rank, "total", up, F.col("child.hash").alias("hash"), *inner)
    return rows.drop("total")
