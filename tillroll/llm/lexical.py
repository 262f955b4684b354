"""Ranked lexical search: term at a time, the rarest first, with a limit on accumulators.

Only documents that can still be among the best get an accumulator. Once the bounds on all of an
item's remaining terms together cannot reach its kth partial score, its terms create no more of
them; those there are, unless they cannot reach it either, go on to their exact scores.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll import session

BEST = 10
#: Bits of a term's hash; tasks get one flag for each value, whatever the number of terms asked for.
HASH_BITS = 20
#: Terms whose numbers of documents share a logarithm to this base are handled in one round.
ROUND_BASE = 4
#: What makes a term: ASCII letters in lower case, digits, and all that is not ASCII. The rest ends one.
_FOLDED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
RESULT = "item_id {item}, rank int, doc_id {doc}, score bigint"


def terms(text: bytes) -> list[bytes]:
    """Terms of a text in order, with repeats."""
    return text.translate(_FOLDED).split()


def _flags(words: DataFrame) -> bytes:
    """A bit for each hash value: whether one of the words has it."""
    flags = np.zeros(1 << HASH_BITS, bool)
    value = F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    flags[[row["h"] for row in words.select(value.alias("h")).distinct().collect()]] = True
    return np.packbits(flags).tobytes()


def indexed(texts: DataFrame, wanted: bytes | None = None) -> DataFrame:
    """row, id, n, terms and tfs of every text of (id, text) that has a term.

    ``n`` counts all terms. Of ``terms``, which are distinct, those whose hash is not among the
    ``wanted`` flags are left out; others may be there by chance.
    """
    keyed = texts.select(F.monotonically_increasing_id().alias("row"), "id", F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(np.frombuffer(wanted, np.uint8)).tobytes() if wanted is not None else None
        mask = (1 << HASH_BITS) - 1
        for batch in batches:
            rows, totals, sizes, words, counts = [], [], [0], [], []
            for row, text in enumerate(batch.column("text")):
                found = Counter(terms(text.as_py() or b""))
                if not found:
                    continue
                rows.append(row)
                totals.append(found.total())
                if flags is not None:
                    found = {term: n for term, n in found.items() if flags[zlib.crc32(term) & mask]}
                words.extend(found)
                counts.extend(found.values())
                sizes.append(len(words))
            offsets = pa.array(sizes, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, values) for values in (pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()))]
            at = pa.array(rows, pa.int64())
            columns = [batch.column("row").take(at), batch.column("id").take(at), pa.array(totals, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "n", "terms", "tfs"])

    kind = texts.schema["id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"row bigint, id {kind}, n bigint, terms array<string>, tfs array<bigint>")


def best(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item, fewer if fewer score above 0.

    A term's weight is floor(1000 * ln((2N + 2) / (2df + 1))) over the N documents that have any
    term; in a document it counts weight * (10**9 * tf div (1000 * tf + 8 * m)), where m is 25
    plus 75 times the document's length over the mean length. Repeats in the item count again. Equal
    scores rank by ascending id, null last. Null texts have no terms. Rows are documents and items
    of their own, so ids may repeat or be null; other columns are not read.

    Terms are read in rounds of similar frequency, each of which Spark stores apart, and within a round
    the rule holds term by term. Whatever the items ask for, tasks get flags of fixed size;
    exact terms are joined, and Spark broadcasts them only if they are few.
    """
    spark = docs.sparkSession
    with ExitStack() as stack:

        def kept(df: DataFrame, label: str, until: ExitStack = stack) -> DataFrame:
            return until.enter_context(session.temporary(df, label))

        asked = items.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text"))
        asked = kept(indexed(asked), "items")
        queried = asked.select(F.col("row").alias("item"), "id", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
        queried = kept(queried.select("item", F.col("id").alias("item_id"), F.col("t.terms").alias("term"), F.col("t.tfs").alias("q")), "queried")
        words = kept(queried.select("term").distinct(), "words")
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        index = kept(indexed(rows, _flags(words)), "index")
        many, length = index.agg(F.count(F.lit(1)), F.sum("n")).first()
        schema = RESULT.format(item=queried.schema["item_id"].dataType.simpleString(), doc=index.schema["id"].dataType.simpleString())
        if not many:
            return spark.createDataFrame([], schema)

        m = F.expr(f"25 + (75 * n * {many}L) div {length}L").alias("m")
        hits = index.select("row", "id", m, F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
        impact = F.expr("(1000000000 * t.tfs) div (1000 * t.tfs + 8 * m)").alias("impact")
        hits = hits.select("row", "id", F.col("t.terms").alias("term"), impact).join(words, "term", "left_semi")
        facts = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("impact").alias("most"))
        weight = F.expr(f"CAST(floor(1000 * ln((2 * {many}D + 2) / (2 * df + 1))) AS BIGINT)")
        turn = F.expr(f"CAST(floor(log({ROUND_BASE}, df)) AS INT)")
        facts = kept(facts.select("term", "df", "most", weight.alias("weight"), turn.alias("turn")), "facts")
        # The bound of a term and all after it, in the order in which an item's terms are read.
        after = Window.partitionBy("item").orderBy("df", "term").rowsBetween(0, Window.unboundedFollowing)
        plan = queried.join(facts, "term").withColumn("factor", F.col("q") * F.col("weight"))
        plan = plan.select("item", "term", "turn", "factor", F.sum(F.col("factor") * F.col("most")).over(after).alias("bound"))
        plan = kept(plan, "plan")
        postings = hits.join(facts.select("term", "turn"), "term")
        # Stored by round: a round reads its own files only.
        postings = stack.enter_context(session.temporary(postings, "postings", partition_by=["turn"]))
        turns = [row["turn"] for row in plan.select("turn").distinct().orderBy("turn").collect()]

        found, floors, before = None, None, ExitStack()
        for turn in turns:
            now = stack.enter_context(ExitStack())
            step = _round(postings.filter(F.col("turn") == turn), plan.filter(F.col("turn") == turn), found, floors)
            made = kept(step, f"accumulators-{turn}", now)
            floors = kept(_floors(made, k), f"floors-{turn}", now)
            found = _reaching(made, floors, plan.filter(F.col("turn") > turn))
            before.close()
            before = now
        if found is None:
            return spark.createDataFrame([], schema)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
        top = found.filter("score > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = queried.select("item", "item_id").distinct()
        result = top.join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        return session.staged(result, "ranked")


def _round(postings: DataFrame, plan: DataFrame, found: DataFrame | None, floors: DataFrame | None) -> DataFrame:
    """Accumulators (item, row, id, score) after the terms of one round.

    A term creates accumulators if the bound from it on reaches the floor. Items none of whose terms do
    look only into the rows of the accumulators they have.
    """
    adds = F.col("factor") * F.col("impact")
    if found is None:
        new = postings.join(plan, "term").select("item", "row", "id", adds.alias("score"))
        return new.groupBy("item", "row").agg(F.first("id").alias("id"), F.sum("score").alias("score"))
    plan = plan.join(floors, "item", "left").withColumn("creates", F.col("floor").isNull() | (F.col("bound") >= F.col("floor")))
    plan = plan.withColumn("open", F.max("creates").over(Window.partitionBy("item"))).drop("floor", "bound", "turn")
    new = postings.join(plan.filter("open"), "term").select("item", "row", "id", adds.alias("score"), "creates")
    asked = found.select("item", "row").join(plan.filter("NOT open").select("item", "term", "factor"), "item")
    late = postings.join(asked, ["term", "row"]).select("item", "row", "id", adds.alias("score"), F.lit(False).alias("creates"))
    every = found.select("item", "row", "id", "score", F.lit(True).alias("creates")).union(new).union(late)
    summed = every.groupBy("item", "row").agg(F.first("id").alias("id"), F.sum("score").alias("score"), F.max("creates").alias("creates"))
    return summed.filter("creates").drop("creates")


def _floors(found: DataFrame, k: int) -> DataFrame:
    """The kth best partial score of every item that has so many."""
    order = Window.partitionBy("item").orderBy(F.desc("score"))
    top = found.select("item", "score", F.row_number().over(order).alias("place")).filter(F.col("place") <= k)
    top = top.groupBy("item").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    return top.filter(F.col("n") == k).select("item", "floor")


def _reaching(found: DataFrame, floors: DataFrame, rest: DataFrame) -> DataFrame:
    """The accumulators that can still be among the best: with the bound on what is left they reach the floor."""
    rest = rest.groupBy("item").agg(F.max("bound").alias("rest"))
    limits = floors.join(rest, "item", "left").select("item", (F.col("floor") - F.coalesce("rest", F.lit(0))).alias("least"))
    joined = found.join(limits, "item", "left")
    return joined.filter(F.col("least").isNull() | (F.col("score") >= F.col("least"))).drop("least")
