"""Exact dedup: groups of equal texts, combined in three steps that no hot group can overload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import session
from tillroll.llm.tables import ascii_lower

#: What a text is known by where the text itself is left out: its digest, another hash, its length.
IDENTITY = ("digest", "check", "chars")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal
    texts the row with the largest id stays; null ids count in ``group_size`` and stay only
    if no row of their group has an id. Rows that repeat both text and id of the winner are
    one document stored more than once: all of them are marked as kept. Other columns of
    ``docs`` are not read, so their names do not matter.

    The text itself is a grouping key at every step, the digest only decides where rows
    meet: (1) each task combines its own rows (Spark's partial aggregation), (2) rows meet
    by digest and salt, so a group with a third of all rows is spread over ``salts`` tasks,
    (3) one winner per salt and text meets by digest. Ids go back to the rows by the digest
    and two further hashes; that join is on unique keys and carries no text. The winners are
    written first, so that the join is between two plain shuffles and a hot digest's part
    can be split.
    """
    marked = _marked(docs, id_col, text_col, salts)
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def _identity(norm: Column) -> list[Column]:
    return [F.sha2(norm, 256).alias("digest"), F.xxhash64(norm).alias("check"), F.length(norm).alias("chars")]


def _marked(docs: DataFrame, id_col: str, text_col: str, salts: int) -> DataFrame:
    """doc_id, the text's identity, keep_id, group_size and kept of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), ascii_lower(F.col(text_col)).alias("norm"))
    rows = rows.withColumn("digest", F.sha2("norm", 256))
    salted = rows.groupBy("digest", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    winners = salted.groupBy("digest", "norm").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    identity = ["digest", *_identity(F.col("norm"))[1:]]
    winners = session.staged(winners.select(*identity, "keep_id", "group_size"), "winners")
    joined = rows.select("doc_id", *identity).join(winners, [*IDENTITY])
    return joined.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per text, with all its columns.

    It is the row that ``groups`` marks. Of several, which have the same id, the one with the
    least text by its bytes stays (upper case comes first); which of rows that are alike in
    that as well is left open.
    """
    kept = _marked(docs, id_col, text_col, 16).filter("kept").groupBy("doc_id", *IDENTITY).agg(F.count(F.lit(1)).alias("n"))
    kept = session.staged(kept.select("n", *[F.col(c).alias(f"_exact_{c}") for c in ("doc_id", *IDENTITY)]), "kept-texts")
    names = [f"_exact_{c}" for c in IDENTITY]
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = [key.alias(name) for key, name in zip(_identity(ascii_lower(F.col(text_col))), names, strict=True)]
    rows = docs.select(F.struct(*docs.columns).alias("_exact_row"), F.col(id_col).alias("_exact_id"), text.alias("_exact_text"), *keys)

    def of(wanted: DataFrame) -> DataFrame:
        same = F.col("_exact_id").eqNullSafe(F.col("_exact_doc_id"))
        for name in names:
            same = same & (rows[name] == wanted[name])
        return rows.join(wanted, same, "left_semi")

    once = of(kept.filter("n = 1")).select("_exact_row.*")
    many = kept.filter("n > 1")
    if many.isEmpty():
        return once
    first = F.min_by("_exact_row", "_exact_text").alias("_exact_row")
    return once.union(of(many).groupBy(*names).agg(first).select("_exact_row.*"))
