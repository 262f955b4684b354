"""URL filters: dated list entries as validity intervals, joined to captures as of their fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll import session

#: Time is cut into pieces of so many days, so that captures meet only intervals of their time.
PIECE_DAYS = 30


def host(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user, port and final dot; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(found), r"\.+$", "")


def path(url: Column) -> Column:
    """Segments of the path, empty ones left out."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.filter(F.split(found, "/"), lambda part: part != "")


def keys(host: Column, path: Column, depth: int) -> Column:
    """Patterns that cover a URL: the host and the domains above it, and the host with up to ``depth`` segments."""
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    deepest = F.least(F.size(path), F.lit(depth))
    places = F.when(deepest > 0, F.sequence(F.lit(1), deepest)).otherwise(F.array().cast("array<int>"))
    prefixes = F.transform(places, lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(path, F.lit(1), i), "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.concat(domains, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, effect, valid_from and valid_to (exclusive; null while it holds) of dated entries.

    ``entries`` has pattern, effect (``block`` or ``allow``), day and action (``add`` or
    ``remove``). On one day ``add`` wins. Adding what holds and removing what does not change
    nothing; rows without a pattern or a day are left out. Entries of a pattern are reduced to
    one a day before they are put in order, so a pattern has as many rows as days at most.
    """
    days = (
        entries.filter("pattern IS NOT NULL AND day IS NOT NULL AND action IN ('add', 'remove')")
        .groupBy("pattern", "effect", "day")
        .agg(F.max((F.col("action") == "add").cast("int")).alias("on"))
    )
    in_order = Window.partitionBy("pattern", "effect").orderBy("day")
    changes = days.withColumn("was", F.lag("on", 1, 0).over(in_order)).filter("on <> was")
    ends = changes.withColumn("valid_to", F.lead("day").over(in_order))
    return ends.filter("on = 1").select("pattern", "effect", F.col("day").alias("valid_from"), "valid_to")


def filtered(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "fetched_on") -> DataFrame:
    """One row per capture: id, host, fetched_on, active, decided_by, blocked.

    ``captures`` has an id, a URL and the day of its fetch. ``active`` is the number of
    patterns that cover the URL and held on that day. The longest of them decides (of both
    effects for one pattern, ``allow``); ``decided_by`` is null and ``blocked`` false if there
    is none, as for null or relative URLs and captures without a day. Rows that repeat an id
    are decided one by one: ids are only carried along, no row is dropped.

    Intervals are cut into pieces of time and joined on pattern and piece, so that a pattern
    with a long history meets each capture with the intervals of its time only. Captures are
    reduced to distinct hosts, paths and days before the join, a host with a third of all
    captures to as many rows as it has pages and days; they get the decision back by a join
    on those. Paths are looked at as deep as the deepest pattern.
    """
    rows = captures.select(
        F.col(id_col).alias("page_id"),
        host(F.col(url_col)).alias("host"),
        path(F.col(url_col)).alias("path"),
        F.col(day_col).cast("date").alias("fetched_on"),
    )
    held = intervals(entries)
    depth = held.agg(F.max(F.length("pattern") - F.length(F.replace("pattern", F.lit("/"))))).first()[0] or 0
    rows = rows.withColumn("path", F.slice("path", 1, depth) if depth else F.array().cast("array<string>"))
    asked = rows.filter("host <> '' AND fetched_on IS NOT NULL").select("host", "path", "fetched_on").distinct()
    first, last = asked.agg(F.min("fetched_on"), F.max("fetched_on")).first()

    def piece(day: Column) -> Column:
        return F.floor(F.unix_date(day) / PIECE_DAYS).cast("int")

    begin = F.greatest(F.col("valid_from"), F.lit(first).cast("date"))
    end = F.least(F.date_sub("valid_to", 1), F.lit(last).cast("date"))
    pieces = held.withColumn("begin", begin).withColumn("end", end).filter("begin <= end")
    pieces = pieces.withColumn("piece", F.explode(F.sequence(piece(F.col("begin")), piece(F.col("end")))))
    pieces = pieces.select("pattern", "piece", "effect", "begin", "end")
    looked_up = asked.select("*", F.explode(keys(F.col("host"), F.col("path"), depth)).alias("key"))
    looked_up = looked_up.withColumn("at", piece(F.col("fetched_on")))
    as_of = (F.col("key") == F.col("pattern")) & (F.col("at") == F.col("piece")) & F.col("fetched_on").between(F.col("begin"), F.col("end"))
    strongest = F.max(F.struct(F.length("pattern"), "pattern", (F.col("effect") == "allow").alias("allow")))
    decided = (
        looked_up.join(pieces, as_of)
        .groupBy("host", "path", "fetched_on")
        .agg(F.count(F.lit(1)).alias("active"), strongest.alias("top"))
    )
    # Written first: the join is then between two plain shuffles, of which a hot page's part can be split.
    decided = session.staged(decided, "decisions")
    return rows.join(decided, ["host", "path", "fetched_on"], "left").select(
        "page_id",
        "host",
        "fetched_on",
        F.coalesce("active", F.lit(0)).alias("active"),
        F.col("top.pattern").alias("decided_by"),
        F.coalesce(~F.col("top.allow"), F.lit(False)).alias("blocked"),
    )
