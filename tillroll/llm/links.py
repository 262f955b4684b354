"""From buckets of alike sets to exact links and their components, without pairs of a whole bucket."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import session

Likely = Callable[[Column, Column], Column]
#: Columns that only tell where an id's set is made from.
PLACE = ("doc", "number", "first_word", "n_words", "mark")


def alike(shared: Column, left: Column, right: Column, percent: int) -> Column:
    """Whether two sets of the given sizes that share so many have the similarity ``percent``."""
    return 100 * shared >= percent * (left + right - shared)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike. ``sets`` has id and grams (distinct values)."""
    one = pairs.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("b_grams")), "b")
    both = one.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("a_grams")), "a")
    shared = F.size(F.array_intersect("a_grams", "b_grams"))
    return both.filter(alike(shared, F.size("a_grams"), F.size("b_grams"), percent)).select("a", "b").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """id and component (the smallest id reachable) for every id in ``edges`` (distinct a, b; a < b).

    Alternates two steps until nothing changes: every id hands its larger neighbours to its
    smallest neighbour, then its smaller ones (large star, small star). Sums come before
    joins, so an id with very many links is one row per task. Each round is written to the
    shared folder; only the result stays there.
    """
    with ExitStack() as stack:
        before = _state(edges)
        for _ in range(rounds):
            both = edges.union(edges.select("b", "a"))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
            least = large.groupBy("b").agg(F.min("a").alias("m"))
            small = large.join(least, "b").select(F.col("m"), F.explode(F.array("a", "b")).alias("v"))
            small = small.filter("m < v").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
            edges = stack.enter_context(session.temporary(small, "edges"))
            state = _state(edges)
            if state == before:
                break
            before = state
        else:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
        roots = edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
        named = edges.select(F.col("b").alias("id"), F.col("a").alias("component")).union(roots)
        return session.staged(named, "components")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def clusters(
    buckets: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    percent: int,
    likely: Likely,
    centred: int = 1,
    sketches: DataFrame | None = None,
    possible: Likely | None = None,
    about: DataFrame | None = None,
) -> DataFrame:
    """id and component for all ids that are linked with another one.

    ``buckets`` has key, id and what ``likely`` needs of an id, unless ``about`` has that by id: ids that
    share a key are candidates. ``about`` may also say, by the columns of PLACE, where ``sets_of`` finds an id. Its rows are distinct, and it is computed twice, so a caller whose buckets are
    costly writes them first. ``sets_of`` takes a DataFrame of ids and gives their id and
    grams. ``likely`` tells of two structs of a row's columns whether their whole sets are
    worth comparing.

    A bucket's rows meet its centre only. First an id meets two at most of its buckets'
    smallest ids, the smallest likely one and one chosen by a hash. Then, where a bucket still
    holds several components, its rows meet one that a hash chooses from bucket to bucket,
    ``centred`` times. Only
    ids of different components that are left in one bucket are then compared with each
    other, and only likely pairs leave that join. No candidate is dropped. Where there are
    ``sketches`` (id and more), pairs that ``possible`` rules out by theirs do not leave it either.
    """
    with ExitStack() as stack:

        def kept(df: DataFrame, label: str) -> DataFrame:
            """Written to the shared folder until the components are known."""
            return stack.enter_context(session.temporary(df, label))

        # Written first: the join is then between two plain shuffles, of which a hot key's part can be split.
        shared = kept(buckets.groupBy("key").count().filter("count > 1").select("key"), "shared-keys")
        rows = buckets.join(shared, "key")
        rows = kept(rows if about is None else rows.join(about, "id"), "shared-buckets")
        place = [c for c in PLACE if c in rows.columns]
        row = F.struct("id", *[c for c in rows.columns if c not in ("key", "id", *place)])
        sets = kept(sets_of(rows.select("id", *place).distinct()), "sets")
        centres = kept(rows.groupBy("key").agg(F.min(row).alias("a")), "centres")
        met = rows.select("key", row.alias("b")).join(centres, "key").filter(F.col("a.id") < F.col("b.id"))
        met = met.filter(likely(F.col("a"), F.col("b"))).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))
        met = met.groupBy("b").agg(F.min("a").alias("low"), F.min(F.struct(F.xxhash64("a", "b").alias("h"), "a")).alias("any"))
        pairs = met.select(F.explode(F.array_distinct(F.array("low", "any.a"))).alias("a"), "b")
        found = components(kept(confirmed(pairs, sets, percent), "links")).withColumnRenamed("component", "found")
        for turn in range(centred + 1):
            left = rows.select("key", "id", row.alias("row")).join(found, "id", "left")
            left = left.select("key", "row", F.coalesce("found", "id").alias("component"))
            member = F.struct(F.xxhash64("key", "row.id", F.lit(turn)).alias("h"), "row", "component")
            open_keys = left.groupBy("key").agg(
                F.min("component").alias("low"), F.max("component").alias("high"), F.min(member).alias("centre")
            )
            open_keys = kept(open_keys.filter("low < high").select("key", "centre"), "open-keys")
            if open_keys.isEmpty():
                return found.withColumnRenamed("found", "component")
            rest = left.join(open_keys.select("key", *(["centre"] if turn < centred else [])), "key")
            if turn < centred:
                x, y = F.col("centre.row"), F.col("row")
                met = rest.filter((F.col("component") != F.col("centre.component")) & likely(x, y))
            else:
                x, y = F.col("row"), F.col("other")
                pairs_like = likely(x, y)
                if sketches is not None:
                    about = sketches.select(F.col("id").alias("its_id"), F.struct(*sketches.columns).alias("sketch"))
                    rest = rest.join(about, F.col("row.id") == F.col("its_id")).drop("its_id")
                    pairs_like = pairs_like & possible(F.col("sketch"), F.col("other_sketch"))
                rest = kept(rest, "open-rows")
                names = {"key": "k", "row": "other", "component": "c", "sketch": "other_sketch"}
                other = rest.select(*[F.col(c).alias(names[c]) for c in rest.columns])
                unlike = (F.col("key") == F.col("k")) & (F.col("component") < F.col("c"))
                met = rest.join(other, unlike & pairs_like)
            ids = x["id"], y["id"]
            pairs = met.select(F.least(*ids).alias("a"), F.greatest(*ids).alias("b")).distinct()
            found = _merged(found, kept(confirmed(pairs, sets, percent), "links"))
        return found.withColumnRenamed("found", "component")


def _merged(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """``found`` (id, found: its component) after the linked ``pairs`` (a, b), whose ids may be new, have joined components.

    Only the components that a pair joins are searched, each as one id: the smallest of them
    is the smallest id of all.
    """
    own = [found.select(F.col("id").alias(c), F.col("found").alias(f"{c}_found")) for c in ("a", "b")]
    ends = pairs.join(own[0], "a", "left").join(own[1], "b", "left")
    ends = ends.select(F.coalesce("a_found", "a").alias("x"), F.coalesce("b_found", "b").alias("y")).filter("x <> y")
    edges = ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    with session.temporary(edges, "joining") as joining:
        joined = components(joining)
    again = found.join(joined.withColumnRenamed("id", "found"), "found", "left")
    again = again.select("id", F.coalesce("component", "found").alias("found"))
    new = joined.join(found, "id", "left_anti").select("id", F.col("component").alias("found"))
    return session.staged(again.union(new), "components")
