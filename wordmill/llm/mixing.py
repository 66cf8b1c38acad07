"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight schedule over training time 0..1, piecewise linear between knots. Its target is its share
of all words, at most ``most_repeats`` times its own size, the excess shared anew by weight. A source's cumulative
demand at time t is its target times the integral of its schedule up to t, divided by the integral over 0..1. A copy of
a document that starts c words into its source's stream is due where that demand reaches c; inverting the integral
gives the position, and documents are sorted by it with a range shuffle.

Everything is expressed in DataFrame functions. The order within a source is a hash of the document; cumulative sizes
are taken in two levels (slices of the hash, then within a slice), so a source with most of the rows isn't one task's.

Defined results: a null text has size 0; documents of size 0 are taken once and add no words. A null source is a
source of its own, last. Equal rows have equal hashes; they follow each other in any order, so what the copies take
is the same set of rows. Very long texts are counted whole; their copies are rows like others. An empty table gives an empty
table. Other columns are kept by :func:`curriculum`, but for mix_position and mix_repeat, which it makes anew. There is one
row a source in the windows that share the targets, which one task holds; documents are never in one.

Texts are read once to count them; what the shares, slices and places are summed from is a thin table of ids, hashes and sizes, and
:func:`schedule` needs nothing else. :func:`curriculum` returns texts: its second scan goes through two shuffles, by slice and by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Workspace

WORD = r"[^\x20\x09-\x0D]+"
#: Weight schedules by the rank of the source, repeating: (time, factor) knots of a line; here rising, falling and even.
SCHEDULES = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)))
#: Words of a source that a slice of the hash order holds about.
SLICE_WORDS = 2_000_000
#: Sources that are sent to all tasks (some 60 bytes each); beyond it, salts that a source's rows are dealt over.
MOST_BROADCAST, SALTS = 1 << 16, 32


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash() -> Column:
    """The order in a source: a digest of doc_id and text, the same in any engine and run."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit(""))))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most_repeats: float) -> DataFrame:
    """source, source_size, rank, weight, target from (source, source_size), one row a source.

    Sources are capped in the order of size by weight: one is capped if its share of what is left, after those
    capped before it, reaches its cap. The share of the first one that isn't holds for all after it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1)
    # one row a source: these windows run over the sources, not over documents
    ranked = sizes.withColumn("rank", F.row_number().over(order)).withColumn("weight", w)
    cap = F.col("source_size") * F.lit(float(most_repeats))
    by = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    steps = (
        ranked.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("capped", F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("weight_left"))
        .withColumn("is_capped", F.col("level") * F.col("weight") > cap)
    )
    first_free = F.first(F.when(~F.col("is_capped"), F.col("level")), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("is_capped"), cap).otherwise(F.col("weight") * first_free)
    return steps.select("source", "source_size", "rank", "weight", target.alias("target"))


def _demand_inverse(share: Column, rank: Column, schedules) -> Column:
    """The time at which a schedule's integral reaches ``share`` of its whole."""
    out = None
    for k, knots in enumerate(schedules):
        areas = [(t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(knots, knots[1:])]
        whole, done = sum(areas), 0.0
        if not whole > 0 or min(weight for _, weight in knots) < 0:
            raise ValueError(f"a schedule needs weights of 0 or more and one above: {knots}")
        pieces = []
        for (t0, a), (t1, b), area in zip(knots, knots[1:], areas):
            slope = (b - a) / (t1 - t0)
            need = share * whole - done
            # a*x + slope*x*x/2 = need, by the root that is stable for small slopes
            x = F.try_divide(2 * need, a + F.sqrt(F.greatest(F.lit(a * a) + 2 * slope * need, F.lit(0.0))))
            pieces.append((done + area, t0 + F.coalesce(x, F.lit(0.0))))  # nothing is needed where a schedule starts at 0
            done += area
        here = pieces[-1][1]
        for upto, time in reversed(pieces[:-1]):
            here = F.when(share * whole <= upto, time).otherwise(here)
        out = here if out is None else F.when(F.pmod(rank - 1, F.lit(len(schedules))) == k, here).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def _with_shape(rows: DataFrame, shape: DataFrame, few: bool) -> DataFrame:
    """``rows`` (source, slot_hash, ...) with their source's numbers and their slice. Sources that were counted to be few are
    broadcast; else both sides are salted, so that the rows of one source go to several tasks."""
    shape = shape.withColumnRenamed("source", "of_source")
    if few:
        joined = rows.join(F.broadcast(shape), F.col("source").eqNullSafe(F.col("of_source")))
    else:
        salted = shape.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("slot_hash"), F.lit(SALTS)).cast("int"))
        joined = rows.join(salted, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("salt") == F.col("of_salt"))).drop("salt", "of_salt")
    unit = F.conv(F.substring("slot_hash", 1, 8), 16, 10).cast("double") / float(2**32)
    return joined.drop("of_source").withColumn("slice", F.floor(unit * F.col("slices")).cast("int"))


def plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_repeats: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, rank, place, copies, taken and the columns ``carry`` for each row of
    ``docs`` (doc_id, text, source).

    Place is where the document starts in its source's stream. Whole rounds of a source are taken as often as they
    fit its target, then documents in order as long as half of them or more lies under it.
    """
    work = Workspace(docs.sparkSession, "mixing")
    columns = ["doc_id", "source", n_words().alias("size"), _hash().alias("slot_hash")]
    # what all sums are made from, written once; texts are not in it
    thin = work.keep(docs.select(*columns), "thin")
    targets = source_targets(thin.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_repeats)
    # so many slices of the hash's range that one has about SLICE_WORDS; they follow each other in the hash's order
    slices = F.greatest(F.lit(1), F.ceil(F.col("source_size") / SLICE_WORDS)).cast("int")
    shape = work.keep(targets.withColumn("slices", slices), "shape")
    few = shape.count() <= MOST_BROADCAST
    spread = _with_shape(docs.select(*columns, *carry) if carry else thin, shape, few)
    slice_sizes = _with_shape(thin, shape, few).groupBy("rank", "slice").agg(F.sum("size").alias("slice_size"))
    earlier = Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slice_sizes.select("rank", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("slice_start"))
    starts = work.keep(starts, "starts")  # a table of its own, so its size is known when the join with the documents is planned
    inside = Window.partitionBy("rank", "slice").orderBy("slot_hash", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = spread.join(starts, ["rank", "slice"]).withColumn("place", F.col("slice_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)).cast("long")
    rest = F.col("target") - rounds * F.col("source_size")
    extra = F.when(F.col("place") + F.col("size") / 2 <= rest, 1).otherwise(0)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.least(rounds + extra, F.lit(most_repeats)))
    return placed.withColumn("copies", copies.cast("int")).withColumn("taken", F.col("copies") * F.col("size"))


def _position(repeat: Column, schedules) -> Column:
    """Training time of a copy: its place in the source's stream of copies, through the inverse of the source's demand."""
    at = repeat * F.col("source_size") + F.col("place") + F.col("size") / 2
    share = F.when(F.col("target") > 0, at / F.col("target")).otherwise(F.lit(0.0))
    return _demand_inverse(share, F.col("rank"), schedules)


def schedule(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_repeats: int = 3, schedules=SCHEDULES) -> DataFrame:
    """A row for each row of ``docs`` with what :func:`plan` gives and the positions of its first and last copy (null if it
    isn't taken), sorted by the first over ranges."""
    planned = plan(docs, weights, most_repeats)
    taken = F.col("copies") > 0
    first, last = (F.when(taken, _position(r, schedules)) for r in (F.lit(0), F.col("copies") - 1))
    out = planned.withColumn("first_position", first).withColumn("last_position", last)
    return out.repartitionByRange("first_position", "slot_hash").sortWithinPartitions("first_position", "slot_hash")


def curriculum(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_repeats: int = 3, schedules=SCHEDULES) -> DataFrame:
    """The columns of ``docs``, a row for each copy that the mix takes, and mix_position (0..1) and mix_repeat; sorted
    by position over ranges."""
    docs = docs.drop("mix_position", "mix_repeat")
    others = [c for c in docs.columns if c not in ("doc_id", "source")]
    # the columns of docs wait in a struct, so none of their names meets one used here
    aside = docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in others]).alias("mix_row"))
    planned = plan(aside, weights, most_repeats, carry=("mix_row",)).where("copies > 0").withColumn("repeat", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    out = planned.withColumn("mix_position", _position(F.col("repeat"), schedules))
    keep = [F.col(c) if c in ("doc_id", "source") else F.col("mix_row")[c].alias(c) for c in docs.columns]
    ranged = out.repartitionByRange("mix_position", "slot_hash").sortWithinPartitions("mix_position", "slot_hash", "repeat")
    return ranged.select(*keep, "mix_position", F.col("repeat").alias("mix_repeat"))


#: What :func:`schedule` gives with its defaults, in DuckDB.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
w AS (SELECT *, ([1.0, 2.0, 3.0]::DOUBLE[])[((rank - 1) % 3)::INT + 1] AS weight FROM r),
c AS (
  SELECT *, (SELECT sum(source_size) FROM s)::DOUBLE AS total,
         coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM w),
l AS (SELECT *, (total - capped) / weight_left AS level, (total - capped) / weight_left * weight > 3.0::DOUBLE * source_size AS is_capped FROM c),
f AS (SELECT level AS free FROM l WHERE NOT is_capped ORDER BY source_size / weight, rank LIMIT 1),
t AS (SELECT source, source_size, rank, CASE WHEN is_capped THEN 3.0::DOUBLE * source_size ELSE weight * (SELECT free FROM f) END AS target FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.rank,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 1 END AS rounds
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT *, least(rounds + CASE WHEN place + size / 2.0::DOUBLE <= target - rounds * source_size THEN 1 ELSE 0 END, 3) AS fitting,
         CASE WHEN size = 0 THEN 1 ELSE fitting END AS copies,
         CASE WHEN target > 0 THEN (place + size / 2.0::DOUBLE) / target ELSE 0 END AS first_share,
         CASE WHEN target > 0 THEN ((copies - 1) * source_size + place + size / 2.0::DOUBLE) / target ELSE 0 END AS last_share
  FROM p)
SELECT doc_id, size, source_size, round(target, 6) AS target, (size * fitting)::BIGINT AS taken,
       CASE WHEN copies > 0 THEN round(least(greatest(CASE (rank - 1) % 3
         WHEN 0 THEN 2 * first_share / (0.5 + sqrt(greatest(0.25 + 2 * first_share, 0)))
         WHEN 1 THEN 2 * first_share / (1.5 + sqrt(greatest(2.25 - 2 * first_share, 0)))
         ELSE first_share END, 0), 1), 6) END AS first_position,
       CASE WHEN copies > 0 THEN round(least(greatest(CASE (rank - 1) % 3
         WHEN 0 THEN 2 * last_share / (0.5 + sqrt(greatest(0.25 + 2 * last_share, 0)))
         WHEN 1 THEN 2 * last_share / (1.5 + sqrt(greatest(2.25 - 2 * last_share, 0)))
         ELSE last_share END, 0), 1), 6) END AS last_position
FROM q
"""
