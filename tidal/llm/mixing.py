"""Mixing sources to target weights by entropy balancing, natively.

Targets: the sources, by code point with null last, weigh ``weights`` in
turn and share ``total`` times all words; a target stops at ``cap`` times its
source's words and the excess is shared again by weight (``targets``).

Rates: of all document rates that meet the sources' word targets, the ones
with the largest entropy are exp(lambda_s * size / mean size of s), cut at
``cap``. lambda solves the convex dual: one safeguarded Newton step for all
sources is one aggregation over the counts of (source, size), which stand for
the documents exactly, since equal sizes of a source have equal rates.

Copies: a rate's fraction is rounded by a hash of the id, and what a source
then lacks or exceeds is evened out by adding or removing one copy of further
documents in hash order, as long as they fit, ``ROUNDS`` times. Prefixes in
hash order are found by sums over hash buckets, so no source passes through
one task. No document gets more than ``cap`` copies.

Defined cases: a text without words (or null) has size 0 and no copies; a null
source is one source, the last; the n repeated rows of an id, source and text
share their copies, each getting the n-th part, some one more; an empty table
gives an empty result; extra columns are not read, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, stored, unused

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
CAP = 2
WORDS = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096
SALTS = 64
ROUNDS = 4
STEPS = 60
TOLERANCE = 1e-9


KEY = ("doc_id", "source", "size", "text_hash")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, text_hash, n): documents with their words; n equal rows."""
    return docs.select(*_key(id_col, text_col, source_col)).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))


def _key(id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> list:
    size = F.coalesce(F.regexp_count(F.col(quoted(text_col)), F.lit(WORDS)), F.lit(0)).cast("long")
    return [F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(source_col)).alias("source"), size.alias("size"),
            F.xxhash64(quoted(text_col)).alias("text_hash")]


def targets(by_source: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: float = CAP) -> DataFrame:
    """(source, source_size, target). One row per source: the capped sources
    are those first in order of cap * size / weight for which the common
    level of the others would be too high."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = reduce(lambda e, kv: e.when(turn % len(weights) == kv[0], F.lit(float(kv[1]))), enumerate(weights), F)
    w = by_source.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = (w.withColumn("goal", total * F.sum("source_size").over(everything))
            .withColumn("level", (F.col("goal") - F.coalesce(F.sum("most").over(before), F.lit(0)))
                        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
            .withColumn("fits", F.col("level") * F.col("weight") <= F.col("most")))
    common = F.min(F.when(F.col("fits"), F.struct("place", "level"))).over(everything)["level"]  # the first that fits
    return (sums.withColumn("place", F.row_number().over(order)).withColumn("common", common)
            .select("source", "source_size",
                    F.least(F.coalesce(F.col("common") * F.col("weight"), F.col("most").cast("double")),
                            F.col("most").cast("double")).alias("target")))


def solve(counts: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, lambda, mean_size): Newton on the dual, all sources at once.
    ``counts`` has (source, size, n); sources at the cap get no lambda."""
    scale = counts.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean_size"))
    state = stored(goals.join(scale, goals["source"].eqNullSafe(scale["source"])).drop(scale["source"])
                   .where((F.col("target") > 0) & (F.col("target") < cap * F.col("source_size")))
                   .select("source", "target", "mean_size", F.lit(0.0).alias("lam"), F.lit(-1e4).alias("low"),
                           F.lit(1e4).alias("high"), F.lit(False).alias("done")), "dual-0")
    s = state.withColumnRenamed("source", "of")
    for step in range(1, STEPS + 1):
        tilt = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean_size"), F.lit(20.0)))
        words = F.col("size") * F.col("n")
        free = tilt < cap
        joined = counts.join(s, counts["source"].eqNullSafe(s["of"]))
        g = joined.groupBy("of", "target", "mean_size", "lam", "low", "high", "done").agg(
            F.sum(words * F.least(tilt, F.lit(float(cap)))).alias("got"),
            F.sum(F.when(free, words * tilt * F.col("size") / F.col("mean_size")).otherwise(0.0)).alias("slope"))
        miss = F.col("got") - F.col("target")
        done = F.col("done") | (F.abs(miss) <= TOLERANCE * F.col("target")) | (F.col("high") - F.col("low") < 1e-12)
        low, high = F.when(miss < 0, F.col("lam")).otherwise(F.col("low")), F.when(miss > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("lam") - miss / F.col("slope"))
        g = g.select("of", "target", "mean_size", "lam", low.alias("low"), high.alias("high"), done.alias("done"),
                     newton.alias("newton"))
        inside = F.col("newton").isNotNull() & (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
        # outside the bracket: halve it, or its scale while it is still wide
        half = F.when((F.col("low") < -1) & (F.col("high") <= 0), -F.sqrt(F.col("low") * F.least(F.col("high"), F.lit(-1e-3)))) \
            .when((F.col("high") > 1) & (F.col("low") >= 0), F.sqrt(F.col("high") * F.greatest(F.col("low"), F.lit(1e-3)))) \
            .otherwise((F.col("low") + F.col("high")) / 2)
        s = stored(g.select("of", "target", "mean_size",
                            F.when(F.col("done"), F.col("lam")).when(inside, F.col("newton")).otherwise(half).alias("lam"),
                            "low", "high", "done"), f"dual-{step}")
        if s.agg(F.count_if(~F.col("done"))).first()[0] == 0:  # one number
            break
    return s.select(F.col("of").alias("source"), "lam", "mean_size")


def unit_hash(*cols):
    """A number from 0 to 1 (exclusive) from the columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / float(1 << 52)


def even_out(docs: DataFrame, step: int, cap: int) -> DataFrame:
    """One copy more or less for documents in hash order while they fit into
    what their source lacks or exceeds. Of n equal rows as many change as fit."""
    gap = docs.groupBy("source", "target").agg((F.col("target") - F.sum(F.col("size") * F.col("copies"))).alias("gap")) \
        .select(F.col("source").alias("of"), "gap")
    d = docs.join(gap, docs["source"].eqNullSafe(gap["of"])).drop("of")
    able = F.least(F.col("n"), F.when(F.col("gap") > 0, cap * F.col("n") - F.col("copies")).otherwise(F.col("copies")))
    d = d.withColumn("able", F.when((F.col("size") > 0) & (F.col("size") <= F.abs("gap")), able).otherwise(0))
    spot = unit_hash("doc_id", "size", F.lit(f"even {step}"))
    movers = d.where("able > 0").withColumn("spot", spot).withColumn("bucket", F.floor(F.col("spot") * BUCKETS).cast("int"))
    weight = F.col("size") * F.col("able")
    sums = movers.groupBy("source", "bucket").agg(F.sum(weight).alias("words"))
    run = Window.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("upto", F.sum("words").over(run)).select(
        F.col("source").alias("of"), F.col("bucket").alias("at"), (F.col("upto") - F.col("words")).alias("before"), "upto")
    m = movers.join(sums, movers["source"].eqNullSafe(sums["of"]) & (movers["bucket"] == sums["at"])).drop("of", "at")
    room, sign = F.abs("gap"), F.signum("gap").cast("long")
    edge = (F.col("before") < room) & (F.col("upto") > room)
    inner = Window.partitionBy("source", "bucket").orderBy("spot", *KEY)
    # only the documents of the one bucket in which a source's gap ends are sorted
    left = room - (F.col("before") + F.sum(weight).over(inner) - weight)
    some = F.least(F.col("able"), F.floor(F.greatest(left, F.lit(0)) / F.col("size")))
    split = m.where(edge).withColumn("copies", F.col("copies") + sign * some)
    rest = m.where(~edge).withColumn("copies", F.col("copies") + F.when(F.col("upto") <= room, sign * F.col("able")).otherwise(0))
    out = d.where("able = 0").select(*docs.columns)
    return stored(out.unionByName(rest.select(*docs.columns)).unionByName(split.select(*docs.columns)), f"copies-{step}")


def mix(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: int = CAP, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, source, size, text_hash, n, source_size, target, rate, copies):
    one row for the n equal rows of an id, source and text, with the copies of
    all n together."""
    base = stored(sizes(docs), "sizes")
    counts = stored(base.where("size > 0").groupBy("source", "size").agg(F.sum("n").alias("n")), "counts")
    goals = stored(targets(base.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
                           weights, total, cap), "targets")
    dual = solve(counts, goals, cap)
    facts = goals.join(dual, goals["source"].eqNullSafe(dual["source"]), "left").drop(dual["source"]) \
        .withColumnRenamed("source", "of")
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("lam").isNull(), F.when(F.col("target") > 0, float(cap)).otherwise(0.0)) \
        .otherwise(F.least(F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean_size"), F.lit(20.0))), F.lit(float(cap))))
    d = base.join(facts, base["source"].eqNullSafe(facts["of"])).withColumn("rate", rate)
    share = F.col("rate") * F.col("n")
    copies = F.floor(share) + (unit_hash("doc_id", "size", F.lit("round")) < share - F.floor(share)).cast("long")
    d = stored(d.withColumn("copies", copies.cast("long")).drop("of", "lam", "mean_size"), "copies-0")
    for step in range(1, rounds + 1):
        d = even_out(d, step, cap)
    return d


def copies_of(row) -> F.Column:
    """Copies of the row-th of the n equal rows (from 1)."""
    return F.floor(F.col("copies") / F.col("n")) + (row <= F.col("copies") % F.col("n")).cast("long")


def repeated(docs: DataFrame) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it. Null ids
    and sources, repeated rows and clashing columns are handled as in ``mix``."""
    row, place, salt = unused(docs.columns, "row", "place", "salt")
    m = mix(docs).where("copies > 0").select(F.struct(*KEY).alias("of"), "n", "copies")
    d = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(row), F.struct(*_key()).alias("key"))
    on = None
    for c in KEY:
        same = F.col(f"key.{c}").eqNullSafe(F.col(f"of.{c}"))
        on = same if on is None else on & same
    j = d.join(m, on)
    once = j.where("n = 1").withColumn(place, F.lit(1).cast("long"))
    # equal rows are told apart in salted parts, each with its share of the places
    many = j.where("n > 1").withColumn(salt, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)))
    many = stored(many, "equal-rows")
    parts = many.groupBy("key", salt).agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("key").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col("key").alias("k"), F.col(salt).alias("s"), before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("key", salt).orderBy(F.lit(1)))
    many = many.withColumn("inside", inside).join(parts, F.col("key").eqNullSafe(F.col("k")) & (F.col(salt) == F.col("s"))) \
        .withColumn(place, F.col("before") + F.col("inside"))
    all_ = once.select(row, place, "n", "copies").unionByName(many.select(row, place, "n", "copies"))
    taken = all_.select(row, copies_of(F.col(place)).alias("taken")).where("taken > 0")
    return taken.select(row, F.explode(F.sequence(F.lit(1).cast("long"), F.col("taken")))).select(
        *[F.col(f"{row}.{quoted(c)}").alias(c) for c in docs.columns])
