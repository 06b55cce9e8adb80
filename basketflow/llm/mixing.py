"""Mixing sources to target weights by entropy balancing, on DataFrame functions only.

Every document gets the rate r = min(3, exp(l * size / mean size of its source)) closest to 1 in
relative entropy under one constraint per source: the rates times sizes add up to the source's
target. The convex dual has one multiplier l per source; guarded Newton steps solve it on
the distributed histogram (source, size, number of documents), which is exact because the rate
depends on the size only. Rates then become whole copies by systematic rounding along a fixed
order, so that the running total of copies follows the running total of rates.

Targets: all sizes are shared by weights 5, 2, 1, repeating over the sources in code point order
(null last); a source stops at three times its size and the excess is shared again by weight.

Defined cases: a null text has size 0 and, like every text without words, one copy; null and
empty sources are sources of their own; repeated rows are mixed one by one; a null doc_id is an id
like any other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import texts as tx

WEIGHTS = (5, 2, 1)
LIMIT = 3                # copies at most
STEPS = 40               # Newton steps at most; about eight are needed
TOLERANCE = 1e-9         # of a source's target
STRIP = 512              # documents that are rounded in one running order, about
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, source and number of words; with ``carry`` also the whole row as ``row``."""
    row = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []
    return docs.select("doc_id", "source", F.coalesce(
        F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *row)


def _order(source: str = "source") -> list[Column]:
    return [F.col(source).isNull(), F.encode(F.col(source), "UTF-8")]


def targets(per_source: DataFrame) -> DataFrame:
    """Adds target to (source, source_size): water filling under the limit, in closed form.

    Sorted by limit over weight, sources fill up in that order; a source is full when its limit is
    below its share of what the full ones leave. The windows see one row a source.
    """
    everything = Window.partitionBy()
    ranked = per_source.withColumn("rank", F.row_number().over(
        Window.orderBy(*_order())) - 1)
    place = F.col("rank") % len(WEIGHTS)
    weight = F.lit(float(WEIGHTS[-1]))
    for k, w in reversed(list(enumerate(WEIGHTS[:-1]))):
        weight = F.when(place == k, F.lit(float(w))).otherwise(weight)
    by_need = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    filled = (ranked.withColumn("weight", weight)
              .withColumn("limit", F.col("source_size") * float(LIMIT))
              .withColumn("left", F.sum("source_size").over(everything)
                          - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
              .withColumn("open", F.sum("weight").over(everything)
                          - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("level", F.col("left") / F.col("open"))
              .withColumn("full", F.col("limit") <= F.col("level") * F.col("weight")))
    level = F.max(F.when(~F.col("full"), F.struct(-F.col("rank_need"), F.col("level"))))
    filled = filled.withColumn("rank_need", F.row_number().over(by_need))
    filled = filled.withColumn("rest", level.over(everything)["level"])
    return filled.select("source", "source_size", F.when(
        F.col("full") | F.col("rest").isNull(), F.col("limit"))
        .otherwise(F.least(F.col("limit"), F.col("weight") * F.col("rest"))).alias("target"))


def rate(multiplier: Column, size: Column, mean: Column) -> Column:
    """min(LIMIT, exp(l * size / mean)); an unbounded multiplier gives the limit."""
    x = multiplier * size / mean
    return F.when(x >= F.log(F.lit(float(LIMIT))), F.lit(float(LIMIT))).otherwise(F.exp(x))


def multipliers(histogram: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, target, mean, l): the dual solved by Newton steps kept inside a bracket.

    Each step is one distributed aggregation over the histogram; the state has one row a source.
    """
    same = F.col("h.source").eqNullSafe(F.col("s.source"))
    state = (goals.withColumn("l", F.lit(0.0)).withColumn("low", F.lit(-745.0))
             .withColumn("high", F.lit(float(1 << 20))))
    state = tx.stored(state, "mix-state")
    for _ in range(STEPS):
        x = F.col("size") / F.col("mean")
        r = rate(F.col("l"), F.col("size"), F.col("mean"))
        words = F.col("n") * F.col("size")
        slope = F.when(r < LIMIT, r * x).otherwise(0.0)
        sums = (histogram.alias("h").join(state.alias("s"), same)
                .groupBy("s.source", "source_size", "target", "mean", "l", "low", "high")
                .agg(F.sum(words * r).alias("got"), F.sum(words * slope).alias("slope")))
        miss = F.col("got") - F.col("target")
        low = F.when(miss <= 0, F.greatest("l", "low")).otherwise(F.col("low"))
        high = F.when(miss >= 0, F.least("l", "high")).otherwise(F.col("high"))
        step = F.col("l") - miss / F.when(F.col("slope") > 0, F.col("slope"))
        middle = F.when(high >= (1 << 19), F.greatest(F.lit(1.0), low * 2)) \
            .otherwise((low + high) / 2)
        done = F.abs(miss) <= TOLERANCE * F.col("target")
        state = tx.stored(sums.select(
            "source", "source_size", "target", "mean",
            F.when(done, F.col("l")).when((step > low) & (step < high), step)
            .otherwise(middle).alias("l"),
            low.alias("low"), high.alias("high"), done.alias("done")), "mix-state")
        if state.filter("NOT done").isEmpty():
            break
        state = state.drop("done")
    return state.select("source", "source_size", "target", "mean", "l")


def _facts(own: DataFrame) -> DataFrame:
    """One row a source: its size, target and multiplier."""
    histogram = tx.stored(own.groupBy("source", "size").agg(F.count("*").alias("n")),
                          "mix-histogram")
    per_source = histogram.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum("n").alias("documents"))
    goals = tx.stored(targets(per_source.select("source", "source_size")), "mix-targets")
    solvable = (goals.alias("g").join(per_source.alias("p"), F.col("g.source").eqNullSafe(
        F.col("p.source"))).filter("g.source_size > 0")
        .select("g.source", "g.source_size", "target",
                (F.col("g.source_size") / F.col("documents")).alias("mean")))
    solved = multipliers(histogram.filter("size > 0"), solvable)
    return tx.stored(
        goals.alias("g").join(solved.alias("m"), F.col("g.source").eqNullSafe(F.col("m.source")),
                              "left")
        .join(per_source.alias("p"), F.col("g.source").eqNullSafe(F.col("p.source")))
        .select(F.col("g.source").alias("of"), F.col("g.source_size").alias("source_size"),
                F.col("g.target").alias("target"), "mean", "l", "documents"), "mix-facts")


def _mix(own: DataFrame, facts: DataFrame) -> DataFrame:
    return rounded(
        own.join(facts, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("rate", F.when((F.col("size") == 0) | F.col("l").isNull(), F.lit(1.0))
                    .otherwise(rate(F.col("l"), F.col("size"), F.col("mean")))))


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken of every row."""
    own = tx.stored(sizes(docs), "mix-sizes")
    return _mix(own, _facts(own)).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def rounded(rated: DataFrame) -> DataFrame:
    """Adds copies: whole numbers next to the rates whose running totals stay together.

    Documents of a source are dealt into strips by hash, so no window holds a hot source. In a strip,
    ordered by size, the copies up to a document are the rates up to it plus the strip's
    offset, rounded down. Neighbours in size make up for each other, which keeps the words taken
    near the target too. Offsets are spread evenly over a source's strips.
    """
    strips = F.ceil(F.col("documents") / STRIP).cast("long")
    place = F.pmod(F.xxhash64("doc_id", "size"), strips)
    offset = F.pmod((place + 0.5) * F.lit(0.6180339887498949), F.lit(1.0))
    strip = Window.partitionBy("source", "strip").orderBy("size", "doc_id")
    total = F.sum("rate").over(strip.rowsBetween(Window.unboundedPreceding, 0))
    # Sums of rates carry rounding noise; a rate that is whole must stay whole.
    upto = F.floor(F.round(total, 6) + F.col("offset"))
    return (rated.withColumn("strip", place).withColumn("offset", offset)
            .withColumn("upto", upto)
            .withColumn("copies", F.least(F.lit(LIMIT), F.greatest(F.lit(0), (
                F.col("upto") - F.coalesce(F.lag("upto").over(strip), F.lit(0)))))
                .cast("long")))


def repeat(docs: DataFrame) -> DataFrame:
    """``docs`` with every row as often as its copies say, columns as they came."""
    facts = _facts(tx.stored(sizes(docs), "mix-sizes"))
    return (_mix(sizes(docs, carry=True), facts).filter("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("row.*"))
