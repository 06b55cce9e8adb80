"""Quantile cut points of several columns at once."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import GMV_TYPE

QUINTILES = ("0.2", "0.4", "0.6", "0.8")


def approx_quantiles(rows: DataFrame, columns: list[str], relative_error: float = 0.01,
                     probs: tuple[str, ...] = QUINTILES) -> DataFrame:
    """One row with an array of cut points per column, rank error within ``relative_error``.

    Every task keeps a summary whose size depends on the error, not on the rows.
    """
    accuracy = max(1, round(1 / relative_error))
    wanted = [float(p) for p in probs]
    return rows.agg(*[
        F.percentile_approx(F.col(c).cast(GMV_TYPE), wanted, accuracy).alias(c) for c in columns])


SKETCH = 2000       # size of the quantile sketches: about 15 KB each
MARGIN = 0.01       # four times their rank error at 99 % confidence
CELLS = 16_384      # an interval is counted in so many cells at most


def exact_quantiles(rows: DataFrame, columns: list[str],
                    probs: tuple[str, ...] = QUINTILES) -> DataFrame:
    """The same row with exact discrete quantiles: the smallest value whose share reaches p.

    One pass sketches every column, which brackets each quantile between two values. The next counts
    rows: exactly in the cells of a bracket, and in one sum each before, between and after them.
    Running totals over the cells tell which cell holds the rank. A bracket of up to ``CELLS``
    different cents is settled by that pass, a wider one by another inside the cell found. Should a
    sketch have missed, the rank lies in one of the sums, and that stretch is the next bracket: the
    result never rests on the sketch. Shuffles and running totals are bounded by the cells; a few
    numbers per column and quantile come to the driver.

    ``rows`` are read in every pass, so pin them if they are dear to make.
    """
    codes = {c: (F.col(c).cast(GMV_TYPE) * 100).cast("bigint") for c in columns}
    share = [Decimal(p) for p in probs]
    sketched = rows.select(*[code.alias(c) for c, code in codes.items()]).agg(*[
        f for c in columns for f in (
            F.count(c).alias(f"{c}_n"), F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high"),
            F.kll_sketch_agg_bigint(c, SKETCH).alias(f"{c}_sketch"))])
    sides = [F.lit(min(max(float(p) + side, 0.0), 1.0)) for p in share for side in (-MARGIN, MARGIN)]
    row = sketched.select(
        *[f"{c}_{x}" for c in columns for x in ("n", "low", "high")],
        *[F.when(F.col(f"{c}_n") > 0, F.array(*[
            F.kll_sketch_get_quantile_bigint(f"{c}_sketch", p) for p in sides])).alias(c)
          for c in columns]).first()
    filled = [c for c in columns if row[f"{c}_n"]]
    ends = {c: (row[f"{c}_low"], row[f"{c}_high"]) for c in filled}
    ranks = {c: [max(1, math.ceil(p * row[f"{c}_n"])) for p in share] for c in filled}
    held = {c: list(zip(row[c][::2], row[c][1::2])) for c in filled}
    unsettled = filled                  # brackets of one value are counted too before they are believed
    while unsettled:
        pieces = {c: _pieces(held[c], *ends[c]) for c in unsettled}
        held |= _cells_of_ranks(rows, codes, pieces, ranks)
        unsettled = [c for c in unsettled if any(a < b for a, b in held[c])]
    cuts = {c: [Decimal(a).scaleb(-2) for a, _ in held[c]] if c in held else [None] * len(share)
            for c in columns}
    return rows.sparkSession.range(1).select(*[
        F.array(*[F.lit(v).cast(GMV_TYPE) for v in cuts[c]]).alias(c) for c in columns])


def _pieces(held: list[tuple[int, int]], low: int, high: int) -> list[tuple[int, int, int]]:
    """All values from low to high as (first, last, width of a cell): brackets in cells, each gap
    between them as one."""
    pieces, at = [], low
    for a, b in sorted(set(held)):
        a = max(a, at)
        if a > b:
            continue
        if at < a:
            pieces.append((at, a - 1, a - at))
        pieces.append((a, b, -(-(b - a + 1) // CELLS)))
        at = b + 1
    if at <= high:
        pieces.append((at, high, high - at + 1))
    return pieces


def _cells_of_ranks(rows: DataFrame, codes: dict[str, Column], pieces: dict, ranks: dict
                    ) -> dict[str, list[tuple[int, int]]]:
    """One pass: for each column the cell (first, last value) that holds each of its ranks."""
    def cell(c: str) -> Column:
        code = codes[c]
        first = [code - F.pmod(code - F.lit(a), F.lit(width)) for a, _, width in pieces[c]]
        chosen = first[0]
        for (a, _, _), value in zip(pieces[c][1:], first[1:]):
            chosen = F.when(code >= a, value).otherwise(chosen)
        return chosen

    keyed = rows.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), cell(c).alias("cell")) for c in pieces])))
    counted = keyed.filter("cell IS NOT NULL").groupBy("metric", "cell").agg(
        F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("metric").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    totals = counted.withColumn("upto", F.sum("n").over(running))
    wanted = F.lit(False)
    for c in pieces:
        for r in ranks[c]:
            wanted = wanted | ((F.col("metric") == c) & (F.col("upto") >= r)
                               & (F.col("upto") - F.col("n") < r))
    hits = totals.filter(wanted).collect()      # one row per column and quantile at most
    out = {}
    for c in pieces:
        out[c] = []
        for r in ranks[c]:
            first = next(h.cell for h in hits
                         if h.metric == c and h.upto - h.n < r <= h.upto)
            last, width = next((b, w) for a, b, w in pieces[c] if a <= first <= b)
            out[c].append((first, min(first + width - 1, last)))
    return out
