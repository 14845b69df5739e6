"""Column profile (A8), correlation with the label (A9), 2-D density.

Exact median without gathering a column: a selection by sketched brackets.  A
quantile sketch (bounded size, mergeable, one aggregate for all columns) gives two
values that enclose the wanted ranks; a second aggregate counts the values below and
inside the bracket; a bracket of few values is read and ranked, a larger one is
sketched again.  The first sketch needs no count, as the middle of a column is known
as a share: it is built in the read that takes counts and means, one for both middle
ranks.  The sketch works on ranks, so the spread of the values does not
matter: every round shrinks a bracket by ``SHRINK`` or more, and 10^11 rows take
three.  Infinities are ordinary values at the ends of the order.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

INF = float("inf")
ACCURACY = 10_000      # of the sketch: a rank is off by rows / ACCURACY at most
SHRINK = ACCURACY // 8
MAX_READ = 10_000      # values of a bracket that are read


class _Search:
    """One rank among the values of one column, inside an interval that excludes its ends."""

    def __init__(self, name: str, rank: int, n: int):
        self.name, self.rank = name, rank
        self.low, self.high = None, None  # the whole column
        self.below, self.inside, self.slack = 0, n, 4.0

    def scoped(self) -> Column:
        x = F.col(self.name)
        return x if self.low is None else F.when((x > self.low) & (x < self.high), x)

    def bracket(self) -> Column:
        """Two values, on either side of the wanted one unless the sketch erred."""
        width, at = self.slack / ACCURACY, self.rank - self.below
        return F.percentile_approx(self.scoped(), [max(0.0, at / self.inside - width),
                                                   min(1.0, (at + 1) / self.inside + width)], ACCURACY)

    def counts(self, low: float, high: float) -> list[Column]:
        x = F.col(self.name)
        return [F.count(F.when(c, 1)) for c in (x < low, x == low, (x > low) & (x < high), x == high)]

    def narrow(self, low: float, high: float, below: int, at_low: int, between: int, at_high: int) -> float | None:
        """The value, if it is an end of the bracket; else the search goes on between them."""
        if below <= self.rank < below + at_low:
            return low
        if low < high and 0 <= self.rank - below - at_low - between < at_high:
            return high
        if below + at_low <= self.rank < below + at_low + between:
            self.low, self.high, self.below, self.inside = low, high, below + at_low, between
        else:
            self.slack *= 4  # up to the whole interval
        return None


def middle_bracket(c: Column) -> Column:
    """Two values on either side of the middle ranks of ``c``, from a sketch that needs no count."""
    width = 4.0 / ACCURACY
    return F.percentile_approx(c, [0.5 - width, 0.5 + width], ACCURACY)


def exact_ranks(df: DataFrame, wanted: dict[str, list[int]], counts: dict[str, int],
                max_read: int = MAX_READ,
                brackets: dict[str, Sequence[float]] | None = None) -> dict[tuple[str, int], float]:
    """The values at 0-based ranks of (double) columns; NULL and NaN are left out.
    ``counts`` is the number of values of each column, ``brackets`` two values per column
    that probably enclose its ranks (a wrong one costs a round, never the result)."""
    numbers = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in wanted])
    open_ = [_Search(c, r, counts[c]) for c, ranks in wanted.items() for r in sorted(set(ranks))]
    found: dict[tuple[str, int], float] = {}
    while open_:
        small = [s for s in open_ if s.inside <= max_read and s.low is not None]
        if small:
            got = numbers.agg(*[F.array_sort(F.collect_list(s.scoped())).alias(f"v{i}") for i, s in enumerate(small)]).first()
            found |= {(s.name, s.rank): got[i][s.rank - s.below] for i, s in enumerate(small)}
        open_ = [s for s in open_ if (s.name, s.rank) not in found]
        if not open_:
            break
        if brackets:
            ends, brackets = [brackets[s.name] for s in open_], None
        else:
            ends = numbers.agg(*[s.bracket().alias(f"b{i}") for i, s in enumerate(open_)]).first()
        placed = numbers.agg(*[c.alias(f"c{i}_{j}") for i, s in enumerate(open_) for j, c in enumerate(s.counts(*ends[i]))]).first()
        for i, s in enumerate(open_):
            value = s.narrow(*ends[i], *placed[4 * i:4 * i + 4])
            if value is not None:
                found[s.name, s.rank] = value
        open_ = [s for s in open_ if (s.name, s.rank) not in found]
    return found


def column_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mean, median) per column; the median is exact (the mean of the
    two middle values for an even count).  ``df`` is read three times at most up to some
    10^7 rows (two more for every further factor of ``SHRINK``): store it."""
    spark = df.sparkSession
    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    number = {c: F.when(~F.isnan(c), F.col(c)) for c in cols}
    first = data.agg(*[e for c in cols for e in (F.count(number[c]).alias(f"n_{c}"), F.avg(number[c]).alias(f"avg_{c}"),
                                                 middle_bracket(number[c]).alias(f"mid_{c}"))]).first()
    n = {c: first[f"n_{c}"] for c in cols}
    ranks = {c: [(n[c] - 1) // 2, n[c] // 2] for c in cols if n[c]}
    value = exact_ranks(data, ranks, n, brackets={c: first[f"mid_{c}"] for c in ranks}) if ranks else {}
    rows = []
    for c in cols:
        lo, hi = (value[c, r] for r in ranks[c]) if c in ranks else (None, None)
        gap = None if lo is None else hi - lo
        mid = None if lo is None else lo if lo == hi else lo + gap * 0.5 if math.isfinite(gap) else lo / 2 + hi / 2
        rows.append((c, first[f"avg_{c}"], mid))
    schema = StructType([StructField("column_name", StringType()),
                         StructField("mean", DoubleType()), StructField("median", DoubleType())])
    return spark.createDataFrame(rows, schema)


def _finite(c: str):
    x = F.col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(INF))


def correlations(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Pearson r of each column with ``label`` over rows where both are set.

    NULL for a constant column (no division-by-zero error).  One aggregate
    pass, then the one-row result is unpivoted.
    """
    aggs = []
    for c in cols:
        both = F.col(c).isNotNull() & F.col(label).isNotNull()
        x = F.when(both, F.col(c).cast("double"))
        y = F.when(both, F.col(label).cast("double"))
        aggs.append(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(c))
    one = df.agg(*aggs)
    return one.unpivot([], list(cols), "column_name", "r")


def density_2d(df: DataFrame, y: str, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """Counts on a ``bins`` x ``bins`` grid of (column, y) per column.

    Each axis spans the column's own [min, max] over rows where both values
    are finite numbers (as a scatter plot shows them); the top edge falls in
    the last bin; a constant axis is bin 0.
    """
    long = (df.select(*[F.col(c).cast("double").alias(c) for c in cols],
                      F.col(y).cast("double").alias("_y"))
            .unpivot(["_y"], list(cols), "column_name", "x")
            .filter(_finite("x") & _finite("_y")))
    ranges = long.groupBy("column_name").agg(
        F.min("x").alias("x_min"), F.max("x").alias("x_max"),
        F.min("_y").alias("y_min"), F.max("_y").alias("y_max"))
    # One row per profiled column: a proven-small side.
    placed = long.join(F.broadcast(ranges), "column_name")

    def bin_of(v: str, lo: str, hi: str):
        width = F.col(hi) - F.col(lo)
        raw = F.floor((F.col(v) - F.col(lo)) / width * F.lit(bins))
        return F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")

    return (placed.select("column_name", bin_of("x", "x_min", "x_max").alias("x_bin"),
                          bin_of("_y", "y_min", "y_max").alias("y_bin"))
            .groupBy("column_name", "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n_rows")))
