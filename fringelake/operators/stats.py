"""Stack, block and robust statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def block(df: DataFrame, size: int, f) -> DataFrame:
    return df.groupBy(F.floor(F.col("r") / size).alias("br"), F.floor(F.col("c") / size).alias("bc")).agg(f("z").alias("z"))


def ordered_means(df: DataFrame, by: list[str], order: list[str], values: dict[str, Column]) -> DataFrame:
    """Means of groups, summed row after row in the given order; ``order`` is the group's first row.

    A sum of doubles depends on its order in the last bit, and a threshold or a rank on that bit. The order must be total.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    means = [F.avg(x).over(running).alias(name) for name, x in values.items()]
    first = F.first(F.struct(*order)).over(running).alias("order")
    return df.select(*by, first, *means, F.lead(F.lit(True)).over(w).alias("more")).where("more is null").drop("more")


HELD = 100_000  # values that a last step may order


def at_ranks(df: DataFrame, column: str, ranks: list[int]) -> list[float]:
    """The values at some ranks (from 1) of a column's order, exactly, without ordering the column.

    For each rank, approximate quantiles bound the value, rows below are counted, and the rest is bounded again, until the
    bounds meet or hold few enough values to be ordered.
    """
    known, out = df.where(F.col(column).isNotNull()).select(F.col(column).alias("v")), []
    for rank in ranks:
        rest, n, k = known, known.count(), rank
        while True:
            if n <= HELD:
                out.append(rest.orderBy("v").offset(k - 1).limit(1).first()[0])
                break
            low, high = rest.agg(F.percentile_approx("v", [max(0.0, k / n - 0.001), min(1.0, k / n + 0.001)], 10_000)).first()[0]
            below, inside = rest.agg(F.count_if(F.col("v") < low), F.count_if(F.col("v").between(low, high))).first()
            if low == high or not below < k <= below + inside or inside == n:
                if low == high and below < k <= below + inside:
                    out.append(low)
                    break
                # bounds that miss the rank, or do not narrow: half of the values by the middle one
                mid = rest.agg(F.percentile_approx("v", 0.5, 10_000)).first()[0]
                upto = rest.where(F.col("v") <= mid).count()
                rest, n, k = (rest.where(F.col("v") <= mid), upto, k) if k <= upto else (rest.where(F.col("v") > mid), n - upto, k - upto)
                if rest.agg(F.min("v") == F.max("v")).first()[0]:
                    out.append(rest.first()[0])
                    break
                continue
            rest, n, k = rest.where(F.col("v").between(low, high)), inside, k - below
    return out


def _row(df: DataFrame, names: list[str], values: list) -> DataFrame:
    return df.sparkSession.createDataFrame([tuple(None if v is None else float(v) for v in values)], ", ".join(f"{n} double" for n in names))


def iqr_bounds(df: DataFrame, column: str) -> DataFrame:
    """Quartiles at positions (n + 1) / 4 and 3 (n + 1) / 4, interpolated; bounds 1.5 ranges beyond."""
    n = df.where(F.col(column).isNotNull()).count()
    if not n:
        return _row(df, ["q1", "q3", "lo", "hi"], [None] * 4)
    q = []
    for share in (0.25, 0.75):
        position = (n + 1) * share
        whole = int(position)
        low, high = at_ranks(df, column, [max(1, whole), min(n, whole + 1)])
        q.append(low + (position - whole) * (high - low))
    return _row(df, ["q1", "q3", "lo", "hi"], [*q, q[0] - 1.5 * (q[1] - q[0]), q[1] + 1.5 * (q[1] - q[0])])


def zscore_bounds(df: DataFrame, column: str, k: float = 3) -> DataFrame:
    m, s = F.avg(column), F.stddev_pop(column)
    return df.agg((m - k * s).alias("lo"), (m + k * s).alias("hi"))


def lower_median(df: DataFrame, column: str) -> float | None:
    n = df.where(F.col(column).isNotNull()).count()
    return at_ranks(df, column, [(n + 1) // 2])[0] if n else None


def upper_median(df: DataFrame, column: str) -> DataFrame:
    n = df.where(F.col(column).isNotNull()).count()
    return _row(df, ["upper_median"], at_ranks(df, column, [n // 2 + 1]) if n else [None])


def mad_bounds(df: DataFrame, column: str) -> DataFrame:
    """Lower medians; bounds 3.29 MAD / 0.6745 about the median."""
    m = lower_median(df, column)
    if m is None:
        return _row(df, ["m", "mad", "lo", "hi"], [None] * 4)
    mad = lower_median(df.select(F.abs(F.col(column) - m).alias("d")), "d")
    return _row(df, ["m", "mad", "lo", "hi"], [m, mad, m - 3.29 * mad / 0.6745, m + 3.29 * mad / 0.6745])


def plane(df: DataFrame) -> DataFrame:
    """z = a + b x + c y by normal equations from one pass of sums, centred."""
    cov = {k: F.covar_pop(*k.split()) for k in ("x x", "x y", "y y", "x z", "y z")}
    s = df.agg(*[v.alias(k.replace(" ", "")) for k, v in cov.items()], F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg("z").alias("mz"))
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    s = s.withColumn("b", (F.col("xz") * F.col("yy") - F.col("yz") * F.col("xy")) / F.nullif(det, F.lit(0.0))).withColumn("c", (F.col("yz") * F.col("xx") - F.col("xz") * F.col("xy")) / F.nullif(det, F.lit(0.0)))
    return s.select((F.col("mz") - F.col("b") * F.col("mx") - F.col("c") * F.col("my")).alias("a"), "b", "c")


def convolve(grid: DataFrame, kernel: list[tuple[int, int, float]]) -> DataFrame:
    """Normalised convolution: each cell is sent to its neighbours' keys, one shuffle; sums over the used weights."""
    k = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(w).alias("w")) for i, j, w in kernel]))
    sent = grid.where("z is not null").select("r", "c", "z", k.alias("k")).select((F.col("r") - F.col("k.i")).alias("r"), (F.col("c") - F.col("k.j")).alias("c"), F.col("k.w").alias("w"), "z")
    out = sent.groupBy("r", "c").agg(F.sum(F.col("w") * F.col("z")).alias("s"), F.sum("w").alias("w"))
    return grid.select("r", "c").join(out, ["r", "c"]).where(F.abs("w") > 0.05 * sum(abs(w) for *_, w in kernel)).select("r", "c", (F.col("s") / F.col("w")).alias("z"))
