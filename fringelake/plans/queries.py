"""The registered queries of the raster engine, each with its SQL."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import algebra as A
from ..functions.bitmask import compile_flags
from ..operators import joins, stats, tiles
from ..sources.params import last_wins
from ..streaming.events import repaired, running_stack
from .views import CELLS, OFFSETS, PAIRS, SCENES, STACK, Views

_found: dict[str, tuple[Callable[[Views], DataFrame], str | None]] = {}
LAMBDA = 0.0311
PI = math.pi


def query(sql: str | None):
    def add(f):
        _found[f.__name__] = f, sql
        return f

    return add


def r9(x, name: str):
    return F.round(x, 9).alias(name)


def _pairs(v: Views) -> DataFrame:
    return joins.select_pairs(v.scenes(), 100, 40)


# --- network -----------------------------------------------------------------------------------------------------


@query(f"with {PAIRS} select ref, rep from pairs")
def select_pairs(v):
    return _pairs(v).select("ref", "rep")


@query(f"with {PAIRS} select lpad(cast(ref as varchar), 7, '0') || ':' || lpad(cast(rep as varchar), 7, '0') as pair, ref, rep, round(b2 - b1, 9) as b_perp, d2 - d1 as days from pairs")
def sbas_inputs(v):
    return _pairs(v).select(F.concat_ws(":", F.lpad(F.col("ref").cast("string"), 7, "0"), F.lpad(F.col("rep").cast("string"), 7, "0")).alias("pair"), "ref", "rep", r9(F.col("b2") - F.col("b1"), "b_perp"), (F.col("d2") - F.col("d1")).alias("days"))


@query(f"with {PAIRS} select p.ref, p.rep, s.id as scene from pairs p join scenes s on s.id >= p.ref and s.id < p.rep")
def incidence(v):
    return joins.covered(_pairs(v), v.scenes(), 16)


@query(f"with {PAIRS} select distinct ref, rep from pairs p where exists (select 1 from pairs q where q.ref = p.rep and abs((p.d2 - p.d1) - (q.d2 - q.d1)) < 5)")
def time_symmetric_edges(v):
    return joins.symmetric(_pairs(v))


@query(f"with {PAIRS} select ref, count(*) as n, min(rep) as first_rep, max(rep) as last_rep from pairs group by ref")
def hit_matrix(v):
    return _pairs(v).groupBy("ref").agg(F.count("*").alias("n"), F.min("rep").alias("first_rep"), F.max("rep").alias("last_rep"))


@query(f"with {PAIRS} select id, cast(sum(mark) as bigint) as balance, count(*) as degree from (select ref as id, 1 as mark from pairs union all select rep, -1 from pairs) group by id")
def edge_marks(v):
    p = _pairs(v)
    return p.select(F.explode(F.array(F.struct(F.col("ref").alias("id"), F.lit(1).alias("mark")), F.struct(F.col("rep").alias("id"), F.lit(-1).alias("mark")))).alias("e")).groupBy("e.id").agg(F.sum("e.mark").alias("balance"), F.count("*").alias("degree"))


@query("select s_nationkey as net, s_suppkey as id, lead(s_suppkey * 12) over (partition by s_nationkey order by s_suppkey) - s_suppkey * 12 as dt from supplier")
def smooth_rows(v):
    """Day gaps to the next scene of a network; ids may have gaps."""
    s = v.table("supplier").select(F.col("s_nationkey").alias("net"), F.col("s_suppkey").alias("id"), (F.col("s_suppkey") * 12).alias("day"))
    return s.select("net", "id", (F.lead("day").over(Window.partitionBy("net").orderBy("id")) - F.col("day")).alias("dt"))


@query(f"with {PAIRS} select ref, rep, round(sqrt(pow(b2 - b1, 2)) * sin(0.65 - 0.1), 9) as b_par, round((b2 - b1) * cos(0.65 - 0.1), 9) as b_perp from pairs")
def baseline_parts(v):
    b = F.col("b2") - F.col("b1")
    return _pairs(v).select("ref", "rep", r9(F.abs(b) * F.sin(F.lit(0.65 - 0.1)), "b_par"), r9(b * F.cos(F.lit(0.65 - 0.1)), "b_perp"))


# --- stacks ------------------------------------------------------------------------------------------------------


@query(f"with {STACK} select pixel, round(avg(z), 9) as mean, round(stddev_pop(z), 9) as std from stack group by pixel")
def stack_mean_std(v):
    return v.stack().groupBy("pixel").agg(r9(F.avg("z"), "mean"), r9(F.stddev_pop("z"), "std"))


@query(f"with {STACK} select pixel, round(1 / sqrt(1 + avg((1 - c * c) / nullif(c * c, 0))), 9) as corr from stack group by pixel")
def stack_corr(v):
    c = F.col("c")
    return v.stack().groupBy("pixel").agg(r9(1 / F.sqrt(1 + F.avg((1 - c * c) / F.nullif(c * c, F.lit(0.0)))), "corr"))


@query(f"with {STACK} select pixel, round(sum(z) / sum(scene * 12) * 365 * {LAMBDA} * -79.58, 9) as vel from stack group by pixel")
def stack_velocity(v):
    return v.stack().groupBy("pixel").agg(r9(F.sum("z") / F.sum(F.col("scene") * 12) * 365 * LAMBDA * -79.58, "vel"))


@query(f"with {STACK}, v as (select pixel, z / (scene * 12) * 365 as v from stack) select pixel, round(sqrt(avg(v * v) - avg(v) * avg(v) + 1e-6), 6) as dev from v group by pixel")
def stack_velocity_dev(v):
    x = F.col("z") / (F.col("scene") * 12) * 365
    return v.stack().groupBy("pixel").agg(F.round(F.sqrt(F.avg(x * x) - F.avg(x) * F.avg(x) + 1e-6), 6).alias("dev"))


@query(f"with {STACK} select pixel, case when avg(c) >= 0.5 then 1.0 end as mask from stack group by pixel")
def coherence_mask(v):
    c = stats.ordered_means(v.ordered_stack(), ["pixel"], ["order"], {"c": F.col("c")})  # scenes in the order of their first rows
    return c.select("pixel", F.when(F.col("c") >= 0.5, 1.0).alias("mask"))


@query(f"with {STACK} select pixel, round(regr_slope(z, scene * 12) * 365, 9) as slope from stack group by pixel having count(*) > 1")
def velocity_slope(v):
    return v.stack().groupBy("pixel").agg(r9(F.regr_slope("z", F.col("scene") * 12) * 365, "slope"), F.count("*").alias("n")).where("n > 1").drop("n")


@query(f"with {STACK} select pixel, scene, round(coalesce(sum(z) over (partition by pixel order by scene rows between unbounded preceding and 1 preceding), 0), 9) as disp from stack")
def cumulative_disp(v):
    w = Window.partitionBy("pixel").orderBy("scene").rowsBetween(Window.unboundedPreceding, -1)
    return v.stack().select("pixel", "scene", r9(F.coalesce(F.sum("z").over(w), F.lit(0.0)), "disp"))


@query(f"with {STACK}, m as (select pixel, z, case when scene < 4 then 1 when scene > 4 then -1 else 0 end as mark from stack) select pixel, round(-sum(z * mark) / nullif(sum(abs(mark)), 0), 9) as screen from m group by pixel")
def common_point_stack(v):
    mark = F.when(F.col("scene") < 4, 1).when(F.col("scene") > 4, -1).otherwise(0)
    return v.stack().groupBy("pixel").agg(r9(-F.sum(F.col("z") * mark) / F.nullif(F.sum(F.abs(mark)), F.lit(0)), "screen"))


@query(f"with {STACK}, a as (select pixel, avg(sqrt(z)) as m, avg(z) as p from stack group by pixel) select pixel, round(case when sqrt(greatest(p - m * m, 0)) > 0.1 then m / (2 * sqrt(p - m * m)) else 0.1 end, 7) as score from a")
def scatter_index(v):
    s = v.stack().groupBy("pixel").agg(F.avg(F.sqrt("z")).alias("m"), F.avg("z").alias("p"))
    d = F.sqrt(F.greatest(F.col("p") - F.col("m") * F.col("m"), F.lit(0.0)))
    return s.select("pixel", F.round(F.when(d > 0.1, F.col("m") / (2 * d)).otherwise(0.1), 7).alias("score"))


@query(f"with {STACK} select scene, pixel, round(z, 9) as noise, row_number() over (partition by scene order by abs(z) desc, pixel) as rk from stack")
def rank_noise(v):
    w = Window.partitionBy("scene").orderBy(F.desc(F.abs("z")), "pixel")
    return v.ordered_stack().select("scene", "pixel", r9(F.col("z"), "noise"), F.row_number().over(w).cast("long").alias("rk"))


@query(f"with {STACK} select scene, round(case when sum(z) = 0 then 0 else stddev_pop(z) end, 9) as noise, round(median(z), 9) as med from stack group by scene")
def screen_noise(v):
    return v.stack().groupBy("scene").agg(r9(F.when(F.sum("z") == 0, 0.0).otherwise(F.stddev_pop("z")), "noise"), r9(F.median("z"), "med"))


@query(f"with {STACK} select a.pixel, round(regr_slope(a.z, b.z), 8) as slope, round(regr_intercept(a.z, b.z), 8) as icept from stack a join stack b on a.pixel = b.pixel and a.scene + 1 = b.scene group by a.pixel having count(*) > 2")
def height_regression(v):
    a, b = v.stack(), v.stack().select("pixel", (F.col("scene") - 1).alias("scene"), F.col("z").alias("h"))
    return a.join(b, ["pixel", "scene"]).groupBy("pixel").agg(F.round(F.regr_slope("z", "h"), 8).alias("slope"), F.round(F.regr_intercept("z", "h"), 8).alias("icept"), F.count("*").alias("n")).where("n > 2").drop("n")


# --- offsets -----------------------------------------------------------------------------------------------------


@query(f"with {OFFSETS} select x, dx, y, dy, snr from offsets where snr > 20 and dx between 0.02 and 0.06 and dy between 0.01 and 0.09")
def snr_filter(v):
    return v.offsets().where("snr > 20 and dx between 0.02 and 0.06 and dy between 0.01 and 0.09")


@query(f"""with {OFFSETS}, s as (select snr, row_number() over (order by snr) as k, count(*) over () as n from offsets),
q as (select max(case when k = floor((n + 1) * 0.25) then snr end) as a1, max(case when k = floor((n + 1) * 0.25) + 1 then snr end) as b1, max((n + 1) * 0.25 - floor((n + 1) * 0.25)) as f1,
max(case when k = floor((n + 1) * 0.75) then snr end) as a3, max(case when k = floor((n + 1) * 0.75) + 1 then snr end) as b3, max((n + 1) * 0.75 - floor((n + 1) * 0.75)) as f3 from s),
p as (select a1 + f1 * (b1 - a1) as q1, a3 + f3 * (b3 - a3) as q3 from q) select round(q1, 9) as q1, round(q3, 9) as q3, round(q1 - 1.5 * (q3 - q1), 9) as lo, round(q3 + 1.5 * (q3 - q1), 9) as hi from p""")
def iqr_bounds(v):
    return stats.iqr_bounds(v.offsets(), "snr").select(*[r9(F.col(c), c) for c in ("q1", "q3", "lo", "hi")])


@query(f"with {OFFSETS} select round(avg(snr) - 3 * stddev_pop(snr), 9) as lo, round(avg(snr) + 3 * stddev_pop(snr), 9) as hi from offsets")
def zscore_bounds(v):
    return stats.zscore_bounds(v.offsets(), "snr").select(r9(F.col("lo"), "lo"), r9(F.col("hi"), "hi"))


@query(f"with {OFFSETS}, m as (select quantile_disc(snr, 0.5) as m from offsets), d as (select m, quantile_disc(abs(snr - m), 0.5) as mad from offsets, m group by m) select m, mad, round(m - 3.29 * mad / 0.6745, 9) as lo, round(m + 3.29 * mad / 0.6745, 9) as hi from d")
def mad_bounds(v):
    return stats.mad_bounds(v.offsets(), "snr").select("m", "mad", r9(F.col("lo"), "lo"), r9(F.col("hi"), "hi"))


@query(f"with {OFFSETS}, s as (select snr, row_number() over (order by snr) as k, count(*) over () as n from offsets) select max(case when k = n // 2 + 1 then snr end) as upper_median from s")
def upper_median(v):
    return stats.upper_median(v.offsets(), "snr")


@query(f"""with {OFFSETS}, s as (select covar_pop(x, x) as xx, covar_pop(x, y) as xy, covar_pop(y, y) as yy, covar_pop(x, snr) as xz, covar_pop(y, snr) as yz, avg(x) as mx, avg(y) as my, avg(snr) as mz from offsets),
t as (select *, (xz * yy - yz * xy) / nullif(xx * yy - xy * xy, 0) as b, (yz * xx - xz * xy) / nullif(xx * yy - xy * xy, 0) as c from s) select round(mz - b * mx - c * my, 6) as a, round(b, 9) as b, round(c, 9) as c from t""")
def plane_fit(v):
    return stats.plane(v.offsets().withColumn("z", F.col("snr"))).select(F.round("a", 6).alias("a"), r9(F.col("b"), "b"), r9(F.col("c"), "c"))


# --- grids -------------------------------------------------------------------------------------------------------


@query(f"with {CELLS} select r // 8 as br, c // 8 as bc, round(median(z), 9) as z from cells group by 1, 2")
def block_median(v):
    return stats.block(v.cells(), 8, F.median).select("br", "bc", r9(F.col("z"), "z"))


@query(f"with {CELLS} select r // 8 as br, c // 8 as bc, round(avg(z), 9) as z from cells group by 1, 2")
def block_mean(v):
    return stats.block(v.cells(), 8, F.avg).select("br", "bc", r9(F.col("z"), "z"))


@query(f"with {CELLS} select min(r) as r0, max(r) as r1, min(c) as c0, max(c) as c1, round(min(z), 9) as z0, round(max(z), 9) as z1, count(*) as n from cells")
def grid_bounds(v):
    return v.cells().agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1"), r9(F.min("z"), "z0"), r9(F.max("z"), "z1"), F.count("*").alias("n"))


@query(f"with {CELLS} select round(median(z), 9) as med, round(avg(z), 9) as mean, round(stddev_pop(z), 9) as std from cells")
def grid_stats(v):
    return v.cells().agg(r9(F.median("z"), "med"), r9(F.avg("z"), "mean"), r9(F.stddev_pop("z"), "std"))


@query(f"with {CELLS}, k(i, j, w) as (values (-1,-1,1.0),(-1,0,2.0),(-1,1,1.0),(0,-1,2.0),(0,0,4.0),(0,1,2.0),(1,-1,1.0),(1,0,2.0),(1,1,1.0)) select a.r, a.c, round(sum(cast(k.w as double) * b.z) / sum(cast(k.w as double)), 9) as z from cells a, k, cells b where b.r = a.r + k.i and b.c = a.c + k.j group by a.r, a.c")
def conv3x3(v):
    kernel = [(i, j, float((2 - abs(i)) * (2 - abs(j)))) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return stats.convolve(v.cells(), kernel).select("r", "c", r9(F.col("z"), "z"))


@query(f"with {CELLS} select r, c, round(lead(z) over (partition by r order by c) - lag(z) over (partition by r order by c), 9) as dz from cells")
def central_diff(v):
    w = Window.partitionBy("r").orderBy("c")
    return v.cells().select("r", "c", r9(F.lead("z").over(w) - F.lag("z").over(w), "dz"))


_SHIFTS = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]


@query(f"with {CELLS}, s(i, j) as (values {', '.join(f'({i},{j})' for i, j in _SHIFTS)}) select s.i, s.j, round(100 * abs(sum(a.z * b.im)) / nullif(sqrt(sum(a.z * a.z) * sum(b.im * b.im)), 0), 7) as corr from s, cells a, cells b where b.r = a.r + s.i and b.c = a.c + s.j group by s.i, s.j")
def norm_xcorr(v):
    shift = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in _SHIFTS]))
    a = v.cells().select("r", "c", "z", shift.alias("s")).select("z", "s.i", "s.j", (F.col("r") + F.col("s.i")).alias("r"), (F.col("c") + F.col("s.j")).alias("c"))
    b = v.cells().select("r", "c", "im")
    top = F.abs(F.sum(F.col("z") * F.col("im"))) * 100
    return a.join(b, ["r", "c"]).groupBy("i", "j").agg(F.round(top / F.nullif(F.sqrt(F.sum(F.col("z") * F.col("z")) * F.sum(F.col("im") * F.col("im"))), F.lit(0.0)), 7).alias("corr"))


@query(f"with {CELLS} select r, c, round(z * 9 + {PI} - {2 * PI} * floor((z * 9 + {PI}) / {2 * PI}) - {PI}, 8) as phi from cells")
def wrap_phase(v):
    return v.cells().select("r", "c", F.round(A.wrap(F.col("z") * 9), 8).alias("phi"))


@query(f"with {CELLS} select r, c, round(sqrt(z * z + im * im), 9) as amp, round(atan2(im, z), 9) as phi, round(z * 0.6 + im * 0.8, 9) as pre, round(im * 0.6 - z * 0.8, 9) as pim from cells")
def complex_ops(v):
    re, im = A.times_conj(F.col("z"), F.col("im"), F.lit(0.6), F.lit(0.8))
    return v.cells().select("r", "c", r9(A.amplitude(F.col("z"), F.col("im")), "amp"), r9(A.phase(F.col("z"), F.col("im")), "phi"), r9(re, "pre"), r9(im, "pim"))


@query(f"with {CELLS}, m as (select r, c, case when (r + c) % 3 > 0 then z end as a, case when (r * c) % 4 > 0 then im end as b from cells) select r, c, case when a >= 3 then 1.0 when a < 3 then 0.0 end as ge, round(coalesce(a, b), 9) as filled, round(case when b is not null then a end, 9) as masked, round(case when a is not null then least(a, 3.5) end, 9) as clipped, (a is null)::int as gap, round(a / nullif(b, 0), 6) as quot from m")
def nan_ops(v):
    m = v.cells().select("r", "c", F.when((F.col("r") + F.col("c")) % 3 > 0, F.col("z")).alias("a"), F.when((F.col("r") * F.col("c")) % 4 > 0, F.col("im")).alias("b"))
    a, b = F.col("a"), F.col("b")
    return m.select("r", "c", A.at_least(a, 3).alias("ge"), r9(A.fill(a, b), "filled"), r9(A.masked_by(a, b), "masked"), r9(A.clip_high(a, 3.5), "clipped"), a.isNull().cast("int").alias("gap"), F.round(A.div(a, b), 6).alias("quot"))


@query(f"with {CELLS} select r, c, round(z * ({LAMBDA} / (-4 * {PI}) * 1000), 9) as mm, round(z * (0.0555 / (4 * {PI})), 9) as m from cells")
def los_displacement(v):
    return v.cells().select("r", "c", r9(A.los_mm(F.col("z"), LAMBDA), "mm"), r9(A.los_m(F.col("z")), "m"))


@query(f"with {STACK} select pixel, scene, round(case when c < 0.01 then 99.99 when c > 0.99 then 0.1 else sqrt((1 - c * c) / (c * c)) end, 8) as sigma from stack")
def sigma_from_coherence(v):
    return v.stack().select("pixel", "scene", F.round(A.sigma(F.col("c")), 8).alias("sigma"))


@query(f"with {CELLS} select r, c, round((z * (1.30 / 1.27) - im * (1.24 / 1.27)) * (1.24 * 1.30 / (1.30 * 1.30 - 1.24 * 1.24)), 7) as iono, round(im * (4 * {PI} / {LAMBDA}) / cos(radians(37)), 7) as delay, round(0.6 * z + 0.1 * im + 0.8 * (z - im), 9) as los from cells")
def corrections(v):
    z, im = F.col("z"), F.col("im")
    return v.cells().select("r", "c", F.round(A.split_spectrum(z, im, 1.24, 1.30, 1.27), 7).alias("iono"), F.round(A.delay_phase(im, LAMBDA, F.lit(37)), 7).alias("delay"), r9(A.project(z, im, z - im, F.lit(0.6), F.lit(0.1), F.lit(0.8)), "los"))


@query(f"with {CELLS} select 63 - r as r, c, round(z, 9) as z from cells where r between 16 and 47 and c between 16 and 47")
def region_cut(v):
    return v.cells().where("r between 16 and 47 and c between 16 and 47").select(A.flip(F.col("r"), 64).alias("r"), "c", r9(F.col("z"), "z"))


_POINTS = "points as (select p_partkey as pid, (p_partkey * 7 % 620) / 10.0 as y, (p_partkey * 13 % 620) / 10.0 as x from part)"


@query(f"""with {CELLS}, {_POINTS}, n as (select pid, cast(floor(y) as bigint) + i as r, cast(floor(x) as bigint) + j as c, (case when i = 1 then y - floor(y) else 1 - y + floor(y) end) * (case when j = 1 then x - floor(x) else 1 - x + floor(x) end) as w from points, (values (0), (1)) a(i), (values (0), (1)) b(j))
select pid, round(case when sum((z is null)::int) = 0 then sum(w * z) end, 8) as z from n left join cells using (r, c) where w > 0 group by pid""")
def bilinear_sample(v):
    p = v.table("part").select(F.col("p_partkey").alias("pid"), (F.col("p_partkey") * 7 % 620 / 10.0).alias("y"), (F.col("p_partkey") * 13 % 620 / 10.0).alias("x"))
    return joins.bilinear(p, v.cells().select("r", "c", "z")).select("pid", F.round("z", 8).alias("z"))


@query(f"""with {CELLS}, h as (select r, c, case when (r * 7 + c * 3) % 5 > 1 then z end as z from cells),
  k as (select *, max(case when z is not null then c end) over (partition by r order by c) as c0, min(case when z is not null then c end) over (partition by r order by c desc) as c1 from h)
  select k.r, k.c, round(coalesce(k.z, case when c0 is null or c1 - k.c < k.c - c0 then b.z else a.z end), 9) as z from k left join h a on a.r = k.r and a.c = c0 left join h b on b.r = k.r and b.c = c1""")
def nearest_fill_1d(v):
    """The nearest known cell of the row; the left one of two at the same distance."""
    h = v.cells().select("r", "c", F.when((F.col("r") * 7 + F.col("c") * 3) % 5 > 1, F.col("z")).alias("z"))
    w = Window.partitionBy("r").orderBy("c")
    known = F.when(F.col("z").isNotNull(), F.struct("c", "z"))
    h = h.select("r", "c", "z", F.last(known, True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("a"), F.first(known, True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("b"))
    right = F.col("a").isNull() | (F.col("b.c") - F.col("c") < F.col("c") - F.col("a.c"))
    return h.select("r", "c", r9(F.coalesce("z", F.when(right, F.col("b.z")).otherwise(F.col("a.z"))), "z"))


_SWATHS = "left_ as (select r, c, z from cells where c <= 40), right_ as (select r + 2 as r, c - 4 as c, im as z from cells where c >= 32)"


@query(f"with {CELLS}, {_SWATHS} select r, c, round(case when c < 34 then max(a) else max(b) end, 9) as z from (select r, c, z as a, null as b from left_ union all select r, c, null, z from right_) group by r, c")
def merge_swaths(v):
    a = v.cells().where("c <= 40").select("r", "c", F.col("z").alias("a"))
    b = v.cells().where("c >= 32").select((F.col("r") + 2).alias("r"), (F.col("c") - 4).alias("c"), F.col("im").alias("b"))
    both = a.unionByName(b, allowMissingColumns=True)
    return both.groupBy("r", "c").agg(F.max("a").alias("a"), F.max("b").alias("b")).select("r", "c", r9(F.when(F.col("c") < 34, F.col("a")).otherwise(F.col("b")), "z"))


@query(f"with {CELLS} select r, c, round(z, 9) as z from cells union all select r, c + 64, round(im, 9) from cells")
def paste(v):
    return v.cells().select("r", "c", r9(F.col("z"), "z")).unionByName(v.cells().select("r", (F.col("c") + 64).alias("c"), r9(F.col("im"), "z")))


_W = "(x + {p} - 2 * {p} * floor((x + {p}) / (2 * {p})) - {p})".replace("{p}", str(PI))


def _wrapped(x: str) -> str:
    return _W.replace("x +", f"({x}) +")


@query(f"with {CELLS}, q as (select a.r, a.c, a.z * 9 as p00, b.z * 9 as p01, d.z * 9 as p10, e.z * 9 as p11 from cells a join cells b on b.r = a.r and b.c = a.c + 1 join cells d on d.r = a.r + 1 and d.c = a.c join cells e on e.r = a.r + 1 and e.c = a.c + 1) select r, c, cast(round(({_wrapped('p01 - p00')} + {_wrapped('p11 - p01')} + {_wrapped('p10 - p11')} + {_wrapped('p00 - p10')}) / {2 * PI}) as int) as residue from q")
def residues(v):
    row, down = Window.partitionBy("r").orderBy("c"), Window.partitionBy("c").orderBy("r")
    p = v.cells().select("r", "c", (F.col("z") * 9).alias("p00"))
    p = p.select("*", F.when(F.lead("c").over(row) == F.col("c") + 1, F.lead("p00").over(row)).alias("p01"))
    near = F.lead("r").over(down) == F.col("r") + 1
    p = p.select("*", F.when(near, F.lead("p00").over(down)).alias("p10"), F.when(near, F.lead("p01").over(down)).alias("p11")).where("p01 is not null and p10 is not null and p11 is not null")
    d = [A.wrap(F.col(a) - F.col(b)) for a, b in (("p01", "p00"), ("p11", "p01"), ("p10", "p11"), ("p00", "p10"))]
    return p.select("r", "c", F.round((d[0] + d[1] + d[2] + d[3]) / (2 * PI)).cast("int").alias("residue"))


@query(f"with {CELLS} select r // 16 as swath, cast(round(median((z - im) * 5) / {2 * PI}) as int) as k, round(atan2(sum(im), sum(z)) / ({2 * PI} * 4.5), 9) as shift from cells group by 1")
def cycle_ambiguity(v):
    d = (F.col("z") - F.col("im")) * 5
    return v.cells().groupBy(F.floor(F.col("r") / 16).alias("swath")).agg(F.round(F.median(d) / (2 * PI)).cast("int").alias("k"), r9(F.atan2(F.sum("im"), F.sum("z")) / (2 * PI * 4.5), "shift"))


@query(None)
def goldstein(v):
    return tiles.goldstein(v.cells().select("r", "c", F.cos(F.col("z") * 9).alias("re"), F.sin(F.col("z") * 9).alias("im")))


@query(None)
def sbas_lsq(v):
    s = v.stack().select("pixel", F.col("scene").alias("intf"), F.col("z").alias("phase"), A.sigma(F.col("c")).alias("sigma"))
    return tiles.sbas(s, [(0, 1, 0.0), (1, 2, 0.0), (2, 3, 0.0), (3, 4, 0.0), (0, 2, 0.0), (1, 3, 0.0), (2, 4, 0.0)], [0, 12, 24, 36, 48])


# --- tables, times, texts ----------------------------------------------------------------------------------------


@query("select o_orderkey, o_orderdate, max_by(ts, (ts, event_id)) as ts from (select o.o_orderkey, o.o_orderdate, e.ts, e.event_id from orders o left join events e on e.user_id = o.o_custkey and e.ts <= o.o_orderdate) group by 1, 2")
def asof_orbit(v):
    o = v.table("orders").select(F.col("o_custkey").alias("user"), F.col("o_orderdate").alias("t"), "o_orderkey")
    e = v.table("events").select(F.col("user_id").alias("user"), F.col("ts").alias("t"), F.col("ts").alias("seen"))
    return joins.as_of(o, e, "user", "t", "seen").select("o_orderkey", F.col("t").alias("o_orderdate"), F.col("seen").alias("ts"))


@query("with b as (select o_custkey as k, o_orderkey as id, epoch_us(o_orderdate) // 86400000000 as a from orders) select x.id as one, y.id as two, least(x.a, y.a) + 30 - greatest(x.a, y.a) as overlap from b x join b y on x.k = y.k and x.id < y.id and abs(x.a - y.a) < 30")
def burst_overlap(v):
    b = v.table("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"), F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).alias("a"))
    x = b.select("k", F.col("id").alias("one"), F.col("a").alias("s"), F.explode(F.array(*[F.floor(F.col("a") / 30) + i for i in (-1, 0, 1)])).alias("month"))
    y = b.select("k", F.col("id").alias("two"), F.col("a").alias("t"), F.floor(F.col("a") / 30).alias("month"))
    return x.join(y, ["k", "month"]).where("one < two and abs(s - t) < 30").select("one", "two", (F.least("s", "t") + 30 - F.greatest("s", "t")).alias("overlap"))


@query("select user_id as scene, event_type as key, max_by(props, event_id) as value from events group by 1, 2")
def last_wins_params(v):
    return last_wins(v.table("events").select(F.col("user_id").alias("scene"), F.col("event_id").alias("ord"), F.col("event_type").alias("key"), F.col("props").alias("value")))


@query("select p_partkey as stem, s_suppkey is not null as paired from part left join supplier on s_suppkey = p_partkey")
def pair_files(v):
    s = v.table("supplier").select(F.col("s_suppkey").alias("stem"), F.lit(True).alias("paired"))
    return v.table("part").select(F.col("p_partkey").alias("stem")).join(s, "stem", "left").select("stem", F.coalesce("paired", F.lit(False)).alias("paired"))


@query("select distinct o_orderdate from orders order by 1 limit 2")
def first_two_dates(v):
    return v.table("orders").select("o_orderdate").distinct().orderBy("o_orderdate").limit(2)


@query("select p_partkey, (p_size & 1) = 1 and not ((p_size & 4) = 4 or (p_size & 8) = 8) as land from part")
def bitmask_expr(v):
    return v.table("part").select("p_partkey", compile_flags("p_size.LAND and NOT (p_size.CLOUD | p_size.ICE)", {"LAND": 1, "CLOUD": 4, "ICE": 8}).alias("land"))


@query("""with l as (select user_id as line, event_id as ord, event_id // 40 as counter from events), m as (select *, max(counter) over (partition by line order by ord rows between unbounded preceding and 1 preceding) as seen from l),
k as (select *, coalesce(counter - seen, 1) as gap from m where seen is null or counter > seen) select line, ord, case when g.k = gap or gap > 900 then counter else 0 end as counter, cast(g.k as int) as k from k, lateral (select unnest(generate_series(1, case when gap <= 900 then gap else 1 end)) as k) g""")
def line_gap_fix(v):
    return repaired(v.table("events").select(F.col("user_id").alias("line"), F.col("event_id").alias("ord"), F.floor(F.col("event_id") / 40).alias("counter")))


@query("select event_type, count(*) as n from events group by 1 having count(*) >= 0.01 * (select count(*) from events) order by n desc, event_type limit 3")
def component_topk(v):
    e = v.table("events")
    total = e.agg((F.count("*") * 0.01).alias("least"))
    return e.groupBy("event_type").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).where("n >= least").drop("least").orderBy(F.desc("n"), "event_type").limit(3)


@query("select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n, round(avg(value), 9) as mean from events group by 1, 2")
def running_windows(v):
    return running_stack(v.table("events")).select("start", "event_type", "n", r9(F.col("mean"), "mean"))


@query("select o_orderkey, cast(strftime(o_orderdate, '%Y%j') as int) - 1 as yyyyddd, datediff('day', date '1992-01-01', cast(o_orderdate as date)) as days, round(epoch_us(o_orderdate) / 86400e6 + 40587, 6) as mjd, lpad(cast(o_orderkey as varchar), 9, '0') as name, upper(left(o_orderpriority, 3)) as code, regexp_replace(cast(cast(o_orderdate as date) as varchar), '[^0-9]', '', 'g') as stamp from orders")
def date_and_text(v):
    d = F.to_date("o_orderdate")
    return v.table("orders").select("o_orderkey", (F.year(d) * 1000 + F.dayofyear(d) - 1).alias("yyyyddd"), F.datediff(d, F.lit("1992-01-01").cast("date")).alias("days"), F.round(F.datediff(d, F.lit("1858-11-17").cast("date")) + (F.hour("o_orderdate") * 3600 + F.minute("o_orderdate") * 60 + F.second("o_orderdate")) / 86400.0, 6).alias("mjd"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("name"), F.upper(F.substring("o_orderpriority", 1, 3)).alias("code"), F.regexp_replace(d.cast("string"), "[^0-9]", "").alias("stamp"))


@query(r"select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, len(string_split(html, '<a ')) as links from pages")
def xml_paths(v):
    return v.table("pages").select("page_id", F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"), F.size(F.split("html", "<a ")).cast("long").alias("links"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: (lambda spark, sf_dir, f=f: f(Views(spark, sf_dir))) for k, (f, _) in _found.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _found.items() if sql}


from . import grids as _grids  # noqa: E402, F401  registers its queries
from . import kernels as _kernels  # noqa: E402, F401
from . import networks as _networks  # noqa: E402, F401
from . import products as _products  # noqa: E402, F401
