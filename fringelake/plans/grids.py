"""Queries on grids: algebra, filters, masks, neighbourhoods and statistics, each with its SQL."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import algebra as A
from ..operators import grids
from .queries import query
from .views import CELLS, OFFSETS, STACK


def r6(x, name: str):
    return F.round(x, 6).alias(name)


# --- algebra -----------------------------------------------------------------------------------------------------


@query(f"""with {CELLS} select r, c, round(z * z, 6) as sqr, round(sqrt(z), 6) as root, round(pow(z, 1.5), 6) as power, round(abs(im), 6) as size, round(-z, 6) as neg,
  round(log2(z), 6) as l2, round(log10(z) + 100, 6) as l10, c * 0.5 + 10 as x, r * 0.25 - 3 as y, round(pi(), 6) as pi, round(z + z, 6) as dup,
  round(cos(radians(r)), 6) as cosd, round_even(r / 4.0, 0) as rint, round(greatest(z, im), 6) as upper from cells""")
def math_ops(v):
    return v.cells().select(
        "r", "c", r6(F.col("z") * F.col("z"), "sqr"), r6(F.sqrt(F.col("z")), "root"), r6(F.pow(F.col("z"), F.lit(1.5)), "power"), r6(F.abs(F.col("im")), "size"), r6(-F.col("z"), "neg"), r6(F.log2(F.col("z")), "l2"), r6(F.log10(F.col("z")) + 100, "l10"),
        (F.col("c") * 0.5 + 10).alias("x"), (F.col("r") * 0.25 - 3).alias("y"), r6(F.lit(math.pi), "pi"), r6(F.col("z") + F.col("z"), "dup"), r6(A.cosd(F.col("r")), "cosd"), F.rint(F.col("r") / 4.0).alias("rint"), r6(F.greatest(F.col("z"), F.col("im")), "upper"),
    )


@query(f"""with {CELLS}, m as (select r, c, z, nullif(c % 5, 0) as k from cells) select r, c, cast(k >= 3 as double) as ge, cast(k <= 3 as double) as le, cast(k > 3 as double) as gt,
  cast(k < 3 as double) as lt, cast(k = 3 as double) as eq from m""")
def compare_ops(v):
    k = F.nullif(F.col("c") % 5, F.lit(0))
    return v.cells().select("r", "c", *[A.compared(k, op, F.lit(3)).alias(op) for op in ("ge", "le", "gt", "lt", "eq")])


@query(f"""with {CELLS} select r, c, nullif(c % 4, 2) as masked, coalesce(nullif(c % 4, 2), r) as filled, round(case when im > 0 then z else im end, 6) as chosen from cells""")
def mask_ops(v):
    masked = F.nullif(F.col("c") % 4, F.lit(2))
    return v.cells().select("r", "c", masked.alias("masked"), A.either(masked, F.col("r")).alias("filled"), r6(F.when(F.col("im") > 0, F.col("z")).otherwise(F.col("im")), "chosen"))


@query(f"""with {CELLS}, d as (select *, lead(im) over w - lag(im) over w as di, lead(z) over w - lag(z) over w as dz from cells window w as (partition by r order by c))
  select r, c, round((z * di / 2 - im * dz / 2) / (z * z + im * im), 6) as gradient from d""")
def phase_gradient(v):
    w = Window.partitionBy("r").orderBy("c")
    d = v.cells().select("*", (F.lead("im").over(w) - F.lag("im").over(w)).alias("di"), (F.lead("z").over(w) - F.lag("z").over(w)).alias("dz"))
    return d.select("r", "c", r6((F.col("z") * F.col("di") / 2 - F.col("im") * F.col("dz") / 2) / (F.col("z") * F.col("z") + F.col("im") * F.col("im")), "gradient"))


@query(f"""with {CELLS} select r, c, round(case when (z + 1) * abs(im) >= 5e-21 then sqrt(z * z + im * im) / sqrt((z + 1) * abs(im)) end, 6) as coherence from cells""")
def product_coherence(v):
    return v.cells().select("r", "c", r6(A.fraction_of(F.col("z"), F.col("im"), (F.col("z") + 1) * F.abs(F.col("im"))), "coherence"))


@query(f"""with {CELLS} select r // 4 as br, c // 4 as bc, round(coalesce(least(sqrt(pow(avg(z), 2) + pow(avg(im), 2)) / nullif(avg(sqrt(z * z + im * im)), 0), 1), 0), 6) as coherence
  from cells group by 1, 2""")
def block_coherence(v):
    ratio = F.hypot(F.avg("z"), F.avg("im")) / F.nullif(F.avg(F.hypot("z", "im")), F.lit(0.0))
    return v.cells().groupBy(F.floor(F.col("r") / 4).alias("br"), F.floor(F.col("c") / 4).alias("bc")).agg(r6(F.coalesce(F.least(ratio, F.lit(1.0)), F.lit(0.0)), "coherence"))


@query(f"""with {CELLS}, p as (select r, c, z * (z + 1) + im * 0.5 as re, im * (z + 1) - z * 0.5 as q from cells)
  select r, c, round(atan2(q * 3e5, re * 3e5) / (2 * pi() * 0.4 * 1680) * 4.1, 9) as shift from p""")
def mai_shift(v):
    return v.cells().select("r", "c", F.round(A.mai_phase(F.col("z"), F.col("im"), F.col("z") + 1, F.lit(0.5), 0.4, 1680, 4.1), 9).alias("shift"))


@query(f"""with {CELLS} select r, c, round(z * im - im * 2, 6) as re, round(z * 2 + im * im, 6) as im, round(cos(z), 6) as er, round(sin(z), 6) as ei, round(sqrt(z * z + im * im), 6) as size,
  round(z * 0.5, 6) as sr, round(im * 0.5, 6) as si from cells""")
def complex_product(v):
    re, im = A.product(F.col("z"), F.col("im"), F.col("im"), F.lit(2.0))
    return v.cells().select("r", "c", r6(re, "re"), r6(im, "im"), r6(F.cos(F.col("z")), "er"), r6(F.sin(F.col("z")), "ei"), r6(F.hypot(F.col("z"), F.col("im")), "size"), r6(F.col("z") * 0.5, "sr"), r6(F.col("im") * 0.5, "si"))


@query(f"""with {CELLS}, m as (select *, (pow(r - 32, 2) + pow(c - 32, 2) <= 64 or abs(degrees(atan2(r - 32, c - 32)) - 45) < 5) as kept, avg(z) over () as mean from cells)
  select r, c, round(case when kept then z else mean end, 6) as z from m""")
def spectrum_mask(v):
    y, x = F.col("r") - 32, F.col("c") - 32
    kept = (y * y + x * x <= 64) | (F.abs(F.degrees(F.atan2(y, x)) - 45) < 5)
    cells = v.cells()
    return cells.select("r", "c", r6(F.when(kept, F.col("z")).otherwise(cells.agg(F.avg("z").alias("mean")).scalar()), "z"))


@query(f"""with {CELLS} select r, c, round(z - (select avg(z) from cells where r between 25 and 35 and c between 30 and 40), 6) as z from cells""")
def window_reference(v):
    cells = v.cells()
    return cells.select("r", "c", r6(F.col("z") - grids.box_mean(cells, 30, 35, 5).scalar(), "z"))


# --- selections --------------------------------------------------------------------------------------------------


@query(f"""with {OFFSETS}, k as (select * from offsets where snr > 20) select x, y, dx, dy, snr from k where (select count(*) from k) >= 8""")
def guarded_offsets(v):
    return grids.guarded(v.offsets().where("snr > 20").select("x", "y", "dx", "dy", "snr"), 8)


@query("""with l as (select l_orderkey as id, l_linenumber as k, l_partkey || ' ' || l_tax || case when l_linenumber % 3 = 0 then '' else ' ' || l_suppkey || ' ' || l_discount || ' ' || l_quantity end as line from lineitem)
  select id, k, len(string_split(line, ' ')) as fields from l where len(string_split(line, ' ')) = 5""")
def five_fields(v):
    rest = F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(F.concat(F.lit(" "), "l_suppkey", F.lit(" "), "l_discount", F.lit(" "), "l_quantity"))
    lines = v.table("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("k"), F.concat(F.col("l_partkey").cast("string"), F.lit(" "), F.col("l_tax").cast("string"), rest).alias("line"))
    return grids.with_fields(lines, "line", 5).select("id", "k", F.size(F.split("line", " ")).cast("long").alias("fields"))


@query(f"""with {OFFSETS} select x, y, cast(x > 0 and x < 150 and y > 0 and y < 4000 as int) as inside, cast(x >= -10 and x <= 160 and y >= -20 and y <= 4020 as int) as near from offsets""")
def frame_tests(v):
    return v.offsets().select("x", "y", grids.in_frame(F.col("x"), F.col("y"), 150, 4000).cast("int").alias("inside"), grids.in_footprint(F.col("x"), F.col("y"), 150, 4000).cast("int").alias("near"))


@query(f"""with {STACK} select pixel, scene, round(case when c >= 0.5 then z end, 6) as masked, round(case when c < 0.1 then 0 else z end, 6) as hard, round(case when c < 0.1 then 0 else c end, 6) as corr from stack""")
def masked_phase(v):
    c = F.col("c")
    return v.ordered_stack().select("pixel", "scene", r6(F.col("z") * F.when(c >= 0.5, 1.0), "masked"), r6(F.when(c < 0.1, 0.0).otherwise(F.col("z")), "hard"), r6(F.when(c < 0.1, 0.0).otherwise(c), "corr"))


@query(f"""with {CELLS}, k as (select r, c, case when r between 5 and 50 and c between 7 and 60 and z > 3 then z end as z from cells),
  b as (select min(r) as r0, max(r) as r1, min(c) as c0, max(c) as c1 from k where z is not null)
  select r, c, round(z, 6) as z from k, b where r between r0 and r1 and c between c0 and c1""")
def trimmed_border(v):
    cells = v.cells().select("r", "c", F.when(F.col("r").between(5, 50) & F.col("c").between(7, 60) & (F.col("z") > 3), F.col("z")).alias("z"))
    return grids.trimmed(cells).select("r", "c", r6(F.col("z"), "z"))


@query(f"""with {CELLS}, land as (select r // 4 as br, c // 4 as bc, avg(im) as land from cells group by 1, 2) select r, c, round(case when land >= 0.1 then z end, 6) as z from cells join land on br = r // 4 and bc = c // 4""")
def land_masked(v):
    cells = v.cells()
    land = cells.groupBy(F.floor(F.col("r") / 4).alias("br"), F.floor(F.col("c") / 4).alias("bc")).agg(F.avg("im").alias("land"))
    return cells.join(land, (F.floor(F.col("r") / 4) == F.col("br")) & (F.floor(F.col("c") / 4) == F.col("bc"))).select("r", "c", r6(F.when(F.col("land") >= 0.1, F.col("z")), "z"))


@query(f"""with {CELLS}, m as (select quantile_disc(z, 0.5) as m from cells) select r, c, round(z, 6) as z from cells, m where abs(z - m) <= 0.8""")
def median_clip(v):
    return grids.near_median(v.cells(), 0.8).select("r", "c", r6(F.col("z"), "z"))


@query(f"""with {STACK} select pixel, scene, round(z, 6) as z from stack where c > 0.3 and pixel % 10 = 0""")
def gated_lines(v):
    return v.ordered_stack().where((F.col("c") > 0.3) & (F.col("pixel") % 10 == 0)).select("pixel", "scene", r6(F.col("z"), "z"))


# --- joins of cells ----------------------------------------------------------------------------------------------


@query(f"""with {CELLS} select a.r, a.c, round(a.z - b.z, 6) as diff, round(a.z * b.im, 6) as prod from cells a join cells b on a.r = b.r and a.c = b.c""")
def grid_join(v):
    cells = v.cells()
    other = cells.select("r", "c", F.col("z").alias("z2"), F.col("im").alias("im2"))
    return cells.join(other, ["r", "c"]).select("r", "c", r6(F.col("z") - F.col("z2"), "diff"), r6(F.col("z") * F.col("im2"), "prod"))


@query(f"""with {STACK}, n as (select count(distinct scene) as n from stack) select pixel, round(sum(z), 6) as total, count(*) as have from stack, n group by pixel having count(*) = any_value(n)""")
def stack_join(v):
    stack = v.stack()
    return stack.groupBy("pixel").agg(r6(F.sum("z"), "total"), F.count("*").alias("have")).where(F.col("have") == stack.agg(F.countDistinct("scene")).scalar())


@query(f"""with {OFFSETS}, {CELLS}, q as (select x, y, cast(trunc(y / 7.0) as bigint) as r, cast(trunc(x / 3.0) as bigint) as c from offsets)
  select q.x, q.y, round(z, 6) as z from q join cells using (r, c)""")
def truncated_lookup(v):
    q = v.offsets().select("x", "y", (F.col("y") / 7.0).cast("long").alias("r"), (F.col("x") / 3.0).cast("long").alias("c"))
    return q.join(v.cells(), ["r", "c"]).select("x", "y", r6(F.col("z"), "z"))


HOLES = f"{CELLS}, holes as (select r, c, case when (r * 7 + c * 3) % 11 < 8 then z end as z from cells)"


@query(f"""with {HOLES}, known as (select * from holes where z is not null),
  d as (select h.r, h.c, k.z, row_number() over (partition by h.r, h.c order by pow(h.r - k.r, 2) + pow(h.c - k.c, 2), k.r, k.c) as n from holes h, known k where abs(h.r - k.r) <= 16 and abs(h.c - k.c) <= 16)
  select r, c, round(z, 6) as z from d where n = 1""")
def nearest_fill_2d(v):
    cells = v.cells().select("r", "c", F.when((F.col("r") * 7 + F.col("c") * 3) % 11 < 8, F.col("z")).alias("z"))
    return grids.nearest_fill(cells, 4).select("r", "c", r6(F.col("z"), "z"))


@query(f"""with {HOLES}, masked as (select r, c, case when r % 2 = 0 then z end as z from holes), known as (select * from masked where z is not null),
  d as (select h.r, h.c, k.z, row_number() over (partition by h.r, h.c order by pow(h.r - k.r, 2) + pow(h.c - k.c, 2), k.r, k.c) as n from masked h, known k where abs(h.r - k.r) <= 16 and abs(h.c - k.c) <= 16 and pow(h.r - k.r, 2) + pow(h.c - k.c, 2) <= 2)
  select m.r, m.c, round(d.z, 6) as z from masked m left join d on d.r = m.r and d.c = m.c and n = 1""")
def nearest_fill_radius(v):
    cells = v.cells().select("r", "c", F.when(((F.col("r") * 7 + F.col("c") * 3) % 11 < 8) & (F.col("r") % 2 == 0), F.col("z")).alias("z"))
    return grids.nearest_fill(cells, 4, radius=2**0.5).select("r", "c", r6(F.col("z"), "z"))


@query(f"""with {CELLS}, s as (select i, j from range(-2, 3) t(i), range(-2, 3) u(j)), p as (select a.r // 16 as br, a.c // 16 as bc, i, j, a.z as x, b.im + b.z as y from cells a, s join cells b on b.r = a.r + i and b.c = a.c + j),
  k as (select br, bc, i, j, 100 * abs(sum(x * y)) / sqrt(sum(x * x) * sum(y * y)) as corr from p group by 1, 2, 3, 4), b as (select *, row_number() over (partition by br, bc order by corr desc, i, j) as n from k)
  select br, bc, i as dr, j as dc, round(corr, 6) as corr from b where n = 1""")
def best_shift(v):
    cells = v.cells()
    return grids.best_shift(cells.select("r", "c", "z"), cells.select("r", "c", (F.col("im") + F.col("z")).alias("z")), 2, 16).select("br", "bc", "dr", "dc", r6(F.col("corr"), "corr"))


@query(f"""with {CELLS}, g as (select r // 8 as br, c // 8 as bc, sum(z * z * im * im) / sqrt(sum(pow(z, 4)) * sum(pow(im, 4))) as g from cells group by 1, 2)
  select br, bc, round(case when g <= 0.5 then 0 else 100 * sqrt(2 * g - 1) end, 6) as corr from g""")
def fourth_order_corr(v):
    g = F.sum(F.col("z") * F.col("z") * F.col("im") * F.col("im")) / F.sqrt(F.sum(F.pow(F.col("z"), F.lit(4))) * F.sum(F.pow(F.col("im"), F.lit(4))))
    return v.cells().groupBy(F.floor(F.col("r") / 8).alias("br"), F.floor(F.col("c") / 8).alias("bc")).agg(g.alias("g")).select("br", "bc", r6(F.when(F.col("g") <= 0.5, 0.0).otherwise(100 * F.sqrt(F.greatest(2 * F.col("g") - 1, F.lit(0.0)))), "corr"))


# --- statistics --------------------------------------------------------------------------------------------------


@query(f"""with {STACK} select pixel, round(avg(coalesce(z, 0)), 6) as topo, count(*) as n from stack group by pixel""")
def average_topo(v):
    return v.stack().groupBy("pixel").agg(r6(F.avg(F.coalesce("z", F.lit(0.0))), "topo"), F.count("*").alias("n"))


@query(f"""with {STACK}, e as (select scene, z, pixel % 97 * 1.5 as elev from stack), f as (select scene, regr_slope(z, elev) as a from e group by scene having count(*) >= 100)
  select e.scene, count(*) as n, round(sum(z - coalesce(a, 0) * elev), 3) as corrected from e left join f on f.scene = e.scene group by e.scene""")
def height_corrected(v):
    e = v.stack().select("scene", "z", (F.col("pixel") % 97 * 1.5).alias("elev"))
    f = e.groupBy("scene").agg(F.regr_slope("z", "elev").alias("a"), F.count("*").alias("n")).where("n >= 100").drop("n")
    return e.join(F.broadcast(f), "scene", "left").groupBy("scene").agg(F.count("*").alias("n"), F.round(F.sum(F.col("z") - F.coalesce("a", F.lit(0.0)) * F.col("elev")), 3).alias("corrected"))


PLANE = """s as (select count(*) as n, sum(r) as x, sum(c) as y, sum(r * r) as xx, sum(r * c) as xy, sum(c * c) as yy, sum(z) as z, sum(r * z) as xz, sum(c * z) as yz from cells),
  d as (select *, n * (xx * yy - xy * xy) - x * (x * yy - xy * y) + y * (x * xy - xx * y) as det from s),
  f as (select (z * (xx * yy - xy * xy) - x * (xz * yy - xy * yz) + y * (xz * xy - xx * yz)) / det as a, (n * (xz * yy - yz * xy) - z * (x * yy - xy * y) + y * (x * yz - xz * y)) / det as b,
    (n * (xx * yz - xy * xz) - x * (x * yz - xz * y) + z * (x * xy - xx * y)) / det as g from d)"""


@query(f"""with {CELLS}, {PLANE} select r, c, round(z - (a + b * r + g * c), 6) as z from cells, f""")
def plane_detrend(v):
    cells = v.cells()
    return grids.without_plane(cells).select("r", "c", r6(F.col("z"), "z"))


@query(f"""with {CELLS} select r, c, round(z - (select avg(z) from cells), 6) as z from cells""")
def mean_detrend(v):
    cells = v.cells()
    return cells.select("r", "c", r6(F.col("z") - cells.agg(F.avg("z")).scalar(), "z"))


@query(f"""with {STACK}, p as (select scene, scene - 4.0 as t, avg(z) as y from stack group by scene), s as (select count(*) as n, sum(t) as a1, sum(t * t) as a2, sum(pow(t, 3)) as a3, sum(pow(t, 4)) as a4, sum(y) as b0, sum(t * y) as b1, sum(t * t * y) as b2 from p),
  d as (select *, n * (a2 * a4 - a3 * a3) - a1 * (a1 * a4 - a3 * a2) + a2 * (a1 * a3 - a2 * a2) as det from s)
  select round((b0 * (a2 * a4 - a3 * a3) - a1 * (b1 * a4 - a3 * b2) + a2 * (b1 * a3 - a2 * b2)) / det, 6) as k0, round((n * (b1 * a4 - b2 * a3) - b0 * (a1 * a4 - a3 * a2) + a2 * (a1 * b2 - b1 * a2)) / det, 6) as k1,
  round((n * (a2 * b2 - a3 * b1) - a1 * (a1 * b2 - b1 * a2) + b0 * (a1 * a3 - a2 * a2)) / det, 6) as k2 from d""")
def polynomial_fit(v):
    p = v.stack().groupBy("scene").agg(F.avg("z").alias("y")).select((F.col("scene") - 4.0).alias("t"), "y")
    return grids.polynomial(p, 2).select(*[r6(F.col(f"k{i}"), f"k{i}") for i in range(3)])


@query(f"""with {STACK} select pixel, round(regr_slope(z, scene * 12) * 365 * -79.58 * 0.0311, 5) as vel from stack group by pixel having count(*) > 1""")
def los_velocity(v):
    return v.stack().groupBy("pixel").agg(F.round(F.regr_slope("z", F.col("scene") * 12) * 365 * -79.58 * 0.0311, 5).alias("vel"), F.count("*").alias("n")).where("n > 1").drop("n")


@query(f"""with {STACK}, m as (select *, count(*) over (partition by pixel) as s, avg(z) over (partition by pixel) as mean, row_number() over (partition by pixel order by scene) as k from stack)
  select pixel, round(sqrt(coalesce(sum(case when k between 3 and s - 1 then pow(z - mean, 2) end), 0) / any_value(s)), 6) as error from m group by pixel""")
def velocity_error(v):
    w = Window.partitionBy("pixel")
    m = v.stack().select("pixel", "z", F.count("*").over(w).alias("s"), F.avg("z").over(w).alias("mean"), F.row_number().over(w.orderBy("scene")).alias("k"))
    part = F.sum(F.when(F.col("k").between(3, F.col("s") - 1), F.pow(F.col("z") - F.col("mean"), F.lit(2))))
    return m.groupBy("pixel").agg(r6(F.sqrt(F.coalesce(part, F.lit(0.0)) / F.first("s")), "error"))


@query(f"""with {CELLS} select r, round(avg(z), 6) as re, round(avg(im), 6) as im, round(sum(z * c) / sum(z), 6) as frequency from cells group by r""")
def line_means(v):
    return v.cells().groupBy("r").agg(r6(F.avg("z"), "re"), r6(F.avg("im"), "im"), r6(F.sum(F.col("z") * F.col("c")) / F.sum("z"), "frequency"))


@query(f"""with {CELLS} select round(atan2(sum(im), sum(z)) / (2 * pi() * 4000 * 0.002), 9) as shift, count(*) as n from cells where abs(im) > 0.1 and z > 0.6""")
def diversity_shift(v):
    return v.cells().where((F.abs(F.col("im")) > 0.1) & (F.col("z") > 0.6)).agg(F.round(F.atan2(F.sum("im"), F.sum("z")) / (2 * math.pi * 4000 * 0.002), 9).alias("shift"), F.count("*").alias("n"))


@query(f"""with {CELLS}, d as (select l.c // 16 as seam, l.z - u.z as d from cells l join cells u on u.r = l.r and u.c = l.c + 5 where l.c % 16 between 11 and 15 and l.c < 48), m as (select seam, median(d) as d from d group by seam)
  select seam, round(d, 6) as step, round(sum(d) over (order by seam), 6) as total from m""")
def seam_offsets(v):
    cells = v.cells()
    right = cells.select("r", (F.col("c") - 5).alias("c"), F.col("z").alias("z2"))
    m = cells.where((F.col("c") % 16).between(11, 15) & (F.col("c") < 48)).join(right, ["r", "c"]).groupBy(F.floor(F.col("c") / 16).alias("seam")).agg(F.median(F.col("z") - F.col("z2")).alias("d"))
    return m.select("seam", r6(F.col("d"), "step"), r6(F.sum("d").over(Window.orderBy("seam")), "total"))  # a row per seam


@query(f"""with {STACK}, p as (select *, pixel // 20 as pr, pixel % 20 as pc from stack) select scene, round(avg(z), 6) as mean, round(stddev_pop(z), 6) as std, count(*) as n from p where pr between 1 and 5 and pc between 8 and 12 group by scene""")
def point_series(v):
    p = v.stack().select("*", F.floor(F.col("pixel") / 20).alias("pr"), (F.col("pixel") % 20).alias("pc"))
    return p.where(F.col("pr").between(1, 5) & F.col("pc").between(8, 12)).groupBy("scene").agg(r6(F.avg("z"), "mean"), r6(F.stddev_pop("z"), "std"), F.count("*").alias("n"))


@query(f"""with {CELLS}, t as (select avg(r / 64.0 * 90) as lat, avg(c) as lon from cells) select round(lat, 6) as lat, round(lon, 6) as lon,
  round(sqrt((pow(pow(6378137.0, 2) * cos(radians(lat)), 2) + pow(pow(6356752.314245, 2) * sin(radians(lat)), 2)) / (pow(6378137.0 * cos(radians(lat)), 2) + pow(6356752.314245 * sin(radians(lat)), 2))), 3) as radius from t""")
def tie_point(v):
    return v.cells().agg(F.avg(F.col("r") / 64.0 * 90).alias("lat"), F.avg("c").alias("lon")).select(r6(F.col("lat"), "lat"), r6(F.col("lon"), "lon"), F.round(grids.earth_radius(F.col("lat")), 3).alias("radius"))


@query(f"""with {STACK}, a as (select pixel, avg(sqrt(z)) as m, avg(z) as p from stack group by pixel), s as (select *, case when sqrt(greatest(p - m * m, 0)) > 0.1 then m / (2 * sqrt(p - m * m)) else 0.1 end as score from a)
  select t.pixel, scene, round(m, 6) as mean, round(score, 6) as score, round(z * score, 6) as scaled from stack t join s using (pixel)""")
def scatterer_modes(v):
    stack = v.stack()
    a = stack.groupBy("pixel").agg(F.avg(F.sqrt("z")).alias("m"), F.avg("z").alias("p"))
    d = F.sqrt(F.greatest(F.col("p") - F.col("m") * F.col("m"), F.lit(0.0)))
    s = a.select("pixel", "m", F.when(d > 0.1, F.col("m") / (2 * d)).otherwise(0.1).alias("score"))
    return stack.join(s, "pixel").select("pixel", "scene", r6(F.col("m"), "mean"), r6(F.col("score"), "score"), r6(F.col("z") * F.col("score"), "scaled"))


# --- neighbourhoods ----------------------------------------------------------------------------------------------


@query(f"""with {CELLS}, k as (select i, j, exp(-(i * i + j * j) / 2.0) as w from range(-2, 3) t(i), range(-2, 3) u(j)), o as (select r as orow, c as ocol from cells where r % 2 = 0 and c % 4 = 0)
  select orow // 2 as r, ocol // 4 as c, round(sum(z * w) / sum(w), 6) as z from o, k join cells on cells.r = orow + i and cells.c = ocol + j group by orow, ocol""")
def filtered_decimated(v):
    kernel = [(i, j, math.exp(-(i * i + j * j) / 2.0)) for i in range(-2, 3) for j in range(-2, 3)]
    return grids.convolved(v.cells(), kernel, 2, 4).select("r", "c", r6(F.col("z"), "z"))


@query(f"""with {CELLS}, p as (select r, c, z * z + im * im as z from cells), k as (select i, j, exp(-(pow(i * 4.0, 2) + pow(j * 8.0, 2)) / (2 * pow(100 / 5.3, 2))) as w from range(-9, 10) t(i), range(-4, 5) u(j)), o as (select r as orow, c as ocol from p where r % 4 = 0 and c % 4 = 0)
  select orow // 4 as r, ocol // 4 as c, round(sum(z * w) / sum(w), 6) as z from o, k join p on p.r = orow + i and p.c = ocol + j group by orow, ocol""")
def gaussian_amplitude(v):
    power = v.cells().select("r", "c", (F.col("z") * F.col("z") + F.col("im") * F.col("im")).alias("z"))
    return grids.convolved(power, grids.gaussian(100, 4.0, 8.0), 4, 4).select("r", "c", r6(F.col("z"), "z"))


@query(f"""with {CELLS} select a.r, a.c, round(avg(b.z), 6) as mean, round(median(b.z), 6) as median from cells a join cells b on b.r between a.r - 1 and a.r + 1 and b.c between a.c - 2 and a.c + 2 where a.r % 3 = 1 and a.c % 5 = 2 group by 1, 2""")
def box_filters(v):
    return grids.windowed(v.cells(), 1, 2, (3, 1), (5, 2)).groupBy("r", "c").agg(r6(F.avg("z"), "mean"), r6(F.median("z"), "median"))


@query(f"""with {CELLS}, k as (select i, i / 408.0 as w from range(-8, 9) t(i)) select a.r, a.c, round(sum(b.z * w), 6) as dx, count(*) as taps from cells a, k join cells b on b.r = a.r and b.c = a.c + i group by 1, 2 having count(*) = 17""")
def x_derivative(v):
    return grids.taps(v.cells(), [(0, i, i / 408.0) for i in range(-8, 9)]).where("taps = 17").select("r", "c", r6(F.col("z"), "dx"), "taps")


@query(f"""with {CELLS}, k as (select i, i / 408.0 as w from range(-8, 9) t(i)) select a.r, a.c, round(sum(b.z * w), 6) as dy, count(*) as taps from cells a, k join cells b on b.c = a.c and b.r = a.r + i group by 1, 2 having count(*) = 17""")
def y_derivative(v):
    return grids.taps(v.cells(), [(i, 0, i / 408.0) for i in range(-8, 9)]).where("taps = 17").select("r", "c", r6(F.col("z"), "dy"), "taps")


@query(f"""with {CELLS}, f as (select r * 64 + c as k, z from cells) select a.k, round(b.z - d.z, 6) as diff from f a join f b on b.k = a.k + 1 join f d on d.k = a.k - 1""")
def flat_difference(v):
    flat = v.cells().select((F.col("r") * 64 + F.col("c")).alias("k"), "z")
    return flat.join(flat.select((F.col("k") - 1).alias("k"), F.col("z").alias("up")), "k").join(flat.select((F.col("k") + 1).alias("k"), F.col("z").alias("down")), "k").select("k", r6(F.col("up") - F.col("down"), "diff"))


@query(f"""with {CELLS}, w as (select a.r, a.c, sum(b.z * b.im) as x, sum(b.z * b.z) as p, sum(b.im * b.im) as q from cells a join cells b on b.r between a.r - 1 and a.r + 1 and b.c between a.c - 1 and a.c + 1 group by 1, 2) select r, c, round(abs(x) / sqrt(p * q), 6) as coherence from w""")
def windowed_coherence(v):
    w = grids.windowed(v.cells(), 1, 1).groupBy("r", "c").agg(F.sum(F.col("z") * F.col("im")).alias("x"), F.sum(F.col("z") * F.col("z")).alias("p"), F.sum(F.col("im") * F.col("im")).alias("q"))
    return w.select("r", "c", r6(F.abs("x") / F.sqrt(F.col("p") * F.col("q")), "coherence"))


@query(f"""with {CELLS}, m as (select a.r, a.c, any_value(a.z) as z, median(b.z) as m from cells a join cells b on b.r between a.r - 2 and a.r + 2 and b.c between a.c - 2 and a.c + 2 group by 1, 2) select r, c, round(case when abs(z - m) > 1.5 then m else z end, 6) as z from m""")
def despeckled(v):
    near = grids.windowed(v.cells(), 2, 2, keep=["z0"])
    return near.groupBy("r", "c").agg(F.first("z0").alias("z0"), F.median("z").alias("m")).select("r", "c", r6(F.when(F.abs(F.col("z0") - F.col("m")) > 1.5, F.col("m")).otherwise(F.col("z0")), "z"))


@query(f"""with recursive {CELLS}, n as (select r * 64 + c as k, r, c from cells where z > (select quantile_disc(z, 0.6) from cells)), e as (select a.k as a, b.k as b from n a join n b on abs(a.r - b.r) + abs(a.c - b.c) = 1),
  reach(k, o) as (select k, k from n union select x.k, e.b from reach x join e on e.a = x.o), m as (select k, min(o) as root from reach group by k), s as (select root, count(*) as size from m group by root having count(*) >= 3)
  select root, size, row_number() over (order by size desc, root) as rank from s""")
def grid_components(v):
    cells = v.cells()
    some = cells.where(F.col("z") > cells.agg(F.expr("percentile_disc(0.6) within group (order by z)")).scalar())
    return grids.largest_components(some.select((F.col("r") * 64 + F.col("c")).alias("k"), "r", "c"), 3)


@query(f"""with {CELLS}, w as (select r // 32 as s, r, c, z from cells), e as (select s, min(c) as c0, max(c) as c1 from w where z is not null group by s) select a.s, a.c1 as last, b.c0 as first, (a.c1 + b.c0) // 2 as seam from e a join e b on b.s = a.s + 1""")
def seam_places(v):
    e = v.cells().where("z is not null").groupBy(F.floor(F.col("r") / 32).alias("s")).agg(F.min("c").alias("c0"), F.max("c").alias("c1"))
    other = e.select((F.col("s") - 1).alias("s"), F.col("c0").alias("first"))
    return e.join(other, "s").select("s", F.col("c1").alias("last"), "first", F.floor((F.col("c1") + F.col("first")) / 2).alias("seam"))


@query(f"""with {CELLS}, f as (select r, c, z from cells where r < 20 union all select r + 5, c, im from cells where r between 30 and 40), g as (select i as r, j as c from range(0, 64) t(i), range(0, 64) u(j) where i < 46)
  select g.r, g.c, round(max(f.z), 6) as z from g left join f on f.r = g.r and f.c = g.c group by 1, 2""")
def padded_stitch(v):
    cells = v.cells()
    frames = cells.where(F.col("r") < 20).select("r", "c", "z").union(cells.where(F.col("r").between(30, 40)).select(F.col("r") + 5, "c", "im"))
    every = v.spark.range(46 * 64).select(F.floor(F.col("id") / 64).alias("r"), (F.col("id") % 64).alias("c"))
    return every.join(frames, ["r", "c"], "left").groupBy("r", "c").agg(r6(F.max("z"), "z"))


@query(f"""with {CELLS}, q as (select r, c, r / 2.0 as y, c / 2.0 as x from cells where r < 63 and c < 63), n as (select q.r, q.c, sum(k.z * (1 - abs(k.r - q.y)) * (1 - abs(k.c - q.x))) as s, count(*) as n, sum((1 - abs(k.r - q.y)) * (1 - abs(k.c - q.x))) as w
  from q join cells k on abs(k.r - q.y) < 1 and abs(k.c - q.x) < 1 group by 1, 2) select n.r, n.c, round(s, 6) as dem, round(s - z, 6) as diff from n join cells using (r, c) where abs(w - 1) < 1e-9""")
def resampled_join(v):
    cells = v.cells()
    fine = grids.upsampled(cells, 2).where("r < 63 and c < 63")
    return fine.join(cells.select("r", "c", F.col("z").alias("z0")), ["r", "c"]).select("r", "c", r6(F.col("z"), "dem"), r6(F.col("z") - F.col("z0"), "diff"))


@query(f"""with {CELLS} select r, c, case when z is null then -9999 else round(z, 6) end as z, c / 64.0 * 0.5 + 100 as lon, 40 - r / 64.0 * 0.5 as lat, cast(round((least(greatest((z - 2) / 4, 0), 1)) * 255) as int) as colour from cells""")
def export_cells(v):
    colour = F.round(F.least(F.greatest((F.col("z") - 2) / 4, F.lit(0.0)), F.lit(1.0)) * 255).cast("int")
    return v.cells().select("r", "c", F.coalesce(r6(F.col("z"), "z"), F.lit(-9999.0)).alias("z"), (F.col("c") / 64.0 * 0.5 + 100).alias("lon"), (40 - F.col("r") / 64.0 * 0.5).alias("lat"), colour.alias("colour"))


@query(f"""with {CELLS} select r, c, round(log10(sqrt(z * z + im * im)) + 100, 6) as amplitude from cells where r % 2 = 0""")
def log_amplitude(v):
    return v.cells().where(F.col("r") % 2 == 0).select("r", "c", r6(F.log10(F.hypot(F.col("z"), F.col("im"))) + 100, "amplitude"))


@query(f"""with {STACK}, m as (select *, avg(z) over (partition by pixel order by scene rows between 2 preceding and 2 following) as low from stack) select pixel, scene, round(z - low, 6) as high, round(low, 6) as low from m""")
def temporal_filter(v):
    low = F.avg("z").over(Window.partitionBy("pixel").orderBy("scene").rowsBetween(-2, 2))
    return v.stack().select("pixel", "scene", "z", low.alias("l")).select("pixel", "scene", r6(F.col("z") - F.col("l"), "high"), r6(F.col("l"), "low"))
