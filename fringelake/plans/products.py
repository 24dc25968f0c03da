"""Queries on products: XML texts, registration and resampling, projections, frames and tiles, each with its SQL."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import algebra as A
from ..operators import grids, joins, projections
from .grids import PLANE
from .queries import query
from .views import CELLS, OFFSETS, STACK


def r6(x, name: str):
    return F.round(x, 6).alias(name)


@query("""with o as (select o_custkey as id, o_orderkey as k, cast(o_orderdate as date) as d, round(o_totalprice, 2) as p, row_number() over (partition by o_custkey order by o_orderkey) as n, count(*) over (partition by o_custkey) as bursts from orders)
  select id, any_value(bursts) as bursts, max(case when n = 2 then cast(k as varchar) end) as second_id, max(case when n = 1 then strftime(d, '%Y%j') end) as first_day, round(sum(p), 2) as total from o group by id""")
def xml_product(v):
    """A product's XML per customer, read back by paths: an attribute, the k-th sibling, a date, and a sum."""
    o = v.table("orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("d"), F.round("o_totalprice", 2).alias("p"))
    one = F.concat(F.lit("<burst><id>"), F.col("k").cast("string"), F.lit("</id><day>"), F.col("d").cast("string"), F.lit("</day><p>"), F.col("p").cast("string"), F.lit("</p></burst>"))
    x = o.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("k", one.alias("x")))).alias("b"))
    x = x.select("id", F.concat(F.lit('<product><list count="'), F.size("b").cast("string"), F.lit('">'), F.array_join(F.transform("b", lambda e: e["x"]), ""), F.lit("</list></product>")).alias("xml"))
    second = F.xpath_string("xml", F.lit("/product/list/burst[2]/id"))
    day = F.date_format(F.xpath_string("xml", F.lit("/product/list/burst[1]/day")).cast("date"), "yyyyDDD")
    return x.select("id", F.xpath_long("xml", F.lit("/product/list/@count")).alias("bursts"), F.nullif(second, F.lit("")).alias("second_id"), day.alias("first_day"), F.round(F.xpath_double("xml", F.lit("sum(/product/list/burst/p)")), 2).alias("total"))


@query(f"""with {CELLS}, {PLANE}, k as (select -a as shift, b as stretch, g as cross_ from f) select case when shift < 0 then cast(trunc(shift) as int) - 1 else cast(trunc(shift) as int) end as whole,
  round(case when shift < 0 then shift - trunc(shift) + 1 else shift - trunc(shift) end, 5) as fraction, round(stretch, 6) as stretch, round(cross_, 6) as cross_ from k""")
def affine_from_trend(v):
    """Shift, split into a whole and a positive fraction, and stretches of the offsets' plane."""
    a, b, g = grids.plane(v.cells())
    whole, fraction = projections.split_shift(-a)
    return v.spark.createDataFrame([(whole, round(fraction, 5), round(b, 6), round(g, 6))], "whole int, fraction double, stretch double, cross_ double")


AFFINE = "q as (select r, c, r + 0.75 + 0.002 * r as y, c - 1.5 + 0.004 * c as x from cells)"


@query(f"""with {CELLS}, {AFFINE} select q.r, q.c, coalesce(cast(least(greatest(floor(k.z * 1000 + 0.5), -32768), 32767) as int), 0) as near from q left join cells k on k.r = cast(floor(q.y + 0.5) as bigint) and k.c = cast(floor(q.x + 0.5) as bigint)""")
def resampled_nearest(v):
    q = v.cells().select("r", "c", (F.col("r") + 0.75 + 0.002 * F.col("r")).alias("y"), (F.col("c") - 1.5 + 0.004 * F.col("c")).alias("x"))
    return projections.nearest_sample(q, v.cells()).select("r", "c", F.coalesce(projections.short(F.col("z") * 1000), F.lit(0)).alias("near"))


@query(f"""with {CELLS}, {AFFINE}, n as (select q.r, q.c, sum(k.z * (1 - abs(k.r - y)) * (1 - abs(k.c - x))) as s, sum((1 - abs(k.r - y)) * (1 - abs(k.c - x))) as w from q join cells k on abs(k.r - y) < 1 and abs(k.c - x) < 1 group by 1, 2)
  select q.r, q.c, case when w > 0.999999 then round(s, 6) else 0 end as z from q left join n using (r, c)""")
def resampled_bilinear(v):
    q = v.cells().select((F.col("r") * 4096 + F.col("c")).alias("pid"), (F.col("r") + 0.75 + 0.002 * F.col("r")).alias("y"), (F.col("c") - 1.5 + 0.004 * F.col("c")).alias("x"))
    out = joins.bilinear(q, v.cells().select("r", "c", "z"))
    return out.select(F.floor(F.col("pid") / 4096).alias("r"), (F.col("pid") % 4096).alias("c"), F.coalesce(r6(F.col("z"), "z"), F.lit(0.0)).alias("z"))


@query(f"""with {CELLS}, h as (select r, c, case when (r + c) % 3 > 0 then z end as z from cells), coarse as (select r // 8 as br, c // 8 as bc, avg(z) as m from h group by 1, 2) select h.r, h.c, round(coalesce(z, m), 6) as z from h join coarse on br = h.r // 8 and bc = h.c // 8""")
def filled_from_coarse(v):
    h = v.cells().select("r", "c", F.when((F.col("r") + F.col("c")) % 3 > 0, F.col("z")).alias("z"))
    coarse = h.groupBy(F.floor(F.col("r") / 8).alias("br"), F.floor(F.col("c") / 8).alias("bc")).agg(F.avg("z").alias("m"))
    return h.join(coarse, (F.floor(F.col("r") / 8) == F.col("br")) & (F.floor(F.col("c") / 8) == F.col("bc"))).select("r", "c", r6(F.coalesce("z", "m"), "z"))


LOOKUP = "look as (select r, c, z, 100 + c * 0.011 + r * 0.0007 as lon, 35 + r * 0.009 - c * 0.0005 as lat from cells)"


@query(f"""with {CELLS}, {LOOKUP} select cast(floor((lat - 34.8963137) / 0.02031) as bigint) as row, cast(floor((lon - 99.8917373) / 0.02031) as bigint) as col, round(median(z), 6) as z, count(*) as n from look group by 1, 2""")
def radar_to_map(v):
    return projections.to_map(v.cells(), 34.8963137, 99.8917373, 0.02031).groupBy("row", "col").agg(r6(F.median("z"), "z"), F.count("*").alias("n"))


@query(f"""with {CELLS}, {LOOKUP}, p as (select r, c, z, (lat - 35) as dy, (lon - 100) as dx from look), i as (select z, (dy * 0.011 + dx * 0.0005) / (0.009 * 0.011 + 0.0005 * 0.0007) as r, (dx * 0.009 - dy * 0.0007) / (0.009 * 0.011 + 0.0005 * 0.0007) as c from p)
  select cast(round(r) as bigint) as r, cast(round(c) as bigint) as c, round(z, 6) as z from i""")
def map_to_radar(v):
    return projections.to_radar(v.cells()).select("r", "c", r6(F.col("z"), "z"))


@query(f"""with {CELLS}, n as (select max(r) as m from cells) select (m - r) // 2 as r, c // 2 as c, round(avg(z * 100), 4) as topo from cells, n group by 1, 2""")
def dem_to_radar(v):
    cells = v.cells()
    flipped = cells.withColumn("r", cells.agg(F.max("r")).scalar() - F.col("r"))
    return flipped.groupBy(F.floor(F.col("r") / 2).alias("r"), F.floor(F.col("c") / 2).alias("c")).agg(F.round(F.avg(F.col("z") * 100), 4).alias("topo"))


@query("""with p as (select c_custkey as id, radians(c_acctbal / 250) as la, radians((c_custkey % 40) / 10.0 - 2) as dl from customer), k as (select *, 0.006694379990141316 as e2, 0.006694379990141316 / (1 - 0.006694379990141316) as ep from p),
  n as (select *, 6378137.0 / sqrt(1 - e2 * pow(sin(la), 2)) as n, pow(tan(la), 2) as t, ep * pow(cos(la), 2) as q, cos(la) * dl as a, 6378137.0 * ((1 - e2 / 4 - 3 * e2 * e2 / 64 - 5 * pow(e2, 3) / 256) * la - (3 * e2 / 8 + 3 * e2 * e2 / 32 + 45 * pow(e2, 3) / 1024) * sin(2 * la) + (15 * e2 * e2 / 256 + 45 * pow(e2, 3) / 1024) * sin(4 * la) - 35 * pow(e2, 3) / 3072 * sin(6 * la)) as m from k)
  select id, round(500000 + 0.9996 * n * (a + (1 - t + q) * pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * q - 58 * ep) * pow(a, 5) / 120), 2) as east, round(0.9996 * (m + n * tan(la) * (a * a / 2 + (5 - t + 9 * q + 4 * q * q) * pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * q - 330 * ep) * pow(a, 6) / 720)), 2) as north from n""")
def transverse_mercator(v):
    east, north = projections.utm(F.col("c_acctbal") / 250, (F.col("c_custkey") % 40) / 10.0 - 2)
    return v.table("customer").select(F.col("c_custkey").alias("id"), F.round(east, 2).alias("east"), F.round(north, 2).alias("north"))


@query(f"""with {CELLS}, g as (select c, i, i * 1.25 as y from (select distinct c from cells), range(0, 50) t(i)) select g.c, g.i as line, round(a.z * (1 - (y - floor(y))) + case when y = floor(y) then 0 else b.z * (y - floor(y)) end, 6) as z from g join cells a on a.c = g.c and a.r = cast(floor(y) as bigint) left join cells b on b.c = g.c and b.r = cast(floor(y) as bigint) + 1""")
def new_line_rate(v):
    cells = v.cells()
    g = cells.select("c").distinct().select("c", F.explode(F.sequence(F.lit(0), F.lit(49))).alias("line")).withColumn("y", F.col("line") * 1.25)
    g = g.withColumn("r", F.floor("y")).withColumn("w", F.col("y") - F.col("r"))
    a, b = cells.select("r", "c", F.col("z").alias("z0")), cells.select((F.col("r") - 1).alias("r"), "c", F.col("z").alias("z1"))
    return g.join(a, ["r", "c"]).join(b, ["r", "c"], "left").select("c", F.col("line").cast("long").alias("line"), r6(F.col("z0") * (1 - F.col("w")) + F.when(F.col("w") == 0, 0.0).otherwise(F.col("z1") * F.col("w")), "z"))


@query(f"""with {CELLS}, t as (select r // 16 as tr, c // 16 as tc, r, c, z + (r // 16) * 6.283185307179586 as z from cells), e as (select a.tr, a.tc, round(median(b.z - a.z) / (2 * pi())) as k from t a join t b on b.r = a.r + 1 and b.c = a.c and b.tr = a.tr + 1 group by 1, 2)
  select t.r, t.c, round(t.z - 2 * pi() * coalesce((select sum(k) from e where e.tc = t.tc and e.tr < t.tr), 0), 6) as z from t""")
def assembled_tiles(v):
    """Tiles of unwrapped phase with their whole cycles against the tile above taken out, summed down each column of tiles."""
    t = v.cells().select(F.floor(F.col("r") / 16).alias("tr"), F.floor(F.col("c") / 16).alias("tc"), "r", "c", (F.col("z") + F.floor(F.col("r") / 16) * 2 * math.pi).alias("z"))
    edge = t.where(F.col("r") % 16 == 15).select((F.col("r") + 1).alias("r"), "c", F.col("z").alias("above"))
    e = t.where(F.col("r") % 16 == 0).join(edge, ["r", "c"]).groupBy("tr", "tc").agg(F.round(F.median(F.col("z") - F.col("above")) / (2 * math.pi)).alias("k"))
    tiles = t.select("tr", "tc").distinct().join(e, ["tr", "tc"], "left")
    total = F.sum(F.coalesce("k", F.lit(0.0))).over(Window.partitionBy("tc").orderBy("tr"))  # a row per tile
    return t.join(tiles.select("tr", "tc", total.alias("n")), ["tr", "tc"]).select("r", "c", r6(F.col("z") - 2 * math.pi * F.col("n"), "z"))


@query(f"""with {CELLS}, s as (select i, j from range(-1, 2) t(i), range(-1, 2) u(j)), p as (select i, j, sqrt(a.z * a.z + a.im * a.im) as x, b.r * 3 + b.z as y from cells a, s join cells b on b.r = a.r + i and b.c = a.c + j), k as (select i, j, 100 * abs(sum(x * y)) / sqrt(sum(x * x) * sum(y * y)) as corr from p group by 1, 2)
  select i as dr, j as dc, round(corr, 6) as corr from k order by corr desc, i, j limit 1""")
def topography_match(v):
    cells = v.cells()
    best = grids.best_shift(cells.select("r", "c", F.hypot("z", "im").alias("z")), cells.select("r", "c", (F.col("r") * 3 + F.col("z")).alias("z")), 1, 1 << 20)
    return best.select("dr", "dc", r6(F.col("corr"), "corr"))


@query(f"""with {OFFSETS}, b as (select x // 10 as px, y // 500 as py, avg(dx) as dx, avg(dy) as dy, max(snr) as snr, count(*) as n from offsets where snr > 15 group by 1, 2) select px, py, round(dx * 4.1, 6) as range_m, round(dy * 9.4, 6) as azimuth_m, snr, n from b where n >= 2""")
def pixel_tracking(v):
    b = v.offsets().where("snr > 15").groupBy(F.floor(F.col("x") / 10).alias("px"), F.floor(F.col("y") / 500).alias("py")).agg(F.avg("dx").alias("dx"), F.avg("dy").alias("dy"), F.max("snr").alias("snr"), F.count("*").alias("n"))
    return b.where("n >= 2").select("px", "py", r6(F.col("dx") * 4.1, "range_m"), r6(F.col("dy") * 9.4, "azimuth_m"), "snr", "n")


@query("""select user_id as scene, round(min(value) + 100 / 1680.0 / 86400, 9) as clock_start, cast(max(event_id) - 100 as bigint) as num_lines, 1680.0 as prf from events group by 1""")
def shifted_params(v):
    e = v.table("events").groupBy(F.col("user_id").alias("scene")).agg(F.min("value").alias("t"), F.max("event_id").alias("n"))
    return e.select("scene", F.round(F.col("t") + 100 / 1680.0 / 86400, 9).alias("clock_start"), (F.col("n") - 100).alias("num_lines"), F.lit(1680.0).alias("prf"))


@query(f"""with {STACK}, m as (select scene, pixel, z, 0.02 * scene * sin(pixel / 10.0) as tide from stack) select pixel, scene, round(z - tide * 4 * pi() / 0.0311, 6) as phase, round(tide * -1000, 6) as los_mm from m""")
def tide_corrected(v):
    tide = 0.02 * F.col("scene") * F.sin(F.col("pixel") / 10.0)
    return v.stack().select("pixel", "scene", r6(F.col("z") - tide * 4 * math.pi / 0.0311, "phase"), r6(tide * -1000, "los_mm"))


@query(f"""with {CELLS}, k as (select r, c, case when im > -0.3 then z end as z from cells), b as (select *, max(case when z is not null then c end) over (partition by r order by c) as c0 from k), f as (select b.r, b.c, b.z as own, coalesce(b.z, a.z, 0) as z from b left join k a on a.r = b.r and a.c = b.c0),
  w as (select r, c, own, 2 * z - 2 * pi() * floor((2 * z + pi()) / (2 * pi())) as p from f), d as (select r, c, own, p, p - lag(p) over (partition by r order by c) as d from w), s as (select r, c, own, coalesce(d - 2 * pi() * floor((d + pi()) / (2 * pi())), p) as step from d)
  select r, c, case when own is not null then round(sum_, 5) end as phase from (select r, c, own, sum(step) over (partition by r order by c) as sum_ from s)""")
def masked_unwrap(v):
    """Low coherence masked, gaps filled along the row, rows unwrapped, the mask put back."""
    w = Window.partitionBy("r").orderBy("c")
    k = v.cells().select("r", "c", F.when(F.col("im") > -0.3, F.col("z")).alias("own"))
    p = k.select("r", "c", "own", A.wrap(2 * F.coalesce(F.last("own", True).over(w), F.lit(0.0))).alias("p"))
    s = p.select("r", "c", "own", F.coalesce(A.wrap(F.col("p") - F.lag("p").over(w)), F.col("p")).alias("step"))
    return s.select("r", "c", "own", F.sum("step").over(w).alias("t")).select("r", "c", F.when(F.col("own").isNotNull(), F.round("t", 5)).alias("phase"))
