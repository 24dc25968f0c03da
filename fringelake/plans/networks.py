"""Queries on scenes, pairs, orbits, parameters, texts and streams, each with its SQL."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import algebra as A
from ..functions.rpn import compile_rpn
from ..operators import joins, orbits, tiles
from .queries import query
from .views import CELLS, PAIRS, SCENES, STACK

LAMBDA = 0.0311


def r6(x, name: str):
    return F.round(x, 6).alias(name)


def _pairs(v):
    return joins.select_pairs(v.scenes(), 100, 40)


# --- networks ----------------------------------------------------------------------------------------------------


@query("""with s as (select s_nationkey as net, s_suppkey as id, s_suppkey * 12 as day from supplier), d as (select *, lead(day) over w - day as d1, lead(day, 2) over w - lead(day) over w as d2 from s window w as (partition by net order by id))
  select net, id, round(50.0 / d1, 6) as own, round(-50.0 / d2, 6) as after from d where d2 is not null""")
def smoothness_terms(v):
    w = Window.partitionBy("net").orderBy("id")
    s = v.table("supplier").select(F.col("s_nationkey").alias("net"), F.col("s_suppkey").alias("id"), (F.col("s_suppkey") * 12).alias("day"))
    d = s.select("net", "id", (F.lead("day").over(w) - F.col("day")).alias("d1"), (F.lead("day", 2).over(w) - F.lead("day").over(w)).alias("d2"))
    return d.where("d2 is not null").select("net", "id", r6(50.0 / F.col("d1"), "own"), r6(-50.0 / F.col("d2"), "after"))


@query(f"""with {PAIRS}, s as (select p.ref, p.rep, s.id as col, 1.0 as g from pairs p join scenes s on s.id >= p.ref and s.id < p.rep) select ref, rep, col, g from s union all select ref, rep, -1, round((b2 - b1) * 0.0004, 9) from pairs""")
def design_rows(v):
    p = _pairs(v)
    ones = joins.covered(p, v.scenes(), 16).select("ref", "rep", F.col("scene").alias("col"), F.lit(1.0).alias("g"))
    return ones.union(p.select("ref", "rep", F.lit(-1).cast("long"), F.round((F.col("b2") - F.col("b1")) * 0.0004, 9)))


@query(f"with {PAIRS} select ref as a, rep as b, 1 as hit from pairs union all select rep, ref, 1 from pairs union all select id, id, 0 from scenes")
def hit_entries(v):
    p, one = _pairs(v), F.lit(1)
    return p.select(F.col("ref").alias("a"), F.col("rep").alias("b"), one.alias("hit")).union(p.select("rep", "ref", one)).union(v.scenes().select("id", "id", F.lit(0)))


@query(f"""with {PAIRS}, e as (select ref, rep, d2 - d1 as gap from pairs), k as (select distinct a.ref, a.rep from e a join e b on b.ref = a.rep and abs(a.gap - b.gap) < 5 union select distinct b.ref, b.rep from e a join e b on b.ref = a.rep and abs(a.gap - b.gap) < 5)
  select id, mode, sum(mark) as balance, count(*) as degree from (select ref as id, 0 as mode, 1 as mark from e union all select rep, 0, -1 from e union all select ref, 1, 1 from k union all select rep, 1, -1 from k) group by id, mode""")
def edge_modes(v):
    p = _pairs(v)
    e = p.select("ref", "rep", F.lit(0).alias("mode")).union(joins.symmetric_both(p).select("ref", "rep", F.lit(1)))
    ends = F.explode(F.array(F.struct(F.col("ref").alias("id"), F.lit(1).alias("mark")), F.struct(F.col("rep").alias("id"), F.lit(-1).alias("mark"))))
    return e.select("mode", ends.alias("e")).groupBy("e.id", "mode").agg(F.sum("e.mark").alias("balance"), F.count("*").alias("degree"))


@query(f"""with {STACK}, m as (select *, case when scene < 4 then 1 when scene > 4 then -1 else 0 end as mark from stack), s as (select pixel, -sum(z * mark) / nullif(sum(abs(mark)), 0) as screen from m group by pixel)
  select m.pixel, scene, round(z + coalesce(screen, 0) * mark, 6) as corrected from m join s using (pixel)""")
def applied_screen(v):
    mark = F.when(F.col("scene") < 4, 1).when(F.col("scene") > 4, -1).otherwise(0)
    m = v.stack().withColumn("mark", mark)
    s = m.groupBy("pixel").agg((-F.sum(F.col("z") * F.col("mark")) / F.nullif(F.sum(F.abs("mark")), F.lit(0))).alias("screen"))
    return m.join(s, "pixel").select("pixel", "scene", r6(F.col("z") + F.coalesce("screen", F.lit(0.0)) * F.col("mark"), "corrected"))


@query(f"""with {STACK}, n as (select scene, case when scene % 5 = 0 then 0.0 else round(stddev_pop(z), 6) end as noise from stack group by scene) select scene, noise, row_number() over (order by noise = 0, abs(noise) desc, scene) as rank from n""")
def scene_noise_rank(v):
    n = v.stack().groupBy("scene").agg(F.when(F.col("scene") % 5 == 0, 0.0).otherwise(F.round(F.stddev_pop("z"), 6)).alias("noise"))
    w = Window.orderBy(F.col("noise") == 0, F.desc(F.abs("noise")), "scene")  # one row a scene
    return n.select("scene", "noise", F.row_number().over(w).alias("rank"))


@query(None)
def sbas_series(v):
    """Displacements, velocity, height error and misfit of every pixel from the network that the pair selection gives."""
    scenes = v.spark.createDataFrame([(k, 12 * k, (k * 37 % 11) * 9.0) for k in range(1, 8)], "id long, day int, bperp double")
    pairs = [(r.ref - 1, r.rep - 1, r.b2 - r.b1) for r in joins.select_pairs(scenes, 30, 200).orderBy("ref", "rep").collect()]  # a network of seven scenes
    z = v.stack().groupBy("pixel").agg(F.map_from_entries(F.collect_list(F.struct("scene", "z"))).alias("z"), F.avg("c").alias("c"))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("intf"), (F.try_element_at("z", F.lit(b + 1)) - F.try_element_at("z", F.lit(a + 1))).alias("phase")) for k, (a, b, _) in enumerate(pairs)]))
    s = z.select("pixel", A.sigma(F.col("c")).alias("sigma"), each.alias("e")).select("pixel", "e.intf", "e.phase", "sigma")
    return tiles.sbas_series(s, pairs, [12.0 * k for k in range(7)], smooth=1.0)


@query(f"""with {STACK}, s as (select pixel, scene, z, 1993 + scene // 4 as y, scene * 40 % 365 as d from stack), p as (select pixel, sum(z) as phase, sum((y - 1993) * 365 + d) as days from s group by pixel) select pixel, round(phase / days * 365 * {LAMBDA} * -79.58, 6) as vel from p where days > 0""")
def velocity_by_years(v):
    s = v.stack().select("pixel", "z", (F.floor(F.col("scene") / 4) * 365 + F.col("scene") * 40 % 365).alias("days"))
    return s.groupBy("pixel").agg(F.sum("z").alias("phase"), F.sum("days").alias("days")).where("days > 0").select("pixel", r6(F.col("phase") / F.col("days") * 365 * LAMBDA * -79.58, "vel"))


# --- orbits and geometry -----------------------------------------------------------------------------------------

ORBIT = """orbit as (select k, 86400.0 * 3 + 500 + k * 10 as t, 7071000 * cos(0.0105 * k) * cos(0.2) as x, 7071000 * cos(0.0105 * k) * sin(0.2) as y, 7071000 * sin(0.0105 * k) as z from (select s_suppkey - 1 as k from supplier where s_suppkey <= 100))"""
POINTS = """points as (select c_custkey as id, (c_custkey % 40) / 2.0 as lon, c_acctbal / 250 as lat, cast(c_custkey % 900 as double) as h from customer)"""
XYZ = f"""{POINTS}, n as (select *, 6378137.0 / sqrt(1 - {orbits.E2!r} * pow(sin(radians(lat)), 2)) as n from points),
  xyz as (select id, lon, lat, h, (n + h) * cos(radians(lat)) * cos(radians(lon)) as px, (n + h) * cos(radians(lat)) * sin(radians(lon)) as py, (n * (1 - {orbits.E2!r}) + h) * sin(radians(lat)) as pz from n)"""


def _orbit(v):
    k = F.col("s_suppkey") - 1
    a = 0.0105 * k
    o = v.table("supplier").where("s_suppkey <= 100")
    return o.select(k.alias("k"), (86400.0 * 3 + 500 + k * 10).alias("t"), (7071000 * F.cos(a) * math.cos(0.2)).alias("x"), (7071000 * F.cos(a) * math.sin(0.2)).alias("y"), (7071000 * F.sin(a)).alias("z"))


def _points(v):
    p = v.table("customer").select(F.col("c_custkey").alias("id"), ((F.col("c_custkey") % 40) / 2.0).alias("lon"), (F.col("c_acctbal") / 250).alias("lat"), (F.col("c_custkey") % 900).cast("double").alias("h"))
    x, y, z = orbits.to_xyz(F.col("lon"), F.col("lat"), F.col("h"))
    return p.select("*", x.alias("px"), y.alias("py"), z.alias("pz"))


@query(f"with {ORBIT} select k, t, round(x, 3) as x, round(y, 3) as y, round(z, 3) as z from orbit where t between 86400 * 3 + 900 - 240 and 86400 * 3 + 900 + 240")
def orbit_window(v):
    mid = 86400 * 3 + 900
    return _orbit(v).where(F.col("t").between(mid - 240, mid + 240)).select("k", "t", *[F.round(x, 3).alias(x) for x in "xyz"])


@query(f"with {ORBIT} select 'vector ' || k as key, printf('%d %.3f %.3f %.3f %.3f', k, floor(t * 1000 + 0.5) / 1000, x, y, z) as line from orbit")
def orbit_lines(v):
    return _orbit(v).select(F.concat(F.lit("vector "), F.col("k").cast("string")).alias("key"), F.format_string("%d %.3f %.3f %.3f %.3f", "k", F.floor(F.col("t") * 1000 + 0.5) / 1000, "x", "y", "z").alias("line"))


@query(f"with {XYZ} select id, round(px, 3) as x, round(py, 3) as y, round(pz, 3) as z, round(lon, 6) as lon, round(lat, 6) as lat, round(h, 3) as h from xyz")
def geodetic_round_trip(v):
    lon, lat, h = orbits.to_geodetic(F.col("px"), F.col("py"), F.col("pz"))
    return _points(v).select("id", F.round("px", 3).alias("x"), F.round("py", 3).alias("y"), F.round("pz", 3).alias("z"), r6(lon, "lon"), r6(lat, "lat"), F.round(F.round(h, 4), 3).alias("h"))


NEAREST = f"""{XYZ}, {ORBIT}, d as (select p.*, k, t, x, y, z, pow(x - px, 2) + pow(y - py, 2) + pow(z - pz, 2) as d2 from xyz p, orbit), w as (select *, lag(d2) over (partition by id order by k) as before, lead(d2) over (partition by id order by k) as after, row_number() over (partition by id order by d2, k) as n from d),
  best as (select *, t + coalesce((before - after) / (2 * nullif(before - 2 * d2 + after, 0)) * 10, 0) as t0 from w where n = 1)"""


@query(f"with {NEAREST} select id, k, round(sqrt(d2), 2) as distance, round(t0, 3) as time, round((sqrt(d2) - 690000) / 9.4, 1) as range, round((t0 - 259700) * 1680, 0) as azimuth from best")
def points_to_radar(v):
    d = orbits.closest(_points(v), _orbit(v))
    size = F.sqrt("best.d2")
    return d.select("id", "best.k", F.round(size, 2).alias("distance"), F.round("t0", 3).alias("time"), F.round((size - 690000) / 9.4, 1).alias("range"), F.round((F.col("t0") - 259700) * 1680, 0).alias("azimuth"))


@query(f"""with {NEAREST}, u as (select id, (x - px) / sqrt(d2) as a, (y - py) / sqrt(d2) as b, (z - pz) / sqrt(d2) as c, radians(lon) as lo, radians(lat) as la from best)
  select id, round(-sin(lo) * a + cos(lo) * b, 6) as east, round(-sin(la) * cos(lo) * a - sin(la) * sin(lo) * b + cos(la) * c, 6) as north, round(cos(la) * cos(lo) * a + cos(la) * sin(lo) * b + sin(la) * c, 6) as up from u""")
def look_vectors(v):
    d = orbits.closest(_points(v), _orbit(v)).withColumn("k", F.col("best.k")).join(F.broadcast(_orbit(v).select("k", "x", "y", "z")), "k")
    e, n, u = orbits.east_north_up(F.col("lon"), F.col("lat"), F.col("x") - F.col("px"), F.col("y") - F.col("py"), F.col("z") - F.col("pz"))
    return d.select("id", r6(e, "east"), r6(n, "north"), r6(u, "up"))


@query(f"""with {ORBIT}, other as (select k, x + 120 + k * 0.1 as x, y - 80 as y, z + 3500 as z from orbit), a as (select * from orbit where k in (10, 50, 90)), d as (select a.k as anchor, o.k, sqrt(pow(a.x - o.x, 2) + pow(a.y - o.y, 2) + pow(a.z - o.z, 2)) as b, row_number() over (partition by a.k order by pow(a.x - o.x, 2) + pow(a.y - o.y, 2) + pow(a.z - o.z, 2), o.k) as n from a, other o where abs(a.k - o.k) <= 20)
  select anchor, k, round(b, 3) as baseline from d where n = 1""")
def orbit_baseline(v):
    other = _orbit(v).select("k", (F.col("x") + 120 + F.col("k") * 0.1).alias("x"), (F.col("y") - 80).alias("y"), (F.col("z") + 3500).alias("z"), F.floor(F.col("k") / 20).alias("b"))
    a = _orbit(v).where("k in (10, 50, 90)").select(F.col("k").alias("anchor"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("z").alias("az"), F.explode(F.array(*[F.floor(F.col("k") / 20) + i for i in (-1, 0, 1)])).alias("b"))
    d2 = F.pow(F.col("ax") - F.col("x"), F.lit(2)) + F.pow(F.col("ay") - F.col("y"), F.lit(2)) + F.pow(F.col("az") - F.col("z"), F.lit(2))
    met = a.join(other, "b").where(F.abs(F.col("anchor") - F.col("k")) <= 20)
    return met.groupBy("anchor").agg(F.min(F.struct(d2.alias("d2"), "k")).alias("m")).select("anchor", "m.k", F.round(F.sqrt("m.d2"), 3).alias("baseline"))


@query(f"with {PAIRS}, g as (select ref, rep, b2 - b1 as b, radians(30 + ref % 15) as look, radians(ref % 7) as alpha from pairs) select ref, rep, round(b * sin(look - alpha), 6) as b_par, round(b * cos(look - alpha), 6) as b_perp from g")
def baseline_angles(v):
    b, angle = F.col("b2") - F.col("b1"), F.radians(30 + F.col("ref") % 15) - F.radians(F.col("ref") % 7)
    return _pairs(v).select("ref", "rep", r6(b * F.sin(angle), "b_par"), r6(b * F.cos(angle), "b_perp"))


@query(f"with {SCENES}, m as (select *, first_value(bperp) over (order by id) as b0, first_value(day) over (order by id) as d0 from scenes) select lpad(cast(id as varchar), 7, '0') as name, day as days, day - d0 as gap, round(bperp - b0, 6) as bperp from m")
def baseline_table(v):
    first = v.scenes().agg(F.min_by(F.struct("day", "bperp"), "id").alias("f")).scalar()
    return v.scenes().withColumn("f", first).select(F.lpad(F.col("id").cast("string"), 7, "0").alias("name"), F.col("day").alias("days"), (F.col("day") - F.col("f.day")).alias("gap"), r6(F.col("bperp") - F.col("f.bperp"), "bperp"))


@query(f"with {POINTS} select id, round(30 / 111319.49, 9) as dlat, round(30 / (111319.49 * cos(radians(lat))), 9) as dlon, round_even(30 / 111319.49 * 3600 * 10, 0) / 10 as seconds from points")
def metres_to_degrees(v):
    return _points(v).select("id", F.round(F.lit(30 / 111319.49), 9).alias("dlat"), F.round(30 / (111319.49 * A.cosd(F.col("lat"))), 9).alias("dlon"), (F.rint(F.lit(30 / 111319.49 * 3600 * 10)) / 10).alias("seconds"))


# --- phases and corrections --------------------------------------------------------------------------------------


@query(f"""with {CELLS}, g as (select r, c, z, im, 800000 + c * 9.4 as rho, 120 + r * 0.1 as b, r * 3.0 as h from cells), p as (select *, -4 * pi() / 0.0555 * (b * h / (rho * sin(0.6))) as topo from g)
  select r, c, round(z * cos(topo) - im * sin(topo), 6) as re, round(z * sin(topo) + im * cos(topo), 6) as im, round((topo + pi()) - 2 * pi() * floor((topo + pi()) / (2 * pi())) - pi(), 6) as topo from p""")
def interferogram(v):
    rho, b, h = 800000 + F.col("c") * 9.4, 120 + F.col("r") * 0.1, F.col("r") * 3.0
    p = v.cells().withColumn("topo", -4 * math.pi / 0.0555 * (b * h / (rho * math.sin(0.6))))
    re, im = A.product(F.col("z"), F.col("im"), F.cos("topo"), F.sin("topo"))
    return p.select("r", "c", r6(re, "re"), r6(im, "im"), r6(A.wrap(F.col("topo")), "topo"))


@query(f"""with {CELLS} select r, c, round(z * 800000 * sin(0.6) * 0.0555 / (4 * pi() * (120 + r * 0.1)), 4) as height, 120 + r * 0.1 as bperp from cells""")
def phase_to_height(v):
    b = 120 + F.col("r") * 0.1
    return v.cells().select("r", "c", F.round(F.col("z") * 800000 * math.sin(0.6) * 0.0555 / (4 * math.pi * b), 4).alias("height"), b.alias("bperp"))


@query(f"""with {CELLS}, d as (select r, c, z, nullif(case when c % 9 = 0 then 0 else im end, 0) as ztd from cells) select r, c, round(z - coalesce(ztd * 4 * pi() / 0.0555 / cos(radians(35)), 0), 6) as phase from d""")
def delay_corrected(v):
    ztd = F.nullif(F.when(F.col("c") % 9 == 0, 0.0).otherwise(F.col("im")), F.lit(0.0))
    return v.cells().select("r", "c", r6(F.col("z") - F.coalesce(ztd * 4 * math.pi / 0.0555 / math.cos(math.radians(35)), F.lit(0.0)), "phase"))


@query(f"""with {CELLS}, p as (select c_custkey as id, c_custkey % 64 as r, c_custkey // 3 % 64 as c, c_acctbal / 100 as east, c_nationkey / 2.0 as north, case when c_custkey % 13 <> 0 then c_acctbal / 300 end as up from customer),
  l as (select id, p.r, p.c, east * 0.6 + north * -0.1 + up * 0.79 as los, z from p join cells using (r, c) where up is not null), m as (select avg(z - los) as shift from l) select id, round(los, 6) as los, round(z - shift, 6) as tied from l, m""")
def station_tie(v):
    k = F.col("c_custkey")
    p = v.table("customer").select(k.alias("id"), (k % 64).alias("r"), (F.floor(k / 3) % 64).alias("c"), (F.col("c_acctbal") / 100).alias("east"), (F.col("c_nationkey") / 2.0).alias("north"), F.when(k % 13 != 0, F.col("c_acctbal") / 300).alias("up"))
    los = F.col("east") * 0.6 + F.col("north") * -0.1 + F.col("up") * 0.79
    l = p.where("up is not null").join(v.cells(), ["r", "c"]).select("id", los.alias("los"), "z")
    return l.select("id", r6(F.col("los"), "los"), r6(F.col("z") - l.agg(F.avg(F.col("z") - F.col("los"))).scalar(), "tied"))


@query(f"""with {CELLS}, w as (select r, c, 2 * z - 2 * pi() * floor((2 * z + pi()) / (2 * pi())) as p from cells), d as (select r, c, p, p - lag(p) over (partition by r order by c) as d from w),
  s as (select r, c, coalesce(d - 2 * pi() * floor((d + pi()) / (2 * pi())), p) as step from d) select r, c, round(sum(step) over (partition by r order by c), 5) as phase from s""")
def integrated_rows(v):
    w = Window.partitionBy("r").orderBy("c")
    p = v.cells().select("r", "c", A.wrap(2 * F.col("z")).alias("p"))
    d = p.select("r", "c", F.coalesce(A.wrap(F.col("p") - F.lag("p").over(w)), F.col("p")).alias("step"))
    return d.select("r", "c", F.round(F.sum("step").over(w), 5).alias("phase"))


@query(f"""with {CELLS}, n as (select r, c, z, im, lead(z) over (partition by c order by r) as z2, lead(im) over (partition by c order by r) as im2 from cells)
  select c, round(atan2(sum(z * im2 - im * z2), sum(z * z2 + im * im2)) / (2 * pi()) * 1680, 4) as doppler, count(z2) as lines from n group by c""")
def doppler_centroid(v):
    w = Window.partitionBy("c").orderBy("r")
    n = v.cells().select("c", "z", "im", F.lead("z").over(w).alias("z2"), F.lead("im").over(w).alias("im2"))
    re, im = A.product(F.col("z"), -F.col("im"), F.col("z2"), F.col("im2"))
    return n.groupBy("c").agg(F.round(F.atan2(F.sum(im), F.sum(re)) / (2 * math.pi) * 1680, 4).alias("doppler"), F.count("z2").alias("lines"))


@query(f"""with {CELLS}, k as (select r, c, nullif(im, 0) as im, z from cells) select r, c, round(case when z > 3 then sqrt(z * z + im * im) else (z + im) / 2 end, 6) as value from k""")
def free_expression(v):
    return v.cells().select("r", "c", r6(compile_rpn("z 3 GT z im HYPOT z im ADD 2 DIV IFELSE", ["z", "im"]), "value"))


@query("""select i as row, j as col, i * 512 - case when i > 0 then 32 else 0 end as first_row, least((i + 1) * 512 + 32, 2000) as last_row, j * 512 - case when j > 0 then 32 else 0 end as first_col, least((j + 1) * 512 + 32, 1500) as last_col from range(0, 4) t(i), range(0, 3) u(j)""")
def unwrap_tiles(v):
    return tiles.tile_bounds(v.spark, 2000, 1500, 512, 32)


# --- parameters and files ----------------------------------------------------------------------------------------


@query("""with d(key, value) as (values ('error', 'none'), ('signup', '0'), ('absent', '-99999')), kv as (select user_id as scene, event_type as key, max_by(props, event_id) as value from events group by 1, 2),
  s as (select distinct user_id as scene from events) select s.scene, d.key, coalesce(kv.value, d.value) as value from s, d left join kv on kv.scene = s.scene and kv.key = d.key""")
def default_params(v):
    from ..sources.params import last_wins, with_defaults

    kv = last_wins(v.table("events").select(F.col("user_id").alias("scene"), F.col("event_id").alias("ord"), F.col("event_type").alias("key"), F.col("props").alias("value")))
    return with_defaults(kv, {"error": "none", "signup": "0", "absent": "-99999"})


@query("""with kv as (select user_id as scene, event_type as key, max_by(props, event_id) as value from events group by 1, 2) select scene, key, value from kv where key <> 'signup' union all select scene, 'signup', 'set' from (select distinct scene from kv)""")
def updated_params(v):
    from ..sources.params import last_wins, updated

    kv = last_wins(v.table("events").select(F.col("user_id").alias("scene"), F.col("event_id").alias("ord"), F.col("event_type").alias("key"), F.col("props").alias("value")))
    return updated(kv, "signup", "set")


@query("""with e as (select event_id, user_id, event_type, props from events), a as (select user_id as scene, event_type as key, props as value, event_id as ord from e union all select user_id, event_type, 'appended ' || event_id, 1000000000 + event_id from e where event_id % 50 = 0)
  select scene, key, max_by(value, ord) as value from a group by 1, 2""")
def appended_params(v):
    from ..sources.params import last_wins

    e = v.table("events")
    first = e.select(F.col("user_id").alias("scene"), F.col("event_type").alias("key"), F.col("props").alias("value"), F.col("event_id").alias("ord"))
    more = e.where("event_id % 50 = 0").select("user_id", "event_type", F.concat(F.lit("appended "), F.col("event_id").cast("string")), 1000000000 + F.col("event_id"))
    return last_wins(first.union(more)).select("scene", "key", "value")


@query("""with x as (select p_partkey as stem from part where p_partkey % 3 <> 0), t as (select p_partkey as stem from part where p_partkey % 4 <> 0), o as (select stem, 'no tiff' as what from x anti join t using (stem) union all select stem, 'no xml' from t anti join x using (stem))
  select stem, what from o where (select count(*) from x semi join t using (stem)) >= 2""")
def orphan_files(v):
    part = v.table("part").select(F.col("p_partkey").alias("stem"))
    x, t = part.where("stem % 3 <> 0"), part.where("stem % 4 <> 0")
    return joins.orphans(x, t, "stem", "no tiff", "no xml", 2)


@query("""with l as (select o_custkey as id, o_orderkey as pos from orders), last_ as (select id, max(pos) as position from l group by id) select c_custkey as id, position from customer join last_ on id = c_custkey""")
def last_position(v):
    last = v.table("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderkey").alias("position"))
    return v.table("customer").select(F.col("c_custkey").alias("id")).join(last, "id")


@query("""with a as (select c_custkey as pid, c_acctbal as x from customer), b as (select o_orderkey as pid, o_totalprice as y from orders) select pid, round(x, 2) as x, round(y, 2) as y from a join b using (pid)""")
def zipped_rows(v):
    a = v.table("customer").select(F.col("c_custkey").alias("pid"), F.round("c_acctbal", 2).alias("x"))
    return a.join(v.table("orders").select(F.col("o_orderkey").alias("pid"), F.round("o_totalprice", 2).alias("y")), "pid")


@query("""with m as (select o_custkey as scene, o_orderkey % 50 as line, o_orderkey % 97 as first_sample, o_totalprice as t from orders) select a.scene, a.line, greatest(max(a.first_sample), max(b.first_sample)) as first_sample, min(a.first_sample) as rshift
  from m a join m b on b.scene = a.scene + 1 and b.line = a.line group by 1, 2""")
def member_pairs(v):
    m = v.table("orders").select(F.col("o_custkey").alias("scene"), (F.col("o_orderkey") % 50).alias("line"), (F.col("o_orderkey") % 97).alias("first_sample"))
    b = m.select((F.col("scene") - 1).alias("scene"), "line", F.col("first_sample").alias("other"))
    return m.join(b, ["scene", "line"]).groupBy("scene", "line").agg(F.greatest(F.max("first_sample"), F.max("other")).alias("first_sample"), F.min("first_sample").alias("rshift"))


@query("""with b as (select user_id as swath, event_id as burst, epoch(ts) as t, epoch(min(ts) over (partition by user_id)) as t0, epoch(lag(ts) over (partition by user_id order by ts, event_id)) as before from events)
  select swath, max(burst) as burst from b where (t - t0) / 30 >= 5000 and (before - t0) / 30 <= 5000 group by swath""")
def burst_at_line(v):
    w = Window.partitionBy("swath")
    e = v.table("events").select(F.col("user_id").alias("swath"), F.col("event_id").alias("burst"), "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("m"))
    b = e.select("swath", "burst", ((F.col("m") - F.min("m").over(w)) / 1e6).alias("t"), ((F.lag("m").over(w.orderBy("ts", "burst")) - F.min("m").over(w)) / 1e6).alias("before"))
    return b.where((F.col("t") / 30 >= 5000) & (F.col("before") / 30 <= 5000)).groupBy("swath").agg(F.max("burst").alias("burst"))


@query("""select user_id % 7 as product, count(*) as bursts, count(distinct user_id) as frames, min(event_id) as first_burst, max(event_id) as last_burst, max(value) as prf from events group by 1""")
def reassembled_bursts(v):
    e = v.table("events").groupBy((F.col("user_id") % 7).alias("product"))
    return e.agg(F.count("*").alias("bursts"), F.countDistinct("user_id").alias("frames"), F.min("event_id").alias("first_burst"), F.max("event_id").alias("last_burst"), F.max("value").alias("prf"))


@query("""with s(stage, out) as (values (1, 'phase'), (2, 'filtered'), (3, 'unwrap'), (4, 'geo')), p as (select distinct o_custkey as pair from orders), d as (select distinct o_custkey as pair, cast(o_orderkey % 5 as int) as stage from orders)
  select p.pair, s.stage, s.out from p, s where not exists (select 1 from d where d.pair = p.pair and d.stage = s.stage)""")
def stages_left(v):
    done = v.table("orders").select(F.col("o_custkey").alias("pair"), (F.col("o_orderkey") % 5).cast("int").alias("stage")).distinct()
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("stage"), F.lit(x).alias("out")) for i, x in enumerate(("phase", "filtered", "unwrap", "geo"), 1)]))
    return v.table("orders").select(F.col("o_custkey").alias("pair")).distinct().select("pair", wanted.alias("s")).select("pair", "s.*").join(done, ["pair", "stage"], "left_anti")


# --- texts, dates, arrays, windows -------------------------------------------------------------------------------


@query("""select o_orderkey as id, 'S1_' || strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate, '%H%M%S') || '_F' || (o_orderkey % 3 + 1) as name, string_split('a/b/' || o_orderkey, '/')[-1] as last_part,
  trim(regexp_replace('  x   ' || o_orderkey || '   y ', ' +', ' ', 'g')) as squeezed, cast(o_orderkey || 'e-2' as double) as number, substr(o_orderpriority, 3, 2) as cut, len(string_split('1,2,' || o_orderkey, ',')) as listed from orders""")
def text_ops(v):
    k, d = F.col("o_orderkey").cast("string"), F.col("o_orderdate")
    name = F.concat(F.lit("S1_"), F.date_format(d, "yyyyMMdd"), F.lit("_"), F.date_format(d, "HHmmss"), F.lit("_F"), (F.col("o_orderkey") % 3 + 1).cast("string"))
    squeezed = F.trim(F.regexp_replace(F.concat(F.lit("  x   "), k, F.lit("   y ")), " +", " "))
    return v.table("orders").select(
        F.col("o_orderkey").alias("id"), name.alias("name"), F.element_at(F.split(F.concat(F.lit("a/b/"), k), "/"), -1).alias("last_part"), squeezed.alias("squeezed"),
        F.concat(k, F.lit("e-2")).cast("double").alias("number"), F.substring("o_orderpriority", 3, 2).alias("cut"), F.size(F.split(F.concat(F.lit("1,2,"), k), ",")).cast("long").alias("listed"),
    )


@query("""with d as (select o_orderkey as id, cast(o_orderdate as date) as d, o_orderdate as t from orders) select id, round(dayofyear(d) + (hour(t) * 3600 + minute(t) * 60 + second(t)) / 86400.0, 6) as doy, cast(cast(make_date(year(d), 1, 1) + cast(id % 365 as int) as date) as varchar) as from_zero_based,
  (year(d) - 1992) * 365 + dayofyear(d) as gap365, cast((year(d) % 4 = 0 and year(d) % 100 <> 0) or year(d) % 400 = 0 as int) as leap, case when d >= date '1999-01-01' then 32 when d >= date '1997-07-01' then 31 when d >= date '1996-01-01' then 30 when d >= date '1994-07-01' then 29 when d >= date '1993-07-01' then 28 when d >= date '1992-07-01' then 27 else 26 end as tai,
  round((280.46061837 + 360.98564736629 * (date_diff('day', date '2000-01-01', d) - 0.5)) - 360 * floor((280.46061837 + 360.98564736629 * (date_diff('day', date '2000-01-01', d) - 0.5)) / 360), 4) as sidereal from d""")
def date_ops(v):
    d = F.to_date("o_orderdate")
    year = F.year(d)
    tai = F.when(d >= F.lit("1999-01-01").cast("date"), 32)
    for day, n in (("1997-07-01", 31), ("1996-01-01", 30), ("1994-07-01", 29), ("1993-07-01", 28), ("1992-07-01", 27)):
        tai = tai.when(d >= F.lit(day).cast("date"), n)
    angle = 280.46061837 + 360.98564736629 * (F.datediff(d, F.lit("2000-01-01").cast("date")) - 0.5)
    return v.table("orders").select(
        F.col("o_orderkey").alias("id"), r6(F.dayofyear(d) + (F.hour("o_orderdate") * 3600 + F.minute("o_orderdate") * 60 + F.second("o_orderdate")) / 86400.0, "doy"),
        F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (F.col("o_orderkey") % 365).cast("int")).cast("string").alias("from_zero_based"), ((year - 1992) * 365 + F.dayofyear(d)).alias("gap365"),
        (((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)).cast("int").alias("leap"), tai.otherwise(26).alias("tai"), F.round(angle - 360 * F.floor(angle / 360), 4).alias("sidereal"),
    )


@query(f"""with {STACK}, a as (select pixel, list(round(z, 6) order by scene) as z from stack group by pixel) select pixel, array_to_string(list_reverse(z), ',') as reversed_, array_to_string(list_concat(list_slice(z, 3, len(z)), list_slice(z, 1, 2)), ',') as rotated, array_to_string(list_slice(z, 2, len(z)), ',') as shifted from a""")
def array_shifts(v):
    a = v.stack().groupBy("pixel").agg(F.transform(F.sort_array(F.collect_list(F.struct("scene", r6(F.col("z"), "z")))), lambda x: x["z"]).alias("z"))

    def shown(x):
        return F.array_join(F.transform(x, lambda e: e.cast("string")), ",")

    n = F.size("z")
    return a.select("pixel", shown(F.reverse("z")).alias("reversed_"), shown(F.concat(F.slice("z", F.lit(3), n), F.slice("z", F.lit(1), F.lit(2)))).alias("rotated"), shown(F.slice("z", F.lit(2), n)).alias("shifted"))


KAISER = " + ".join(f"pow(({{0}}) / 2, {2 * k}) / {math.factorial(k) ** 2}" for k in range(16))


@query(f"""with w as (select i, i / 63.0 as x from range(0, 64) t(i)) select i, round(0.54 - 0.46 * cos(2 * pi() * x), 9) as hamming, round(0.5 - 0.5 * cos(2 * pi() * x), 9) as cosine, round(1 - abs(2 * x - 1), 9) as triangle,
  round(({KAISER.format("4.5 * sqrt(greatest(0, 1 - pow(2 * x - 1, 2)))")}) / ({KAISER.format("4.5")}), 9) as kaiser from w""")
def taper_windows(v):
    from ..functions import windows as W

    x = F.col("id") / 63.0
    return v.spark.range(64).select(F.col("id").alias("i"), F.round(W.hamming(x), 9).alias("hamming"), F.round(W.cosine(x), 9).alias("cosine"), F.round(W.triangle(x), 9).alias("triangle"), F.round(W.kaiser(x, 4.5), 9).alias("kaiser"))


@query(f"""with {XYZ} select id, round(sqrt(px * px + py * py + pz * pz), 3) as norm, round(px / sqrt(px * px + py * py + pz * pz), 9) as ux, round(px * 0.6 + py * 0.8, 3) as dot, round(py * 0.8 - pz * 0.6, 3) as cross_x, cast(pow(2, ceil(log2(id + 1))) as bigint) as fft_size from xyz""")
def vector_ops(v):
    x, y, z = F.col("px"), F.col("py"), F.col("pz")
    norm = F.sqrt(x * x + y * y + z * z)
    return _points(v).select("id", F.round(norm, 3).alias("norm"), F.round(x / norm, 9).alias("ux"), F.round(x * 0.6 + y * 0.8, 3).alias("dot"), F.round(y * 0.8 - z * 0.6, 3).alias("cross_x"), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("id") + 1))).cast("long").alias("fft_size"))


@query("""with k as (select user_id as scene, map_from_entries(list((event_type, n) order by event_type)) as m from (select user_id, event_type, count(*) as n from events group by 1, 2) group by 1) select scene, coalesce(m['error'], 0) as errors, cardinality(m) as kinds from k""")
def param_map(v):
    k = v.table("events").groupBy(F.col("user_id").alias("scene"), "event_type").agg(F.count("*").alias("n")).groupBy("scene").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return k.select("scene", F.coalesce(F.try_element_at("m", F.lit("error")), F.lit(0)).alias("errors"), F.size("m").alias("kinds"))


@query("""with e as (select user_id, ts, case when ts - lag(ts) over w < interval 6 hours then 0 else 1 end as new from events window w as (partition by user_id order by ts)), s as (select user_id, ts, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from e)
  select user_id, min(ts) as first_ts, count(*) as n from s group by user_id, k""")
def session_counts(v):
    e = v.table("events").withColumn("at", F.col("ts").cast("timestamp"))
    return e.groupBy("user_id", F.session_window("at", "6 hours").alias("w")).agg(F.min("ts").alias("first_ts"), F.count("*").alias("n")).select("user_id", "first_ts", "n")
