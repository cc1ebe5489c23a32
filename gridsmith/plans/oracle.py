"""DuckDB text of the fixtures, shared by every ``oracle_sql()`` entry.

Each oracle is an independent re-statement of a query in plain SQL over the
pre-registered table views; the fixtures are CTEs prefixed with ``with_ctes``.
"""

from __future__ import annotations

from gridsmith.sources.fixtures import CROP_LABELS

F1 = """landsat as (
select date_trunc('quarter', l_shipdate) as instant,
       l_partkey % 32 as gx, l_orderkey % 32 as gy,
       max(3000 + (p % 3600)) as blue, max(3200 + ((p * 7) % 3400)) as green,
       max(3100 + ((p * 13) % 3500)) as red, max(3000 + ((p * 17 + q * 101) % 15000)) as nir,
       min(case when d >= 8 then 53248 else 20480 end) as qa
from (select *, cast(floor(l_extendedprice) as bigint) as p, cast(l_quantity as bigint) as q,
             cast(round(l_discount * 100) as bigint) as d from lineitem) t
group by 1, 2, 3)"""

F2 = """classes as (
select p_partkey % 32 as gx, cast(floor(p_partkey / 32) as bigint) % 32 as gy,
       max(case when p_partkey % 11 = 0 then 0 else p_size end) as value,
       min(case when p_partkey % 17 = 0 then 22 when p_partkey % 5 = 0 then 11 else 82 end) as nlcd
from part group by 1, 2)"""

F3 = """dem as (
select (vec_id % 16) * 8 + (i - 1) % 8 as gx, (vec_id // 16) * 8 + (i - 1) // 8 as gy,
       cast(floor(1000 * (1 + cast(e as double))) as bigint) as elev
from (select vec_id, generate_subscripts(embedding, 1) as i, unnest(embedding) as e from embeddings) t)"""

F4 = """scenes as (
select o_orderdate as time, concat('SC', lpad(cast(o_orderkey as varchar), 8, '0')) as scene_id,
       o_orderkey % 100 as cloud, -1350 + (o_custkey * 37) % 720 as lon10, 200 + (o_orderkey * 13) % 330 as lat10,
       1000 + o_orderkey % 2000 as n_cols, 900 + o_custkey % 1500 as n_rows,
       concat('s3://bucket-', cast(o_orderkey % 7 as varchar), '/scenes/', cast(o_orderkey as varchar), '_B1.TIF') as path,
       o_orderstatus <> 'P' as present
from orders)"""

F5 = """band_rows as (
select l_orderkey as scene, l_linenumber as band, cast(l_quantity as bigint) as v from lineitem)"""

F6 = """aoi_edges as (
select poly_id::integer as poly_id, x1::double as x1, y1::double as y1, x2::double as x2, y2::double as y2 from (values
 (1, 2.3, 1.7, 29.1, 9.4), (1, 29.1, 9.4, 11.2, 30.6), (1, 11.2, 30.6, 2.3, 1.7),
 (2, 4.0, 4.0, 28.0, 4.0), (2, 28.0, 4.0, 28.0, 12.0), (2, 28.0, 12.0, 12.0, 12.0),
 (2, 12.0, 12.0, 12.0, 28.0), (2, 12.0, 28.0, 4.0, 28.0), (2, 4.0, 28.0, 4.0, 4.0),
 (3, 6.0, 6.0, 26.0, 6.0), (3, 26.0, 6.0, 26.0, 26.0), (3, 26.0, 26.0, 6.0, 26.0), (3, 6.0, 26.0, 6.0, 6.0),
 (3, 12.0, 12.0, 20.0, 12.0), (3, 20.0, 12.0, 20.0, 20.0), (3, 20.0, 20.0, 12.0, 20.0), (3, 12.0, 20.0, 12.0, 12.0)
) t(poly_id, x1, y1, x2, y2))"""

F7 = "crop_labels as (\nselect code::integer as code, name, is_crop, rgba::bigint as rgba from (values\n " + ",\n ".join(
    "(%d, %s, %s, %s)" % (code, "null" if name is None else f"'{name}'", str(crop).lower(), "null" if rgba is None else rgba)
    for code, name, crop, rgba in CROP_LABELS) + "\n) t(code, name, is_crop, rgba))"

# Brute-force even-odd polygon test: every cell against every edge.
INSIDE = """inside as (
select c.gx, c.gy, e.poly_id
from (select distinct gx, gy from {cells}) c, aoi_edges e
where case when (e.y1 > c.gy + 0.5) <> (e.y2 > c.gy + 0.5)
           then c.gx + 0.5 < (e.x2 - e.x1) * ((c.gy + 0.5) - e.y1) / (e.y2 - e.y1) + e.x1 else false end
group by c.gx, c.gy, e.poly_id having count(*) % 2 = 1)"""

# Tiles whose closed box meets a polygon: an edge clipped to the box by its parameter leaves a piece (a point is enough), or the
# middle of the box is inside (without an edge in it, the box lies wholly inside or outside).
TOUCHED = """touched as (
select col, row, poly_id from (
  select t.col, t.row, t.col * 8.0::double as a, t.row * 8.0::double as b, e.*,
    case when x1 = x2 then case when x1 between a and a + 8 then 0.0::double else 2.0::double end else least((a - x1) / (x2 - x1), (a + 8 - x1) / (x2 - x1)) end as tx0,
    case when x1 = x2 then 1.0::double else greatest((a - x1) / (x2 - x1), (a + 8 - x1) / (x2 - x1)) end as tx1,
    case when y1 = y2 then case when y1 between b and b + 8 then 0.0::double else 2.0::double end else least((b - y1) / (y2 - y1), (b + 8 - y1) / (y2 - y1)) end as ty0,
    case when y1 = y2 then 1.0::double else greatest((b - y1) / (y2 - y1), (b + 8 - y1) / (y2 - y1)) end as ty1
  from (select distinct gx // 8 as col, gy // 8 as row from {cells}) t, aoi_edges e) c
group by col, row, poly_id
having sum(case when greatest(tx0, ty0, 0) <= least(tx1, ty1, 1) then 1 else 0 end) > 0
    or sum(case when (y1 > b + 4) <> (y2 > b + 4) and a + 4 < (x2 - x1) * (b + 4 - y1) / (y2 - y1) + x1 then 1 else 0 end) % 2 = 1)"""

FIXTURES = {"landsat": F1, "classes": F2, "dem": F3, "scenes": F4, "band_rows": F5,
            "aoi_edges": F6, "crop_labels": F7}


def with_ctes(body: str, *names: str, extra: list[str] | None = None) -> str:
    ctes = [FIXTURES[n] for n in names] + list(extra or [])
    return ("with " + ",\n".join(ctes) + "\n" + body) if ctes else body


def inside_cte(cells: str) -> str:
    return INSIDE.format(cells=cells)


def touched_cte(cells: str) -> str:
    return TOUCHED.format(cells=cells)
