"""DuckDB SQL of the image queries, written from the operators' definitions and not from their plans."""

from __future__ import annotations

from .queries import FILTERS, LASERS, PORTS

D = "CAST({} AS DOUBLE)".format
PX, OFF, GAIN = D(0.115), D(100.0), D(0.24)
R1 = f"r1 AS (SELECT 0 t, CAST(floor(vec_id/125) AS INT) p, 0 c, CAST(floor((vec_id%125)/25) AS INT) z, CAST(vec_id%25 AS INT) y, CAST(x AS INT) x, CAST(floor((CAST(e AS DOUBLE)+{D(1.0)})*{D(1000.0)}) AS INT)+100 v FROM (SELECT vec_id, unnest(embedding) e, generate_subscripts(embedding,1)-1 x FROM embeddings))"
R2 = f"r2 AS (SELECT 0 t, CAST(l_suppkey%4 AS INT) p, 0 c, l_linenumber-1 z, CAST(floor(l_quantity) AS INT)-1 y, CAST(l_partkey%64 AS INT) x, CAST(least(65535, sum(CAST(floor(l_extendedprice/{D(100.0)}) AS BIGINT))) AS INT) v FROM lineitem GROUP BY 1,2,3,4,5,6)"
R3 = f"r3 AS (SELECT CAST(date_diff('day', date '2024-01-01', CAST(ts AS date)) AS INT) t, CAST(user_id%4 AS INT) p, 0 c, 0 z, CAST(CAST(floor(user_id/4) AS BIGINT)%16 AS INT) y, CAST(least(31, floor(value/{D(16.0)})) AS INT) x, CAST(100+50*count(*) AS INT) v FROM events GROUP BY 1,2,3,4,5,6)"
R4 = f"r4 AS (SELECT DISTINCT 0 t, CAST(floor(vec_id/125) AS INT) p, {D(0.0)} stage_z, floor(floor(vec_id/125)/2)*20*{PX} stage_y, (CAST(floor(vec_id/125) AS INT)%2)*50*{PX} stage_x FROM embeddings)"
FF = f"ff AS (SELECT 0 c, CAST(y AS INT) y, CAST(x AS INT) x, {D(1.0)}+((y*7+x*3)%5)*{D(0.125)} ff FROM range(25) a(y), range(64) b(x))"
COR = f"cor AS (SELECT t,p,r1.c,z,r1.y,r1.x, CAST(floor(greatest({D(0)}, least({D(65535)}, (v-{OFF})*{GAIN}/ff))) AS INT) v FROM r1 JOIN ff USING (c,y,x))"
ALL = "t,p,c,z,y,x"


#: Tiles' offsets and the edges between tiles that overlap: exact (w_) and rounded, every seventh 30 planes off.
OFFSETS = f"o AS (SELECT 0 t, p, (s%7)/{D(2)} dz, CAST(s%11-m AS DOUBLE) dy, (p%5)*{D(1.5)} dx FROM (SELECT CAST(floor(vec_id/125) AS INT) p, CAST(sum(label) AS BIGINT) s, max(label) m FROM embeddings GROUP BY 1))"
EDGES = f"e AS (SELECT t, i, j, CAST(round_even(w_z,0) AS INT)+CASE WHEN (i*3+j)%7=5 THEN 30 ELSE 0 END dz, CAST(round_even(w_y,0) AS INT) dy, CAST(round_even(w_x,0) AS INT) dx, CASE WHEN (i+j)%5=0 THEN {D(0.6)} ELSE {D(0.7)}+(i%4)*{D(0.0625)} END score FROM (SELECT prs.t, i, j, b.dz-a.dz w_z, b.dy-a.dy w_y, b.dx-a.dx w_x FROM prs JOIN o a ON a.t=prs.t AND a.p=i JOIN o b ON b.t=prs.t AND b.p=j))"


def _names(kinds: tuple[str, ...]) -> str:
    """(event_id, name): the name of one of ``kinds`` for each event."""
    cases = " ".join(f"WHEN {k} THEN replace('{text}', '{{v}}', CAST(CAST(floor(value)+300 AS INT) AS VARCHAR))" for k, text in enumerate(kinds))
    return f"(SELECT event_id, CASE event_id%{len(kinds)} {cases} END name FROM events)"


WHOLE, SIZES = "(SELECT DISTINCT CAST(floor(value) AS INT) n FROM events)", "(SELECT DISTINCT p_size n FROM part)"


#: Sine, cosine and tangent of 30 degrees, and the scan step in pixels.
SIN, COS, TAN, STEP = D("0.49999999999999994"), D("0.8660254037844387"), D("0.5773502691896257"), "(CAST(0.4 AS DOUBLE)/CAST(0.115 AS DOUBLE))"


def _deskew(source: str, n: int = 5, h: int = 25, depth: int = 12, ny: int = 40) -> str:
    """ctes dsk(t,p,c,z,y,x,v) from a stack of n planes of h rows: 2 ceil(h sin / 2) z's and ceil(n step + h cos) rows."""
    s, sin, cos, tan = STEP, SIN, COS, TAN
    return f"""g0 AS (SELECT CAST(z AS INT) z, CAST(y AS INT) y, y - z/{tan} vp FROM range({depth}) a(z), range({ny}) b(y)),
g1 AS (SELECT z, y, vp, CAST(floor(vp/{s}) AS INT) pb FROM g0),
g2 AS (SELECT z, y, pb, z/{sin} + (vp - pb*{s})*{cos} vb, z/{sin} - ({s} - (vp - pb*{s}))*{cos} va FROM g1 WHERE pb >= 0 AND pb + 1 < {n}),
g3 AS (SELECT *, CAST(floor(vb) AS INT) jb, CAST(floor(va) AS INT) ja FROM g2),
g4 AS (SELECT * FROM g3 WHERE jb >= 0 AND ja >= 0 AND jb + 1 < {h} AND ja + 1 < {h}),
tap AS (SELECT z, y, 0 k, pb+1 sz, ja+1 sy, va-ja w FROM g4 UNION ALL SELECT z, y, 1, pb+1, ja, 1-va+ja FROM g4 UNION ALL SELECT z, y, 2, pb, jb+1, vb-jb FROM g4 UNION ALL SELECT z, y, 3, pb, jb, 1-vb+jb FROM g4),
hit AS MATERIALIZED (SELECT i.t, i.p, i.c, tap.z, tap.y, i.x, k, i.v*w v FROM tap JOIN {source} i ON i.z=tap.sz AND i.y=tap.sy),
val AS (SELECT t,p,c,z,y,x, least({D(65534)}, greatest({D(0)}, (((coalesce(max(v) FILTER (k=0),0) + coalesce(max(v) FILTER (k=1),0)) + coalesce(max(v) FILTER (k=2),0)) + coalesce(max(v) FILTER (k=3),0))/{s})) v FROM hit GROUP BY t,p,c,z,y,x),
dsk AS (SELECT t,p,c, CAST(floor(z/2) AS INT) z, y, x, CAST(floor(least({D(65534)}, sum(v))/{D(2)}) AS INT) v FROM val GROUP BY t,p,c,CAST(floor(z/2) AS INT),y,x)"""


def _cosine(i: str, length: int) -> str:
    """Half a cosine up over the first min(380, length // 2) places, mirrored at the end, 1 between."""
    n = min(380, length // 2)
    return f"(CASE WHEN {i} < {n} THEN 0.5*(1-cos(pi()*{i}/{n - 1})) WHEN {length - 1}-{i} < {n} THEN 0.5*(1-cos(pi()*({length - 1}-{i})/{n - 1})) ELSE {D(1)} END)"


def _feather(i: str, length: int, blend: int) -> str:
    """Linear ramps over ``blend`` places at both ends, the one at the end written last."""
    return f"(CASE WHEN {length - 1}-{i} < {blend} THEN ({length - 1}-{i})/{D(blend)} WHEN {i} < {blend} THEN {i}/{D(blend)} ELSE {D(1)} END)"


def _fuse() -> str:
    h, w = 40, 64
    return f"""WITH {R1}, {R4}, {FF}, {COR}, {_deskew("cor")},
mz AS (SELECT t,p,c,y,x,max(v) v FROM dsk GROUP BY ALL),
lo AS (SELECT min(stage_y) ly, min(stage_x) lx FROM r4),
grid AS (SELECT k.t,k.p,k.c,CAST(y AS INT) y,CAST(x AS INT) x FROM (SELECT DISTINCT t,p,c FROM mz) k, range({h}) a(y), range({w}) b(x)),
pl AS (SELECT g.t,g.c,g.p, g.y + CAST(floor((r4.stage_y-ly)/{PX}) AS INT) y, g.x + CAST(floor((r4.stage_x-lx)/{PX}) AS INT) x, coalesce(mz.v,0) v, {_cosine("g.y", h)}*{_cosine("g.x", w)} w
 FROM grid g LEFT JOIN mz ON mz.t=g.t AND mz.p=g.p AND mz.c=g.c AND mz.y=g.y AND mz.x=g.x JOIN r4 ON r4.t=g.t AND r4.p=g.p, lo)
SELECT t,c,y,x, CAST(list_reduce(list_prepend({{'v': {D(0)}, 'w': {D(0)}}}, list({{'v': CAST(v AS DOUBLE), 'w': w}} ORDER BY p)),
 lambda a, s: {{'v': floor(greatest({D(0)}, least({D(65535)}, (a.v + s.v*s.w)/(1+s.w)))), 'w': {D(0)}}}).v AS INT) v FROM pl GROUP BY t,c,y,x"""


def _down(source: str, axis: str, level: int, size: int) -> str:
    keys = ", ".join(a if a != axis else f"CAST(floor({a}/{level}) AS INT) {a}" for a in "tpczyx")
    return f"(SELECT {keys}, CAST(floor(sum(v)/{level}) AS INT) v FROM {source} WHERE {axis} < {size // level * level} GROUP BY ALL)"


def _block(source: str, z: int, y: int, x: int, trunc: bool) -> str:
    mean = f"sum(v)/{D(z * y * x)}"
    return f"(SELECT t,p,c,CAST(floor(z/{z}) AS INT) z,CAST(floor(y/{y}) AS INT) y,CAST(floor(x/{x}) AS INT) x, {f'CAST(floor({mean}) AS INT)' if trunc else mean} v FROM {source} GROUP BY ALL)"


def _box(source: str, axis: str, size: int, r: int = 1) -> str:
    near = ", ".join(f"s.{a}" for a in "tpczyx" if a != axis)
    return f"(SELECT {', '.join('b.k' + ' ' + a if a == axis else 's.' + a for a in 'tpczyx')}, sum(CAST(s.v AS DOUBLE))/{2 * r + 1} v FROM (SELECT CAST(k AS INT) k, least({size - 1}, greatest(0, CAST(k AS INT) + CAST(d AS INT) - {r})) src FROM range({size}) a(k), range({2 * r + 1}) o(d)) b JOIN {source} s ON s.{axis}=b.src GROUP BY b.k, {near})"


def _boxed(column: str) -> str:
    """Radius-1 box mean over z, y, x of a column of pair(p, z, y, x, a, b)."""
    out = f"(SELECT 0 t, p, 0 c, z, y, x, CAST({column} AS DOUBLE) v FROM pair)"
    for axis, size in (("z", 5), ("y", 25), ("x", 64)):
        out = _box(out, axis, size)
    return out


def _profile(**expressions: str) -> str:
    """A weight for each place of the stack's axes, by an expression of i."""
    parts = [f"SELECT '{a}' axis, i, round({e}, 9) w FROM (SELECT DISTINCT {a} i FROM r1)" for a, e in expressions.items()]
    return f"WITH {R1} " + " UNION ALL ".join(parts)


PAIR = "nxt AS (SELECT t, p, coalesce(lead(p) OVER (PARTITION BY t ORDER BY p), first_value(p) OVER (PARTITION BY t ORDER BY p)) q FROM r4), pair AS (SELECT a.p, a.z, a.y, a.x, a.v a, b.v b FROM r1 a JOIN nxt ON nxt.t=a.t AND nxt.p=a.p JOIN r1 b ON b.p=nxt.q AND a.z=b.z AND a.y=b.y AND a.x=b.x)"
_OV = " AND ".join(f"abs(round_even((b.stage_{a}-a.stage_{a})/{PX},0)) < {n}" for a, n in (("z", 5), ("y", 25), ("x", 64)))
_BOUNDS = ", ".join(f"greatest(0,o{a}) i_{a}0, least({n},o{a}+{n}) i_{a}1, greatest(0,-o{a}) j_{a}0, least({n},{n}-o{a}) j_{a}1" for a, n in (("z", 5), ("y", 25), ("x", 64)))
PAIRS = f"prs AS (SELECT t,i,j,{_BOUNDS} FROM (SELECT a.t, a.p i, b.p j, " + ", ".join(f"CAST(round_even((b.stage_{a}-a.stage_{a})/{PX},0) AS INT) o{a}" for a in "zyx") + f" FROM r4 a JOIN r4 b ON a.t=b.t AND a.p<b.p WHERE {_OV}))"
RES = f"{R4}, {PAIRS}, {OFFSETS}, {EDGES}, res AS (SELECT e.t, e.i, e.j, sqrt((pow(b.dz-a.dz-e.dz,2)+pow(b.dy-a.dy-e.dy,2))+pow(b.dx-a.dx-e.dx,2)) residual FROM e JOIN o a ON a.t=e.t AND a.p=e.i JOIN o b ON b.t=e.t AND b.p=e.j)"
def _ball(r: int) -> str:
    """bg(t,p,c,z,y,x,v): the least neighbour under a ball of radius r."""
    places = f"(SELECT dy, dx, {r}-sqrt(CAST({r * r}-dy*dy-dx*dx AS DOUBLE)) h FROM range({-r},{r + 1}) a(dy), range({-r},{r + 1}) b(dx) WHERE dy*dy+dx*dx <= {r * r})"
    return f"bg AS (SELECT t,p,c,z,CAST(y-dy AS INT) y,CAST(x-dx AS INT) x,min(v+h) v FROM r1, {places} k WHERE y-dy BETWEEN 0 AND 24 AND x-dx BETWEEN 0 AND 63 GROUP BY 1,2,3,4,5,6)"


def _shift() -> str:
    taps = [(-1, 3, 0.75 * 0.5), (-1, 2, 0.75 * 0.5), (-2, 3, 0.25 * 0.5), (-2, 2, 0.25 * 0.5)]
    one = [f"coalesce(s{k}.v*{D(w)},0)" for k, (_, _, w) in enumerate(taps)]
    terms = f"(({one[0]} + {one[1]}) + {one[2]}) + {one[3]}"
    joins = " ".join(f"LEFT JOIN q s{k} ON s{k}.p=g.p AND s{k}.z=g.z AND s{k}.y=g.y+({dy}) AND s{k}.x=g.x+({dx})" for k, (dy, dx, _) in enumerate(taps))
    any_ = " OR ".join(f"s{k}.v IS NOT NULL" for k in range(4))
    return f"WITH {R1}, q AS (SELECT * FROM r1) SELECT g.t,g.p,g.c,g.z,g.y,g.x, {terms} v FROM q g {joins} WHERE {any_}"


def _hot() -> str:
    return f"""WITH {R1}, nz AS (SELECT CAST(y AS INT) y, CAST(x AS INT) x FROM range(25) a(y), range(64) b(x) WHERE (y*31+x*17)%20*20 > 375),
nb AS (SELECT n.y, n.x, least(24, greatest(0, n.y+dy-1)) sy, least(63, greatest(0, n.x+dx-1)) sx FROM nz n, range(3) a(dy), range(3) b(dx)),
med AS (SELECT r1.t,r1.p,r1.c,r1.z,nb.y,nb.x,median(v) m FROM nb JOIN r1 ON r1.y=nb.sy AND r1.x=nb.sx GROUP BY ALL)
SELECT r1.t,r1.p,r1.c,r1.z,r1.y,r1.x, CAST(greatest(0, coalesce(m, v)) AS INT) v FROM r1 LEFT JOIN med USING (t,p,c,z,y,x)"""


def _pyramid_mean() -> str:
    one = _block("r1", 2, 2, 2, True)
    return f"WITH {R1}, l1 AS {one}, l2 AS {_block('l1', 2, 2, 2, True)}, l3 AS {_block('l2', 2, 2, 2, True)} " + " UNION ALL ".join(f"SELECT {ALL},v,{n} AS level FROM l{n}" for n in (1, 2, 3))


SQL: dict[str, str] = {
    "camera_correct": f"WITH {R1}, {FF}, {COR} SELECT * FROM cor",
    "camera_correct_qe": f"WITH {R1} SELECT {ALL}, CAST(floor(greatest(v-{OFF},{D(0)})*{GAIN}/{D(0.9)}) AS INT) v FROM r1",
    "photon_convert": f"WITH {R1} SELECT {ALL}, CAST(floor(greatest({D(0)},least({D(65535)},(v-{OFF})*{GAIN}))) AS INT) v FROM r1",
    "scan_flip": f"WITH {R1} SELECT t,p,c,4-z z,y,x,v FROM r1",
    "stage_flip": f"WITH {R4} SELECT t,p,max(stage_z) OVER ()-stage_z stage_z, max(stage_y) OVER ()-stage_y stage_y, stage_x FROM r4",
    "scan_crop": f"WITH {R1} SELECT t,p,c,z-1 z,y,x,v FROM r1 WHERE z BETWEEN 1 AND 3",
    "y_crop": f"WITH {R1} SELECT t,p,c,z,y-3 y,x,v FROM r1 WHERE y BETWEEN 3 AND 21",
    "fov_crop": f"WITH {R1} SELECT * FROM r1 WHERE x BETWEEN 8 AND 39 AND p < 3",
    "pad_shape": f"SELECT n, CAST((4-n%4)%4 AS INT) pad FROM {WHOLE}",
    "axis_normalise": f"WITH {R1} SELECT p t,0 p,CAST(floor(x/32) AS INT) c,z,y,x%32 x,v FROM r1",
    "time_slice": f"WITH {R3} SELECT * FROM r3 WHERE t >= 5 AND t < 12",
    "pos_slice": f"WITH {R1} SELECT * FROM r1 WHERE p >= 1 AND p < 3",
    "region_read": f"WITH {R1} SELECT * FROM r1 WHERE z IN (1,2) AND y BETWEEN 3 AND 8 AND x BETWEEN 10 AND 19",
    "port_gain_lookup": f"SELECT event_id, name, CASE WHEN contains(name,'Dynamic Range') THEN {D(0.23)} WHEN contains(name,'Speed') THEN {D(0.85)} WHEN contains(name,'Sensitivity') THEN {D(0.25)} WHEN contains(name,'Sub-Electron') THEN {D(0.015)} END gain FROM {_names(PORTS)}",
    "emission_parse": rf"SELECT event_id, name, CAST(regexp_extract(name, '(\d+(?:\.\d+)?)\s*em', 1) AS DOUBLE)/1000 em FROM {_names(FILTERS)} WHERE regexp_extract(name, '(\d+(?:\.\d+)?)\s*em', 1) <> ''",
    "json_key_lookup": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) k FROM events",
    "max_z": f"WITH {R1} SELECT t,p,c,y,x,max(v) v FROM r1 GROUP BY ALL",
    "correct_max_z": f"WITH {R2} SELECT t,p,c,y,x,CAST(floor(greatest({D(0)},least({D(65535)},(max(v)-{OFF})*{GAIN}))) AS INT) v FROM r2 GROUP BY t,p,c,y,x",
    "mean_t": f"WITH {R3} SELECT p,c,z,y,x,CAST(floor(sum(CAST(floor(greatest({D(0)},least({D(65535)},(v-{OFF})*{GAIN}))) AS INT))/30) AS INT) v FROM r3 GROUP BY p,c,z,y,x",
    "downsample_axis_z": f"WITH {R1} SELECT * FROM {_down('r1', 'z', 2, 5)}",
    "downsample_yx": f"WITH {R1} SELECT * FROM {_down(_down('r1', 'y', 2, 25), 'x', 2, 64)}",
    "downsample_iso": f"WITH {R1} SELECT * FROM {_down(_down(_down('r1', 'z', 2, 5), 'y', 2, 25), 'x', 2, 64)}",
    "block_reduce": f"WITH {R1} SELECT * FROM {_block('r1', 3, 5, 5, False)}",
    "pyramid_stride": f"WITH {R1} SELECT t,p,c,CAST(floor(z/f) AS INT) z,CAST(floor(y/f) AS INT) y,CAST(floor(x/f) AS INT) x,v,level FROM r1, (VALUES (1,2),(2,4),(3,8)) l(level,f) WHERE z%f=0 AND y%f=0 AND x%f=0",
    "pyramid_block_mean": _pyramid_mean(),
    "pyramid_transforms": f"WITH {R4} SELECT p, level, round({PX}*(1+p%3)*f,9) scale_y, round({PX}*(1+p%3)*f,9) scale_x, round(stage_y+(f-1)*{PX}*(1+p%3)/2,9) shift_y, round(stage_x+(f-1)*{PX}*(1+p%3)/2,9) shift_x FROM r4, (VALUES (0,1),(1,2),(2,4),(3,8)) l(level,f)",
    "stage_positions": "SELECT user_id, arg_min(value, event_id) AS value, arg_min(event_type, event_id) event_type FROM events GROUP BY user_id",
    "channels_ordered": "SELECT event_type, CAST(row_number() OVER (ORDER BY m)-1 AS INT) place FROM (SELECT event_type, min(event_id) m FROM events WHERE event_type <> '' GROUP BY 1)",
    "tile_grid_overlap": f"WITH {R4}, s AS (SELECT 'z' axis, 5 n, round(stage_z,5) pos, min(p) p FROM r4 GROUP BY ALL UNION ALL SELECT 'y', 25, round(stage_y,5), min(p) FROM r4 GROUP BY ALL UNION ALL SELECT 'x', 64, round(stage_x,5), min(p) FROM r4 GROUP BY ALL), k AS (SELECT axis, n, count(*) steps, list(pos ORDER BY p) l FROM s GROUP BY 1,2) SELECT axis, steps, CASE WHEN steps > 1 THEN round(sign(l[2]-l[1])*(n*{PX}-abs(l[2]-l[1])),2) ELSE 0 END overlap FROM k",
    "deskew_shape": f"WITH {R4} SELECT n, h, CAST(nz AS INT) nz, CAST(ny+(4-ny%4)%4 AS INT) ny, 64 nx, CAST((4-ny%4)%4 AS INT) pad, CAST(crop AS INT) crop FROM (SELECT n, h, ceil(h*{SIN}) nz, CAST(ceil(n*{STEP}+h*{COS}) AS INT) ny, ceil(h*{COS}) crop FROM {SIZES}, (SELECT p*8+25 h FROM r4))",
    "deskew": f"WITH {R1}, {_deskew('r1')} SELECT * FROM dsk",
    "deskew_max_z": f"WITH {R1}, {_deskew('r1')} SELECT t,p,c,y,x,max(v) v FROM dsk GROUP BY ALL",
    "fused_extent_2d": f"WITH {R4}, e AS (SELECT min(stage_y) origin_y, min(stage_x) origin_x, CAST(floor((max(stage_y)+{D(repr(25 * 0.115))}-min(stage_y))/{PX}) AS INT) sy, CAST(floor((max(stage_x)+{D(repr(64 * 0.115))}-min(stage_x))/{PX}) AS INT) sx FROM r4) SELECT origin_y, origin_x, sy+(8-sy%8)%8 size_y, sx+(8-sx%8)%8 size_x FROM e",
    "blend_mask_2d": _profile(y=_cosine("i", 25), x=_cosine("i", 64)),
    "fuse_2d": _fuse(),
    "feather_profile": _profile(z=_feather("i", 5, 2), y=_feather("i", 25, 4), x=_feather("i", 64, 8)),
    "fused_extent_3d": f"WITH {R4}, e AS (SELECT min(stage_z) origin_z, min(stage_y) origin_y, min(stage_x) origin_x, " + ", ".join(f"CAST(ceil((max(stage_{a})+{D(repr(n * 0.115))}-min(stage_{a}))/{PX}) AS INT) s{a}" for a, n in (("z", 5), ("y", 25), ("x", 64))) + " FROM r4) SELECT origin_z, origin_y, origin_x, sz+(5-sz%5)%5 size_z, sy+(25-sy%25)%25 size_y, sx+(64-sx%64)%64 size_x FROM e",
    "shard_overlap": f"WITH {R4}, o AS (SELECT t,p,CAST(round_even((p*3*{PX}-(SELECT min(p)*3*{PX} FROM r4))/{PX},0) AS INT) oz FROM r4) SELECT t,p,CAST(s AS INT) shard, greatest(CAST(s AS INT)*4,oz) z0, least((CAST(s AS INT)+1)*4,oz+5) z1 FROM o, range(1000) r(s) WHERE greatest(s*4,oz) < least((s+1)*4,oz+5)",
    "fuse_3d": f"WITH {R1}, {R4}, lo AS (SELECT min(stage_z) lz, min(stage_y) ly, min(stage_x) lx FROM r4), pl AS (SELECT r1.t, c, z+CAST(round_even((stage_z-lz)/{PX},0) AS INT) z, y+CAST(round_even((stage_y-ly)/{PX},0) AS INT) y, x+CAST(round_even((stage_x-lx)/{PX},0) AS INT) x, v, ({_feather("z", 5, 2)}*{_feather("y", 25, 4)})*{_feather("x", 64, 8)} w FROM r1 JOIN r4 USING (t,p), lo) SELECT t,c,z,y,x, CASE WHEN sum(w)>0 THEN CAST(floor(sum(w*v)/sum(w)+{D("1e-9")}) AS INT) ELSE 0 END v FROM pl GROUP BY t,c,z,y,x",
    "overlap_pairs": f"WITH {R4}, {PAIRS} SELECT * FROM prs",
    "overlap_patches": f"WITH {R1}, {R4}, {PAIRS} SELECT prs.t,i,j,a.z-i_z0 z,a.y-i_y0 y,a.x-i_x0 x,a.v a,b.v b FROM prs JOIN r1 a ON a.t=prs.t AND a.p=i AND a.z>=i_z0 AND a.z<i_z1 AND a.y>=i_y0 AND a.y<i_y1 AND a.x>=i_x0 AND a.x<i_x1 JOIN r1 b ON b.t=prs.t AND b.p=j AND b.z-j_z0=a.z-i_z0 AND b.y-j_y0=a.y-i_y0 AND b.x-j_x0=a.x-i_x0",
    "edge_gates": f"WITH {R4}, {PAIRS}, {OFFSETS}, {EDGES} SELECT * FROM e WHERE score >= 0.7 AND abs(dz)<=20 AND abs(dy)<=50 AND abs(dx)<=100",
    "edge_residuals": f"WITH {RES} SELECT t,i,j,round(residual,9) residual FROM res",
    "outlier_gate": f"WITH {RES} SELECT t,i,j,round(residual,9) residual FROM res WHERE residual > (SELECT greatest(1.5, 0.5*median(residual)) FROM res)",
    "solve_offsets": f"WITH {OFFSETS} SELECT t, p, round(dz-f.z,6) dz, round(dy-f.y,6) dy, round(dx-f.x,6) dx FROM o, (SELECT dz z, dy y, dx x FROM o WHERE p=0) f",
    "apply_offsets": f"WITH {R4}, {OFFSETS} SELECT r4.t,r4.p,round(stage_z+coalesce(dz,0)*{D(0.4)},9) stage_z, round(stage_y+coalesce(dy,0)*{PX},9) stage_y, round(stage_x+coalesce(dx,0)*{PX},9) stage_x FROM r4 LEFT JOIN o USING (t, p)",
    "hot_pixels": _hot(),
    "rolling_ball_r2": f"WITH {R1}, {_ball(2)} SELECT {ALL}, round(v,6) v FROM bg",
    "rolling_ball_r25": f"WITH {R1}, {_ball(25)} SELECT {ALL}, round(v,6) v FROM bg",
    "subtract_background": f"WITH {R1}, {_ball(2)} SELECT r1.t,r1.p,r1.c,r1.z,r1.y,r1.x, CAST(greatest(0,least(65535,r1.v-floor(bg.v))) AS INT) v FROM r1 JOIN bg USING (t,p,c,z,y,x)",
    "box_filter": f"WITH {R1} SELECT {ALL}, round(v,6) v FROM {_box(_box(_box('r1', 'z', 5), 'y', 25), 'x', 64)}",
    "ssim": f"WITH {R1}, {R4}, {PAIR}, rg AS (SELECT p, max(a)-min(a) r FROM pair GROUP BY p), m AS (SELECT a.p, a.v ma, b.v mb, aa.v maa, bb.v mbb, ab.v mab, r FROM {_boxed('a')} a JOIN {_boxed('b')} b USING (p,z,y,x) JOIN {_boxed('a*a')} aa USING (p,z,y,x) JOIN {_boxed('b*b')} bb USING (p,z,y,x) JOIN {_boxed('a*b')} ab USING (p,z,y,x) JOIN rg ON rg.p=a.p), u AS (SELECT p, ma, mb, 27/{D(26)}*(maa-ma*ma) va, 27/{D(26)}*(mbb-mb*mb) vb, 27/{D(26)}*(mab-ma*mb) vab, pow(0.01*r,2) c1, pow(0.03*r,2) c2 FROM m) SELECT 0 t, p, 0 c, round(avg(((2*ma*mb+c1)*(2*vab+c2))/((ma*ma+mb*mb+c1)*(va+vb+c2))),6) ssim FROM u GROUP BY p",
    "shift_linear": _shift(),
    "kl_divergence": f"WITH {R1}, {R4}, {PAIR}, n AS (SELECT pair.p tile, a+{D(1e-4)} p, b+{D(1e-4)} q FROM pair), s AS (SELECT tile, sum(p) sp, sum(q) sq FROM n GROUP BY tile) SELECT 0 t, tile p, 0 c, round(sum(p/sp*(ln(p/sp)-ln(q/sq))),9) kl FROM n JOIN s USING (tile) GROUP BY tile",
    "consensus_update": f"WITH {R1} SELECT p,z,y,x, CASE WHEN (x+y+z)%3-1 < 0 THEN CAST(v AS DOUBLE) ELSE greatest({D(0)}, v*(((x*7+y)%5)*{D(0.5)})) END recon FROM r1",
    "reflect_index": f"SELECT i, CAST(CASE WHEN m < 9 THEN m ELSE 16-m END AS INT) AS \"at\" FROM (SELECT n-20 i, (((n-20)%16)+16)%16 m FROM {WHOLE})",
    "fft_size": f"SELECT n, CAST(min(s) AS INT) size FROM {WHOLE}, (SELECT CAST(pow(2,a)*pow(3,b) AS INT) s FROM range(10) x(a), range(7) y(b)) WHERE n > 0 AND s >= n GROUP BY n",
    "chunk_cover": f"SELECT n, k, CAST(greatest(0,least(s,n-k)) AS INT) start, CAST(least(n, greatest(0,least(s,n-k))+k) AS INT) stop FROM (SELECT n, k, unnest(range(0, n, k)) s FROM {WHOLE}, (VALUES (3),(5)) c(k) WHERE n > 0)",
    "slab_feather": _profile(x=f"CASE WHEN i < 8 THEN 0.5*(1-cos(pi()*i/{D(15)})) WHEN i >= 56 THEN 0.5*(1-cos(pi()*(i-48)/{D(15)})) ELSE {D(1)} END", y=f"CASE WHEN i < 12 THEN 0.5*(1-cos(pi()*i/{D(23)})) WHEN i >= 13 THEN 0.5*(1-cos(pi()*(i-1)/{D(23)})) ELSE {D(1)} END"),
    "index_to_physical": f"SELECT n i, n*{D(0.23)}+{D(5.75)} um FROM {WHOLE}",
    "layer_placement": f"WITH {R4} SELECT t,p,{D(0.23)} scale_z,{PX} scale_y,{PX} scale_x,stage_z,stage_y,stage_x FROM r4",
    "export_names": f"WITH {R4} SELECT p, printf('Scan_Iter_%04d_0000_CamA_ch0_CAM1_stack000_488nm_0000000000msec_%03dx_%03dy_000z_0000t.zarr', p, p%2, p//2) AS name FROM r4",
    "skewed_coords": f"WITH {R1} SELECT t,p,c,z,y,x,round(z*{D(0.4)}+y*{PX}*{COS},9) AS \"lateral\", round(y*{PX}*{SIN},9) axial FROM r1",
    "lab2cam": f"WITH {R1} SELECT t,p,c,z,y,x,CAST(x AS DOUBLE) xp, round(z/{SIN},9) yp, round(y-z/{TAN},9) stage FROM r1",
    "read_tile": f"WITH {R1} SELECT * FROM r1 WHERE p = 2 AND z IN (1,2) AND y BETWEEN 3 AND 8 AND x BETWEEN 10 AND 19",
    "skip_missing": f"WITH {R4} SELECT t,p,CAST(c AS INT) c,stage_z,stage_y,stage_x FROM r4, range(2) k(c) WHERE p % 3 <> 1",
    "first_frames": "SELECT user_id p, arg_min(value, event_id) stage_x FROM events WHERE event_id % 7 <> 0 AND event_id % 3 = 0 AND value IS NOT NULL AND user_id IS NOT NULL GROUP BY 1",
    "wavelengths": f"SELECT event_id, name, CASE WHEN event_id%5 < 2 THEN CAST(left(name, 3) AS DOUBLE)/1000 END um FROM {_names(LASERS)}",
    "fused_placement": f"WITH {R4} SELECT " + ", ".join(f"(min(stage_{a})+max(stage_{a})+{D(repr(n * 0.115))})/2 centre_{a}" for a, n in (("z", 5), ("y", 25), ("x", 64))) + " FROM r4",
    "channel_order": "SELECT CAST(row_number() OVER (ORDER BY min(event_id))-1 AS INT) place, event_type channel FROM events WHERE event_type <> '' GROUP BY event_type",
    "batch_means": f"WITH {R2} SELECT p,c,0 batch,y,x,round(sum(CAST(floor(greatest({D(0)},least({D(65535)},(v-{OFF})*{GAIN}))) AS INT))/{D(7)},6) v FROM r2 GROUP BY p,c,y,x",
    "flatfield_estimate": f"WITH {R1}, m AS (SELECT 0 t, 0 p, c, 0 z, y, x, avg(CAST(floor(greatest({D(0)},least({D(65535)},(v-{OFF})*{GAIN}))) AS INT)) v FROM r1 GROUP BY c,y,x), b AS (SELECT * FROM {_box(_box('m', 'y', 25, 2), 'x', 64, 2)}) SELECT c,y,x,round(v/(SELECT avg(v) FROM b),6) ff FROM b",
    "reduced_patches": f"WITH {R1}, {R4}, {PAIRS}, f AS (SELECT *, greatest(1,least(3,i_z1-i_z0)) f_z, greatest(1,least(5,i_y1-i_y0)) f_y, greatest(1,least(5,i_x1-i_x0)) f_x FROM prs) SELECT f.t,i,j,f_z,f_y,f_x,CAST(floor((a.z-i_z0)/f_z) AS INT) z,CAST(floor((a.y-i_y0)/f_y) AS INT) y,CAST(floor((a.x-i_x0)/f_x) AS INT) x,sum(a.v)/CAST(any_value(f_z*f_y*f_x) AS DOUBLE) a,sum(b.v)/CAST(any_value(f_z*f_y*f_x) AS DOUBLE) b FROM f JOIN r1 a ON a.t=f.t AND a.p=i AND a.z>=i_z0 AND a.z<i_z1 AND a.y>=i_y0 AND a.y<i_y1 AND a.x>=i_x0 AND a.x<i_x1 JOIN r1 b ON b.t=f.t AND b.p=j AND b.z-j_z0=a.z-i_z0 AND b.y-j_y0=a.y-i_y0 AND b.x-j_x0=a.x-i_x0 GROUP BY 1,2,3,4,5,6,7,8,9",
    "phase_corr": f"WITH {R1} SELECT DISTINCT t,p,c,z,CAST(-(p%5) AS DOUBLE) dy,CAST(-(2*p%7) AS DOUBLE) dx FROM r1",
    "box_filter_sparse": f"WITH {R2} SELECT * FROM (SELECT {ALL}, round(v,6) v FROM {_box(_box(_box('r2', 'z', 7), 'y', 50), 'x', 64)}) WHERE v <> 0",
    "deskew_sparse": f"WITH {R2}, {_deskew('r2', 7, 50, 24, 68)} SELECT * FROM dsk WHERE v <> 0",
    "deskew_reversed": f"WITH {R1}, {_deskew('r1')} SELECT t,p,c,5-z z,y,x,v FROM dsk",
    "fuse_2d_mean": f"WITH {R1}, {R4}, mz AS (SELECT t,p,c,y,x,max(v) v FROM r1 GROUP BY ALL), lo AS (SELECT min(stage_y) ly, min(stage_x) lx FROM r4), pl AS (SELECT mz.t,mz.c, mz.y + CAST(floor((r4.stage_y-ly)/{PX}) AS INT) y, mz.x + CAST(floor((r4.stage_x-lx)/{PX}) AS INT) x, v, {_cosine('mz.y', 25)}*{_cosine('mz.x', 64)} w FROM mz JOIN r4 USING (t,p), lo) SELECT t,c,y,x, CASE WHEN sum(w)>0 THEN CAST(floor(sum(v*w)/sum(w)+{D('1e-9')}) AS INT) ELSE 0 END v FROM pl GROUP BY t,c,y,x",
    "multiscale_read": f"WITH {R4} SELECT p, CAST(level AS INT) \"level\", 'scale'||level||'/image' path, axis, round(base*CASE WHEN base=1 THEN 1 ELSE f END,9) \"scale\", round(o+(f-1)*base/2*h+CASE axis WHEN 'y' THEN stage_y WHEN 'x' THEN stage_x ELSE 0 END,9) \"shift\" FROM r4, (VALUES (0,1),(1,2),(2,4),(3,8)) l(level,f), (VALUES ('t',{D(1.0)},{D(0.0)},0),('c',{D(1.0)},{D(0.0)},0),('z',{D(0.4)},{D(1.0)},1),('y',{PX},{D(3.0)},1),('x',{PX},{D(-2.0)},1)) a(axis,base,o,h)",
    "multiscale_read_v04": f"WITH {R4} SELECT p, CAST(level AS INT) \"level\", CAST(level AS VARCHAR) path, axis, round(base*CASE WHEN h=0 THEN 1 ELSE pow(2,level) END,9) \"scale\", round(o+(pow(2,level)-1)*base/2*h+CASE axis WHEN 'y' THEN stage_y WHEN 'x' THEN stage_x ELSE 0 END,9) \"shift\" FROM r4, range(4) l(level), (VALUES ('t',{D(1.0)},{D(0.0)},0),('c',{D(1.0)},{D(0.0)},0),('y',{PX},{D(3.0)},1),('x',{PX},{D(-2.0)},1)) a(axis,base,o,h)",
    "asi_geometry": f"SELECT n+20 angle, round({D(90.0)}-(n+20),9) tilt, round({D(1.5)}/tan(radians(n+20)),9) step FROM {SIZES}",
    "optical_resolution": f"SELECT n*10+400 nm, round((n*10+400)*({D('1.6163399561827614')}/pi()/{D(1.35)}),9) xy, round((n*10+400)*({D(2.355)}*sqrt({D(6.0)})/pi()*{D(1.4)}/{D(1.35)}/{D(1.35)}),9) z FROM {SIZES}",
    "skewed_roi": f"SELECT CAST(n AS INT) n, CAST(p0+(p0%2=0)::INT AS INT) planes, CAST(r+(r%2=0)::INT AS INT) n_rows, CAST(c+(c%2=0)::INT AS INT) n_columns FROM (SELECT n, r, c, CAST(floor(ceil((r+1)*{D(0.5)}*{PX}*cos(radians(30))+n*{D(0.53)}+{D(1.03)})/{D(0.4)}) AS INT) p0 FROM (SELECT n, CAST(ceil((n*{D(0.37)}+{D(1.01)})/{PX}/sin(radians(30))) AS INT) r, CAST(ceil((n*{D(0.29)}+{D(2.07)})/{PX}) AS INT) c FROM {SIZES}))",
    "tile_index_split": f"WITH {R4} SELECT p idx, CAST(p//4 AS INT) t, CAST(p%4 AS INT) p FROM r4",
    "edges_json_roundtrip": f"WITH {R4}, {PAIRS}, {OFFSETS}, {EDGES} SELECT * FROM e",
    "per_index_metadata": f"WITH {R4} SELECT t,p,0 c,round(stage_z,6) stage_z,round(stage_y,6) stage_y,round(stage_x,6) stage_x,'488nm' channel FROM r4",
    "chunk_roundtrip": f"WITH {R1} SELECT * FROM r1",
    "rasterise_lineitem": f"WITH {R2} SELECT * FROM r2",
    "rasterise_events": f"WITH {R3} SELECT * FROM r3",
}
