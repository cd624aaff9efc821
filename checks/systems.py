"""The fit of a tile in SQL: observations, constraints, and elimination of one unknown at a time.

Each function returns common table expressions for one system; the name s tells apart the
systems of a statement. Square tiles only.
"""

from __future__ import annotations

from icegrid.fit import FitSpec

# bias nodes start here, as BIAS_START of the fit
FIRST_BIAS = 1 << 40

STENCILS = """
kinds(kind, wi, wj, o) as (values ('xx',2,0,2),('yy',0,2,2),('xy',1,1,2),('x',1,0,1),('y',0,1,1)),
stencil(kind, k, di, dj, c, mid) as (values
  ('x',0,0,0,-1e0,false),('x',1,1,0,1e0,true),('y',0,0,0,-1e0,false),('y',1,0,1,1e0,true),
  ('xx',0,0,0,1e0,false),('xx',1,1,0,-2e0,true),('xx',2,2,0,1e0,false),
  ('yy',0,0,0,1e0,false),('yy',1,0,1,-2e0,true),('yy',2,0,2,1e0,false),
  ('xy',0,0,0,sqrt(2e0),false),('xy',1,1,0,-sqrt(2e0),false),
  ('xy',2,0,1,-sqrt(2e0),true),('xy',3,1,1,sqrt(2e0),false))"""


def shape(spec: FitSpec) -> tuple[int, int]:
    """Nodes along a side of the surface and of its change."""
    return spec.shape(spec.z0_spacing)[0], spec.shape(spec.dz_spacing)[0]


def observations(spec: FitSpec, s: str, points: str = "tpts", used: str = "true") -> str:
    """nd{s}: the nodes of each point, named k in its tile, with the coefficients c.

    A bias is numbered by the one parameter it may have.
    """
    (n0, n1), half, last = shape(spec), spec.width / 2, spec.n_epochs - 1
    s0, s1 = spec.z0_spacing, spec.dz_spacing
    bias = "".join(f"""
 union all select k, x0, y0, z, sigma, {FIRST_BIAS} + cast("{p}" as bigint), 1e0 from f{s}""" for p in spec.bias_params)
    return f"""
u{s} as materialized (select *, row_number() over () k, (x-x0+{half})/{s0} u0, (y-y0+{half})/{s0} v0, (x-x0+{half})/{s1} u1, (y-y0+{half})/{s1} v1,
  ("time"-{spec.t_start})/{spec.dt} s
  from {points} where "time" between {spec.t_start} and {spec.t_start + spec.dt * last} and ({used})),
f{s} as (select *, least(floor(u0), {n0 - 2}) i0, least(floor(v0), {n0 - 2}) j0,
  least(floor(u1), {n1 - 2}) i1, least(floor(v1), {n1 - 2}) j1, least(floor(s), {last - 1}) k1 from u{s}),
nd{s} as (
 select k, x0, y0, z, sigma, cast((j0+dj)*{n0}+i0+di as bigint) node,
  case when di=1 then u0-i0 else 1-(u0-i0) end * case when dj=1 then v0-j0 else 1-(v0-j0) end c from f{s}, (values (0,0),(1,0),(0,1),(1,1)) m(di,dj)
 union all
 select k, x0, y0, z, sigma, cast({n0 * n0}+((k1+dk)*{n1}+j1+dj)*{n1}+i1+di as bigint),
  case when k1+dk = {spec.ref_epoch} then 0 else case when di=1 then u1-i1 else 1-(u1-i1) end * case when dj=1 then v1-j1 else 1-(v1-j1) end
   * case when dk=1 then s-k1 else 1-(s-k1) end end from f{s}, (values (0,0),(1,0),(0,1),(1,1)) m(di,dj), (values (0),(1)) t(dk){bias})"""


def weight(expected: float | None) -> float:
    return 1 / expected if expected else 0.0


def constraints(spec: FitSpec, s: str) -> str:
    """cons{s}: constraint rows (line) with node, coefficient c and the node mid of their middle."""
    n0, n1 = shape(spec)
    s0, s1, dt, base = spec.z0_spacing, spec.dz_spacing, spec.dt, n0 * n0
    return f"""
place{s} as (select n, kind, o, i, j, case when kind in ('x', 'xx') and j in (0, n-1) or kind in ('y', 'yy') and i in (0, n-1) then 0.5e0 else 1e0 end share
  from (select {n0} n union select {n1}) l, kinds, range({n0}) a(i), range({n0}) b(j) where i < n - wi and j < n - wj),
cons{s} as materialized (
 select 'z0-' || kind || '-' || i || '-' || j line, (j+dj)*{n0}+i+di node,
  c * sqrt(share) * case o when 2 then {1 / s0 / spec.e_d2z0_dx2} else {weight(spec.e_dz0_dx)} end c,
  max(case when mid then (j+dj)*{n0}+i+di end) over (partition by kind, i, j) mid
 from place{s} join stencil using (kind) where n = {n0}
 union all
 select 'dz-' || kind || '-' || i || '-' || j || '-' || t, {base}+((t+e)*{n1}+j+dj)*{n1}+i+di,
  (2*e-1) * c / {dt} * sqrt(share * {dt}) * case o when 2 then {1 / s1 / spec.e_d3z_dx2dt} else {weight(spec.e_d2z_dxdt)} end,
  max(case when mid then {base}+(j+dj)*{n1}+i+di end) over (partition by kind, i, j, t)
 from place{s} join stencil using (kind), range({spec.n_epochs - 1}) t(t), range(2) e(e) where n = {n1}
 union all
 select 'tt-' || i || '-' || j || '-' || t, {base}+((t+e)*{n1}+j)*{n1}+i,
  case when e = 1 then -2e0 else 1e0 end / {dt * dt} * {s1} / {spec.e_d2z_dt2} * sqrt({dt}
   * case when i in (0, {n1 - 1}) then 0.5e0 else 1e0 end * case when j in (0, {n1 - 1}) then 0.5e0 else 1e0 end),
  {base}+j*{n1}+i
 from range({n1}) a(i), range({n1}) b(j), range({spec.n_epochs - 2}) t(t), range(3) e(e))"""


def solved(spec: FitSpec, s: str, factors: str | None = None, biases: str | None = None,
           priors: str | None = None, variances: bool = False) -> str:
    """sol{s}: value v of every unknown node of every tile; its variance var too if asked for.

    factors names a table (x0, y0, node, factor) of weaker constraints, biases one
    (x0, y0, node, expected), and priors one (x0, y0, a, b, v) with b = -1 for the right side.
    """
    n0, n1 = shape(spec)
    base, layer = n0 * n0, n1 * n1
    fixed = base + spec.ref_epoch * layer
    total = base + spec.n_epochs * layer
    f = "f.factor * f.factor" if factors else "1e0"
    join = f"join {factors} f on f.x0 = t.x0 and f.y0 = t.y0 and f.node = c.mid" if factors else ""
    more_nodes = f" union all select x0, y0, node from {biases}" if biases else ""
    more = f" union all select x0, y0, node, node, 1/(expected*expected) from {biases}" if biases else ""
    more += f" union all select x0, y0, a, b, v from {priors} where b >= 0" if priors else ""
    more_g = f" union all select x0, y0, a, v from {priors} where b = -1" if priors else ""
    return f"""
nz{s} as materialized (select * from nd{s} where c <> 0),
t{s} as materialized (select distinct x0, y0 from nz{s}),
un{s} as materialized (select x0, y0, node, row_number() over (partition by x0, y0 order by node) i from (
  select x0, y0, node from t{s}, range({total}) r(node) where node not between {fixed} and {fixed + layer - 1}{more_nodes})),
cc{s} as (select mid, a.node a, b.node b, sum(a.c*b.c) v from cons{s} a join cons{s} b using (line, mid) group by all),
sy{s} as materialized (select x0, y0, a, b, sum(v) v from (
  select a.x0, a.y0, a.node a, b.node b, sum(a.c*b.c/(a.sigma*a.sigma)) v
   from nz{s} a join nz{s} b on a.k = b.k group by 1, 2, 3, 4
  union all select t.x0, t.y0, a, b, sum(v/({f})) from t{s} t cross join cc{s} c {join} group by 1, 2, 3, 4{more}) group by all),
g{s} as (select x0, y0, a, sum(v) g from (
  select x0, y0, node a, sum(c*z/(sigma*sigma)) v from nz{s} group by all{more_g}) group by all),
rg{s} as (select x0, y0, 1e-12*max(abs(v)) ridge from un{s} u join sy{s} y using (x0, y0) where a = u.node and b = u.node group by all),
m{s} as materialized (select a.x0, a.y0, a.i, list_append(
    list(coalesce(v, 0) + case when a.i = b.i then ridge else 0 end order by b.i), any_value(coalesce(g, 0))) r
  from un{s} a join un{s} b on a.x0 = b.x0 and a.y0 = b.y0 join rg{s} q on q.x0 = a.x0 and q.y0 = a.y0
   left join sy{s} y on y.x0 = a.x0 and y.y0 = a.y0 and y.a = a.node and y.b = b.node
   left join g{s} g on g.x0 = a.x0 and g.y0 = a.y0 and g.a = a.node group by 1, 2, 3),
{_swept(s) if variances else _eliminated(s)}"""


def _swept(s: str) -> str:
    """Each step sweeps one unknown: after the last the rows hold the negative inverse, and the
    solution in the place after it."""
    return f"""
sw{s}(x0, y0, i, k, r) using key (x0, y0, i) as (
  select x0, y0, i, cast(0 as bigint), r from m{s}
  union
  select x0, y0, i, "at", case
    when i = "at" then list_transform(p, lambda v, j: case when j = "at" then -1/v else v/d end)
    else list_transform(r, lambda v, j: case when j = "at" then v/d else v-f*p[j] end) end
  from (select w.x0, w.y0, w.i, w.r, p.r p, p.i "at", p.r[p.i] d, w.r[p.i]/p.r[p.i] f
    from sw{s} w join sw{s} p on p.x0 = w.x0 and p.y0 = w.y0 and p.i = w.k+1)),
sol{s} as materialized (select w.x0, w.y0, node, r[len(r)] v, -r[w.i] var from sw{s} w join un{s} u using (x0, y0, i))"""


def _eliminated(s: str) -> str:
    """Each step takes one unknown out of the rows below; the values follow from the last up."""
    return f"""
el{s}(x0, y0, i, k, r) using key (x0, y0, i) as (
  select x0, y0, i, cast(0 as bigint), r from m{s}
  union
  select x0, y0, i, k+1, list_transform(p, lambda v, j: r[j+1]-f*v)
  from (select w.x0, w.y0, w.i, w.k, w.r, p.r[2:] p, w.r[1]/p.r[1] f
    from el{s} w join el{s} p on p.x0 = w.x0 and p.y0 = w.y0 and p.i = w.k+1 where w.i > w.k+1)),
ek{s} as materialized (select * from el{s}),
up{s}(x0, y0, i, xs) as (
  select x0, y0, max(i)+1, cast([] as double[]) from m{s} group by x0, y0
  union all
  select u.x0, u.y0, e.i, list_prepend((e.r[-1] - case when len(xs) = 0 then 0 else list_inner_product(e.r[2:len(e.r)-1], xs) end)/e.r[1], xs)
  from up{s} u join ek{s} e on e.x0 = u.x0 and e.y0 = u.y0 and e.i = u.i-1),
sol{s} as materialized (select p.x0, p.y0, node, xs[u.i] v from up{s} p join un{s} u on u.x0 = p.x0 and u.y0 = p.y0 where p.i = 1)"""


def fitted(spec: FitSpec, s: str, **kw) -> str:
    """Everything from the observations nd{s} to sol{s}."""
    return f"{STENCILS},{constraints(spec, s)},{solved(spec, s, **kw)}"
