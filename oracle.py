"""The registered queries in SQL, written from the definitions and run by DuckDB on the same tables."""

from __future__ import annotations

REACH = 6

_COPURCHASE = f"""
e as materialized (
  select x.l_partkey as src, y.l_partkey as dst, min(abs(x.l_quantity - y.l_quantity)) + 1 as weight
  from lineitem x join lineitem y
    on x.l_orderkey = y.l_orderkey and y.l_linenumber between x.l_linenumber + 1 and x.l_linenumber + {REACH}
  where x.l_partkey <> y.l_partkey group by all)"""

_ENDS = "v as materialized (select src as id from e union select dst from e)"
_EDGES = {
    "copurchase": _COPURCHASE + ", " + _ENDS,
    "copurchase_all_parts": _COPURCHASE
    + ", v as materialized (select p_partkey as id from part union select src from e union select dst from e)",
    "order_lines": """
l as (select l_orderkey * 1048576 + l_linenumber as id, l_quantity as q from lineitem),
e as materialized (
  select x.id as src, y.id as dst, min(abs(x.q - y.q)) + 1 as weight from l x join l y on y.id = x.id + 1 group by all),
v as materialized (select distinct id from l)""",
    "supplier_part": """
e as materialized (
  select distinct 2 * l_suppkey + 1 as src, 2 * l_partkey as dst, 1.0::double as weight from lineitem), """
    + _ENDS,
    "customer_chain": """
e as materialized (
  select a.c_custkey::bigint as src, b.c_custkey::bigint as dst, abs(a.c_acctbal - b.c_acctbal) + 1 as weight
  from customer a join customer b on b.c_custkey = a.c_custkey + 1),
v as materialized (select c_custkey::bigint as id from customer)""",
    "geography": """
e as materialized (
  select 4 * n_nationkey::bigint + 1 as src, 4 * n_regionkey::bigint as dst, 1.0::double as weight from nation
  union all select 4 * s_suppkey + 2, 4 * s_nationkey::bigint + 1, 1.0 from supplier
  union all select 4 * c_custkey + 3, 4 * c_nationkey::bigint + 1, 1.0 from customer), """
    + _ENDS,
}


def graph(name: str, directed: bool) -> str:
    """CTEs ``e`` (edges as given), ``v``, ``g`` (edges to follow) and ``s`` (neighbours to count)."""
    both = "select src, dst, weight from e union all select dst, src, weight from e"
    if directed:
        g, s = "select * from e", both
    else:
        g = f"select src, dst, min(weight) as weight from ({both}) group by all"
        s = "select * from g"
    return f"{_EDGES[name]}, g as materialized ({g}), s as materialized ({s})"


_SOURCE = "(select src from g group by src order by count(*) desc, src limit 1)"


def select(name: str, directed: bool, query: str) -> str:
    return f"with {graph(name, directed)} {query}"


def distances(name: str, directed: bool, step: str, column: str, kind: str, hops: int | None = None) -> str:
    """Least values over paths from the busiest vertex; ``step`` is what one edge adds."""
    limit = "" if hops is None else f"where r.d < {hops}"
    return f"""with recursive {graph(name, directed)},
r(id, d) using key (id) as (
  select {_SOURCE}, 0.0::double
  union
  select g.dst, min(r.d + {step}) from r join g on r.id = g.src left join recurring.r k on k.id = g.dst {limit}
  group by g.dst, k.d having min(r.d + {step}) < coalesce(k.d, 1e300))
select v.id, coalesce(r.d, -1)::{kind} as {column} from v left join r using (id)"""


def near_distances(name: str, directed: bool, rounds: int) -> str:
    """Least sums of weights over paths of at most ``rounds`` edges from the busiest vertex."""
    steps = f"d0 as (select id, 0.0::double as d from v where id = {_SOURCE})"
    for i in range(rounds):
        steps += f""",
d{i + 1} as materialized (select id, min(d) as d from (
  select * from d{i} union all select g.dst, d + g.weight from d{i} r join g on g.src = r.id) group by id)"""
    return f"""with {graph(name, directed)}, {steps}
select v.id, coalesce(d, -1)::double as distance from v left join d{rounds} using (id)"""


def near_components(name: str, directed: bool, rounds: int) -> str:
    """The smallest id within ``rounds`` edges, directions ignored."""
    steps = "c0 as (select id, id as label from v)"
    for i in range(rounds):
        steps += f""",
c{i + 1} as materialized (select id, min(label) as label from (
  select * from c{i} union all select s.dst, label from c{i} c join s on s.src = c.id) group by id)"""
    return f"with {graph(name, directed)}, {steps} select id, label as component from c{rounds}"


def components(name: str, directed: bool) -> str:
    return f"""with recursive {graph(name, directed)},
r(id, label) using key (id) as (
  select id, id from v
  union
  select s.dst, min(r.label) from r join s on r.id = s.src join recurring.r k on k.id = s.dst
  group by s.dst, k.label having min(r.label) < k.label)
select id, label as component from r"""


def labels(name: str, directed: bool, rounds: int) -> str:
    steps = "c0 as (select id, id as label from v)"
    for i in range(rounds):
        steps += f""",
m{i} as (select s.dst as id, c.label, count(*) as n from c{i} c join s on c.id = s.src group by all),
w{i} as (select id, label from m{i} qualify row_number() over (partition by id order by n desc, label) = 1),
c{i + 1} as materialized (select c.id, coalesce(w.label, c.label) as label from c{i} c left join w{i} w using (id))"""
    return f"with {graph(name, directed)}, {steps} select id, label from c{rounds}"


def ranks(name: str, directed: bool, rounds: int) -> str:
    steps = """n as (select count(*)::double as n from v),
k as materialized (select v.id, count(g.src) as k from v left join g on g.src = v.id group by v.id),
p0 as (select v.id, 1.0::double / n as r from v, n)"""
    for i in range(rounds):
        steps += f""",
d{i} as (select coalesce(sum(r), 0.0::double) as d from p{i} join k using (id) where k.k = 0),
q{i} as (select g.dst as id, sum(p.r / k.k) as q from p{i} p join k using (id) join g on g.src = p.id group by g.dst),
p{i + 1} as materialized (
  select v.id, (1.0::double - 0.85::double) / n + 0.85::double * coalesce(q, 0.0::double) + 0.85::double / n * d as r
  from v cross join n cross join d{i} left join q{i} using (id))"""
    return f"with {graph(name, directed)}, {steps} select id, round(r, 9) as rank from p{rounds}"


_TRIANGLES = """
u as materialized (select distinct least(src, dst) as a, greatest(src, dst) as b from g where src <> dst),
t as materialized (
  select x.a as a, x.b as b, y.b as c from u x join u y on x.b = y.a join u z on z.a = x.a and z.b = y.b),
corners as (
  select a as id, b as p, c as q from t union all select b, a, c from t union all select c, a, b from t),
h as (select distinct src, dst from g where src <> dst),
j as materialized (
  select id, src, dst from corners join h on src = p and dst = q
  union all select id, src, dst from corners join h on src = q and dst = p)"""


def with_triangles(name: str, directed: bool, query: str) -> str:
    return f"with {graph(name, directed)}, {_TRIANGLES} {query}"


def clustering(name: str, directed: bool) -> str:
    return with_triangles(
        name,
        directed,
        """, nb as (select id, count(*) as d from (select a as id from u union all select b from u) group by id),
links as (select id, count(*) as c from j group by id)
select v.id, case when d > 1 then round(coalesce(c, 0) / (d * (d - 1)), 9) else 0.0::double end as coefficient
from v left join nb using (id) left join links using (id)""",
    )
