"""SQL with the same meaning as the queries, for an independent engine.

Written from the definitions of the operators, not from their code: traversal
is a recursive CTE, Lloyd rounds are unrolled, the silhouette is pairwise.
"""

from __future__ import annotations

from millrace.plans.queries import CLUSTERS, ORIGIN, SOLVER_PLACES, START, TARGET, TIE_SHIFT

COORDS = ("x", "y", "z", "w")

# --- inputs ----------------------------------------------------------------

EDGES = """edges as (
  select distinct a.o_custkey as src, b.o_custkey as dst
  from orders a join orders b on b.o_orderkey = a.o_orderkey + 1
  where a.o_orderstatus = 'P' and a.o_custkey <> b.o_custkey)"""

NODES = "nodes as (select src as node from edges union select dst from edges)"

ADJACENCY = """adjacency as (
  select src as node, list(dst order by dst) as l from edges group by src)"""

POINTS = """points as materialized (
  select c_custkey, c_acctbal / 1000 as x, cast(count(*) as double) as y,
         avg(o_totalprice) / 10000 as z,
         date_diff('day', max(o_orderdate)::date, date '2001-08-01') / 100 as w
  from customer join orders on o_custkey = c_custkey
  group by c_custkey, c_acctbal)"""

SEEDS = f"""seeds as materialized (
  select row_number() over (order by md5(c_custkey::varchar), c_custkey) - 1 as k, x, y, z, w
  from points qualify k < {CLUSTERS})"""

BINARY = """binary_rows as (
  select o_orderkey, (o_orderstatus = 'F')::double as label, o_totalprice,
         o_orderpriority, c_mktsegment, c_acctbal
  from orders join customer on o_custkey = c_custkey)"""

FIXED_RULE = """fixed as (
  select o_totalprice, (o_totalprice > 150000)::double as prediction,
         (o_orderstatus = 'F')::double as label
  from orders)"""


def reached(rounds: int) -> str:
    """walk(n, d): every (node, round) pair; reached: least round per node."""
    return f"""walk(n, d) as (
  select {START}::bigint, 0 union
  select dst, d + 1 from walk join edges on src = n where d < {rounds}),
reached as (select n as node, min(d) as distance from walk group by n)"""


def bucket(key: str) -> str:
    return f"('0x' || substr(md5({key}::varchar), 1, 8))::bigint % 100"


def rounded(expr: str, places: int = 6) -> str:
    return f"(round({expr} + {TIE_SHIFT * 10**-places}, {places}) + 0.0)"


def distance(a: str, b: str, dims: tuple[str, ...]) -> str:
    return "sqrt(" + " + ".join(f"power({b}.{c} - {a}.{c}, 2)" for c in dims) + ")"


def text_list(expr: str) -> str:
    return f"coalesce(array_to_string({expr}, ','), '')"


def graph(*ctes: str, select: str) -> str:
    return "with recursive " + ",\n".join((EDGES, *ctes)) + "\n" + select


# --- clustering ------------------------------------------------------------


def assignment(name: str, centers: str, dims: tuple[str, ...] = COORDS) -> str:
    return f"""{name} as materialized (
  select c_custkey, p.x, p.y, p.z, p.w, k
  from points p, {centers} c
  qualify row_number() over (partition by c_custkey order by {distance('p', 'c', dims)}, k) = 1)"""


def lloyd(rounds: int, dims: tuple[str, ...] = COORDS, stop: float | None = None) -> str:
    """CTEs up to centers{rounds}; with `stop`, centers stay once the movement
    of a round is no more than it. `moves` counts the rounds that ran."""
    ctes = [
        POINTS,
        SEEDS,
        "centers0 as (select k, x, y, z, w, 1e300 as moved, 0 as moves from seeds)",
    ]
    for i in range(1, rounds + 1):
        old = f"centers{i - 1}"
        done = f"o.moved <= {stop}" if stop is not None else "false"
        means = ", ".join(f"coalesce(avg(a.{c}), any_value(o.{c})) as {c}" for c in COORDS)
        kept = ", ".join(f"case when {done} then o.{c} else n.{c} end as {c}" for c in COORDS)
        ctes.append(assignment(f"assigned{i}", old, dims))
        ctes.append(
            f"""fresh{i} as (
  select o.k, {means} from {old} o left join assigned{i} a on a.k = o.k group by o.k)"""
        )
        ctes.append(
            f"""centers{i} as materialized (
  select o.k, {kept},
         case when {done} then o.moved else sum({distance('o', 'n', dims)}) over () end as moved,
         o.moves + case when {done} then 0 else 1 end as moves
  from {old} o join fresh{i} n on n.k = o.k)"""
        )
    return "with " + ",\n".join(ctes)


def centers(rounds: int, extra: str = "", **params) -> str:
    columns = ", ".join(f"{rounded(c)} as {c}" for c in COORDS)
    return f"{lloyd(rounds, **params)}\nselect k::int as cluster, {columns}{extra} from centers{rounds}"


def assigned(select: str) -> str:
    return f"with {POINTS},\n{SEEDS},\n{assignment('assigned', 'seeds')}\n{select}"


def origin_distance(dims: tuple[str, ...]) -> str:
    squares = " + ".join(f"power({v} - {c}, 2)" for c, v in zip(dims, ORIGIN))
    return f"with {POINTS} select c_custkey, {rounded(f'sqrt({squares})')} as distance from points"


# More rounds than the loop needs to stop at the tested scale factors.
UNROLLED = 72

SILHOUETTE = f"""
with v as (select vec_id, label, embedding::double[] as e from embeddings),
sizes as (select label, count(*) as n from v group by label),
pairs as (
  select a.vec_id, a.label as own, b.label as other,
         sum(power(list_distance(a.e, b.e), 2)) as total
  from v a, v b group by a.vec_id, a.label, b.label),
means as (
  select vec_id, n as own_size,
         case when own_size > 1 then total_own / (own_size - 1) end as a, b
  from (select vec_id, own, max(total) filter (where other = own) as total_own,
               min(total / s.n) filter (where other <> own) as b
        from pairs join sizes s on s.label = other group by vec_id, own) m
  join sizes on sizes.label = m.own)
select {rounded('''avg(case when own_size = 1 then 0.0 when a < b then 1 - a / b
                        when a > b then b / a - 1 else 0.0 end)''')} as silhouette
from means"""


# --- features --------------------------------------------------------------


def ranks(name: str, column: str, source: str) -> str:
    return f"""{name} as (
  select {column} as v, row_number() over (order by count(*) desc, {column}) - 1 as i
  from {source} group by {column})"""


def indicators(rank: str, width: int, first: int, prefix: str = "f") -> str:
    return ", ".join(f"({rank}.i = {j})::double as {prefix}{first + j}" for j in range(width))


PIPELINE = f"""with {BINARY},
train as (select * from binary_rows where {bucket('o_orderkey')} < 70),
test as (select * from binary_rows where {bucket('o_orderkey')} >= 70),
{ranks('p', 'o_orderpriority', 'train')},
{ranks('m', 'c_mktsegment', 'train')}
select o_orderkey, label, o_totalprice as f0, {indicators('p', 4, 1)},
       {indicators('m', 4, 5)}, c_acctbal as f9
from test join p on p.v = o_orderpriority join m on m.v = c_mktsegment"""

# Least squares with an L2 penalty on the standardised slope.
RIDGE = f"""
with s as (select regr_slope(l_extendedprice, l_quantity) as b,
                  avg(l_quantity) as mx, avg(l_extendedprice) as my,
                  stddev_pop(l_extendedprice) as sy
           from lineitem),
slope as (select b * 1.0 / (1.0 + 100.0 / sy) as b1, my, mx from s)
select 'l_quantity' as term, {rounded('b1', 4)} as coefficient, 100.0::double as reg_param from slope
union all
select '(intercept)', {rounded('my - b1 * mx', 4)}, 100.0::double from slope"""


# Normal equations of three centred features by Cramer's rule.
LEAST_SQUARES = f"""with c as (
  select var_pop(l_quantity) as a, covar_pop(l_quantity, l_discount) as b,
         covar_pop(l_quantity, l_tax) as c, var_pop(l_discount) as d,
         covar_pop(l_discount, l_tax) as e, var_pop(l_tax) as f,
         covar_pop(l_quantity, l_extendedprice) as p, covar_pop(l_discount, l_extendedprice) as q,
         covar_pop(l_tax, l_extendedprice) as r, avg(l_quantity) as m1, avg(l_discount) as m2,
         avg(l_tax) as m3, avg(l_extendedprice) as my
  from lineitem),
det as (select *, a*(d*f - e*e) - b*(b*f - e*c) + c*(b*e - d*c) as v from c),
w as (
  select (p*(d*f - e*e) - b*(q*f - e*r) + c*(q*e - d*r)) / v as w1,
         (a*(q*f - e*r) - p*(b*f - e*c) + c*(b*r - q*c)) / v as w2,
         (a*(d*r - q*e) - b*(b*r - q*c) + p*(b*e - d*c)) / v as w3, m1, m2, m3, my
  from det)
select 'l_quantity' as term, {rounded('w1', 3)} as coefficient from w
union all select 'l_discount', {rounded('w2', 3)} from w
union all select 'l_tax', {rounded('w3', 3)} from w
union all select '(intercept)', {rounded('my - w1 * m1 - w2 * m2 - w3 * m3', 3)} from w"""

LINES = f"""lines as (
  select l_orderkey, l_linenumber, l_quantity as x, l_discount as y, l_tax as z, l_extendedprice as label,
         concat(l_orderkey, '-', l_linenumber) as key from lineitem),
train as materialized (
  select *, ('0x' || substr(md5('12345:' || key), 1, 13))::bigint / 4503599627370496.0 < 0.8 as fits
  from lines where {bucket("key")} < 70),
test as materialized (select * from lines where {bucket("key")} >= 70)"""


def ridge(name: str, rows: str, reg_param: str) -> str:
    """Weights (w1, w2, w3, w0) of three features for each reg_param: centred normal
    equations by Cramer's rule, the penalty on standardised weights."""
    return f"""{name} as materialized (
  with m as (
    select reg_param, var_pop(x) as vx, var_pop(y) as vy, var_pop(z) as vz, covar_pop(x, y) as b, covar_pop(x, z) as c,
           covar_pop(y, z) as e, covar_pop(x, label) as p, covar_pop(y, label) as q, covar_pop(z, label) as r,
           avg(x) as m1, avg(y) as m2, avg(z) as m3, avg(label) as m0, 1 + reg_param / stddev_pop(label) as s
    from {rows}, {reg_param} group by reg_param),
  n as (select *, vx * s as a, vy * s as d, vz * s as f from m),
  det as (select *, a*(d*f - e*e) - b*(b*f - e*c) + c*(b*e - d*c) as v from n),
  w as (
    select reg_param, m0, m1, m2, m3, (p*(d*f - e*e) - b*(q*f - e*r) + c*(q*e - d*r)) / v as w1,
           (a*(q*f - e*r) - p*(b*f - e*c) + c*(b*r - q*c)) / v as w2,
           (a*(d*r - q*e) - b*(b*r - q*c) + p*(b*e - d*c)) / v as w3 from det)
  select *, m0 - w1 * m1 - w2 * m2 - w3 * m3 as w0 from w)"""


TUNED = f"""with {LINES},
grid(reg_param) as (values (10000.0::double), (100.0::double), (0.1::double)),
{ridge('candidates', '(select * from train where fits)', 'grid')},
tuned as materialized (
  select reg_param, sqrt(avg(power(label - w0 - w1 * x - w2 * y - w3 * z, 2))) as metric
  from candidates, train where not fits group by reg_param),
chosen as (select reg_param from tuned order by metric, reg_param desc limit 1),
{ridge('best', 'train', 'chosen')}
"""

PRICED = f"""{TUNED}select l_orderkey, l_linenumber, label, x as f0, y as f1, z as f2,
  {rounded('w0 + w1 * x + w2 * y + w3 * z', 3)} as prediction from test, best"""

# --- classification --------------------------------------------------------

CELLS = f"""{BINARY},
cells as (select o_orderkey, label, concat(o_orderpriority, '/', c_mktsegment) as cell from binary_rows),
shares as (select cell, avg(label) as p from cells where {bucket('o_orderkey')} < 70 group by cell),
scored as (
  select label, (round(p, {SOLVER_PLACES}) > 0.5)::double as prediction, round(p, {SOLVER_PLACES}) as probability
  from cells join shares using (cell) where {bucket('o_orderkey')} >= 70)"""

FITTED_ACCURACY = f"""with {CELLS} select {rounded('avg((prediction = label)::double)')} as accuracy from scored"""

# The L1 share of the penalty keeps every coefficient of these features at zero,
# so the optimum is the centred log of the class shares and nothing else.
SHARES = f"""{BINARY},
train as (select * from binary_rows where {bucket('o_orderkey')} < 70),
shares as (select avg(label) as p1, ln(avg(label) / (1 - avg(label))) / 2 as half from train)"""


def roc(score: str, ctes: str = FIXED_RULE, rows: str = "fixed") -> str:
    return f"""with {ctes},
counts as (
  select {score} as threshold, count(*) filter (where label > 0.5) as pos,
         count(*) filter (where label <= 0.5) as neg
  from {rows} group by {score}),
points as (
  select row_number() over (order by threshold desc) as position, threshold,
         (sum(neg) over (order by threshold desc) / sum(neg) over ())::double as fpr,
         (sum(pos) over (order by threshold desc) / sum(pos) over ())::double as tpr
  from counts)
select position::bigint as position, threshold, fpr, tpr from points
union all select 0, null, 0.0, 0.0
union all select (select count(*) + 1 from counts), null, 1.0, 1.0"""


def separation(start: int, target: int, rounds: int, columns: str = "", before: str = "") -> str:
    """The least round with an edge into the target and the number of such edges,
    of a walk with at most `rounds` rounds."""
    hits = f"select distance + 1 as degree, count(*) as n from reached join edges on src = node where dst = {target} group by distance"
    return graph(
        reached(rounds - 1).replace(f"select {START}::bigint, 0", f"select {start}::bigint, 0"),
        f"hits as ({hits})",
        select=f"""select {before}(select min(degree) from hits)::int as degree,
  coalesce((select n from hits order by degree limit 1), 0)::bigint as directions{columns}""",
    )


PARTS = """parts as (
  select src as node, (row_number() over (partition by src order by dst) - 1) // 3 as part, dst from edges)"""

NAMED = """named as (
  select 'customer ' || src as src, 'customer ' || dst as dst from edges)"""

ORDER_COLUMNS = (
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
)

_ERROR = "(l_extendedprice - l_quantity * 1500)"

ORACLES: dict[str, str] = {
    # sources and sinks
    "csv_scan": """select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority from orders""",
    "csv_inferred": """select o_orderkey::int as o_orderkey, o_custkey::int as o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority from orders""",
    "inferred_schema": "\nunion all\n".join(
        f"""select {i}::int as position, '{c}' as "column", '{t}' as type, count(*) - count({c}) as nulls from lineitem"""
        for i, (c, t) in enumerate((("l_orderkey", "int"), ("l_tax", "double"), ("l_returnflag", "string")))
    ),
    "checked_lines": """select o_orderkey as id, o_orderstatus as status, o_totalprice as price from orders
  where o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0""",
    "quarantined_lines": """select
  case when o_orderkey % 11 = 0 then 'no field 2' else 'field 2 is no double' end as reason,
  concat(o_orderkey, ',', o_orderstatus, case when o_orderkey % 11 <> 0 then ',n/a' else '' end) as value
  from orders where o_orderkey % 7 = 0 or o_orderkey % 11 = 0""",
    "text_scan": """select concat(o_orderkey, ',', o_custkey, ',', o_orderstatus, ',',
  o_orderpriority) as value from orders""",
    "header_skip": "select * from customer",
    "edge_list_parse": "select o_custkey as src, o_orderkey as dst from orders",
    "adjacency_parse": graph(
        ADJACENCY, select=f"select node, {text_list('l')} as neighbours from adjacency"
    ),
    "adjacency_parse_drop_last": graph(
        ADJACENCY,
        select=f"select node, {text_list('l[1:len(l) - 1]')} as neighbours from adjacency",
    ),
    "point_parse": """select l_shipdate::varchar as label, l_quantity as x, l_extendedprice as y,
  l_discount as z, l_tax as w from lineitem""",
    "adjacency_text": graph(
        ADJACENCY, select=f"select concat(node, ',', {text_list('l')}) as value from adjacency"
    ),
    "schema_report": "\nunion all\n".join(
        f"""select {i}::int as position, '{c}' as "column", '{t}' as type,
  count(*) - count({c}) as nulls from orders"""
        for i, (c, t) in enumerate(ORDER_COLUMNS)
    ),
    # projections, filters, samples, splits
    "project_columns": "select l_orderkey, l_linenumber, l_quantity, l_tax from lineitem",
    "label_projection": """select l_extendedprice as label, l_quantity, l_discount, l_tax
  from lineitem""",
    "typed_pair": f"with {FIXED_RULE} select prediction, label from fixed",
    "nonzero_points": """select l_orderkey, l_linenumber, l_discount, l_tax from lineitem
  where l_discount <> 0 or l_tax <> 0""",
    "row_count": "select count(*) as n from lineitem",
    "head_rows": """select o_orderkey, o_custkey, o_totalprice from orders
  order by o_orderkey limit 50""",
    "sample_exact": f"""select c_custkey, c_name from customer
  order by md5(c_custkey::varchar), c_custkey limit {CLUSTERS}""",
    "sample_half": """select l_orderkey, l_linenumber from lineitem
  order by md5(concat(l_orderkey, '-', l_linenumber)) limit (select count(*) // 2 from lineitem)""",
    "sample_random": f"""select c_custkey, c_name from customer
  order by md5('1:' || c_custkey), c_custkey limit {CLUSTERS}""",
    "random_split": """select o_orderkey, case when ('0x' || substr(md5('12345:' || o_orderkey), 1, 13))::bigint
  / 4503599627370496.0 < 0.7 then 'train' else 'test' end as part from orders""",
    "hash_split": f"""select o_orderkey,
  case when {bucket('o_orderkey')} < 70 then 'train' else 'test' end as part from orders""",
    # scalar functions
    "split_fields": """
with lines as (
  select o_orderkey, concat(o_orderkey, ',', o_orderstatus, ',,', o_orderpriority,
                            repeat(',', (o_orderkey % 4)::int)) as line from orders),
parts as (select o_orderkey, string_split(rtrim(line, ','), ',') as f from lines)
select o_orderkey, len(f)::int as n_fields, array_to_string(f, '|') as fields from parts""",
    "parse_numbers": """select o_orderkey, try_cast(substr(o_orderpriority, 1, 1) as int) as rank,
  try_cast(o_orderpriority as int) as bad, o_totalprice as price from orders""",
    "euclidean_distance": origin_distance(COORDS),
    "planar_distance": origin_distance(COORDS[:2]),
    "vector_add": f"with {POINTS}\n"
    + "\nunion all\n".join(
        f"select c_custkey, {i}::int as dim, {rounded(f'{c} + {ORIGIN[i]}')} as value from points"
        for i, c in enumerate(COORDS)
    ),
    "array_ops": graph(
        ADJACENCY,
        select=f"""select node, len(l)::int as n, {text_list('list_append(l, node)')} as appended,
  {text_list('list_concat(l, list_reverse(l))')} as doubled from adjacency""",
    ),
    # graph
    "adjacency_list": graph(
        ADJACENCY, select=f"select node, {text_list('l')} as neighbours from adjacency"
    ),
    "bfs_init": graph(
        NODES,
        select=f"""select node, case when node = {START} then 0 end as distance,
  case when node = {START} then 'GRAY' else 'WHITE' end as colour from nodes""",
    ),
    "frontier_expand": graph(
        reached(2),
        select="""select src, dst as node, 3 as distance
  from reached join edges on src = node where distance = 2""",
    ),
    "frontier_anti": graph(
        reached(2),
        select="""select distinct dst as node, 3 as distance
  from reached join edges on src = node
  where distance = 2 and dst not in (select node from reached)""",
    ),
    "bfs_union": graph(
        NODES,
        reached(2),
        select="""select node, distance from nodes left join reached using (node)
  union all
  select dst, 3 from reached join edges on src = node where distance = 2""",
    ),
    "bfs_state_merge": graph(
        ADJACENCY,
        reached(3),
        select=f"""select coalesce(a.node, r.node) as node, {text_list('l')} as neighbours, distance,
  case when distance is null then 'WHITE' when distance = 3 then 'GRAY' else 'BLACK' end as colour
  from adjacency a full join (
    select * from reached where distance = 3 or node in (select src from edges)) r
  on r.node = a.node""",
    ),
    "bfs_step": graph(
        NODES,
        reached(2),
        select="""select node, distance, case when distance is null then 'WHITE'
  when distance = 2 then 'GRAY' else 'BLACK' end as colour
  from nodes left join reached using (node)""",
    ),
    "degree_within_rounds": separation(
        START, TARGET, 3, ", true as gave_up", f"{START}::bigint as start, {TARGET}::bigint as target, "
    ),
    "two_sided_separation": " union all ".join(
        f"select * from ({separation(START, t, 20, ', false as gave_up', f'{START}::bigint as start, {t}::bigint as target, ')})"
        for t in (TARGET, START)
    ),
    "partitioned_adjacency": graph(
        PARTS,
        select=f"select node, part, {text_list('list(dst order by dst)')} as neighbours from parts group by node, part",
    ),
    "state_parts": graph(
        NODES,
        PARTS,
        reached(2),
        select=f"""select node, coalesce(part, 0) as part,
  {text_list('list(dst order by dst) filter (where dst is not null)')} as neighbours, distance,
  case when distance is null then 'WHITE' when distance = 2 then 'GRAY' else 'BLACK' end as colour
  from nodes left join parts using (node) left join reached using (node) group by node, part, distance""",
    ),
    "id_dictionary": graph(
        NODES,
        select="""select 'customer ' || node as name, row_number() over (order by 'customer ' || node) - 1 as id from nodes""",
    ),
    "named_adjacency": graph(
        NAMED,
        select=f"select src as node, {text_list('list(dst order by dst)')} as neighbours from named group by src",
    ),
    "named_distances": graph(
        NODES,
        reached(50),
        select="select 'customer ' || node as node, distance from nodes left join reached using (node)",
    ),
    "named_separation": separation(
        START, TARGET, 20, ", false as gave_up", f"'customer {START}' as start, 'customer {TARGET}' as target, "
    ),
    "edge_table_distances": " union all ".join(
        "select * from ("
        + graph(
            reached(50).replace(f"select {START}::bigint, 0", f"select {start}::bigint, 0"),
            select=f"select {start}::int as start, node, distance from reached",
        )
        + ")"
        for start in (START, TARGET)
    ),
    "target_hits": graph(
        reached(50),
        select=f"""select (distance + 1)::int as round, count(*) as hits
  from reached join edges on src = node where dst = {TARGET} group by distance""",
    ),
    "degree_of_separation": graph(
        reached(19),
        select=f"""select {START}::bigint as start, {TARGET}::bigint as target,
  (min(distance) + 1)::int as degree,
  count(*) filter (where distance = (
    select min(distance) from reached join edges on src = node where dst = {TARGET}))
    as directions
  from reached join edges on src = node where dst = {TARGET}""",
    ),
    "separation_from_file": graph(
        reached(19),
        select=f"""select {START}::bigint as start, {TARGET}::bigint as target,
  (min(distance) + 1)::int as degree,
  count(*) filter (where distance = (
    select min(distance) from reached join edges on src = node where dst = {TARGET}))
    as directions
  from reached join edges on src = node where dst = {TARGET}""",
    ),
    "cycle_length": graph(
        reached(19),
        select=f"""select {START}::bigint as start, {START}::bigint as target,
  (min(distance) + 1)::int as degree,
  count(*) filter (where distance = (
    select min(distance) from reached join edges on src = node where dst = {START}))
    as directions
  from reached join edges on src = node where dst = {START}""",
    ),
    "distances_from": graph(
        NODES,
        reached(50),
        select="select node, distance from nodes left join reached using (node)",
    ),
    "bfs_progress": graph(
        reached(19),
        select="""select distance + 1 as round, count(distinct r.node) as frontier_nodes,
  count(src) as frontier_edges,
  (select count(*) from (select src from edges union
                         select node from reached b where b.distance <= r.distance))
    + count(src) as processed
  from reached r left join edges on src = r.node group by distance""",
    ),
    # clustering
    "nearest_centroid": assigned("select c_custkey, k::int as cluster from assigned"),
    "cluster_means": assigned(
        "select k::int as cluster, "
        + ", ".join(f"{rounded(f'avg({c})')} as {c}" for c in COORDS)
        + ", count(*) as n from assigned group by k"
    ),
    "centroid_shift": assigned(
        f"""select {rounded(f"sum({distance('o', 'n', COORDS)})")} as shift
from seeds o join (select k, {', '.join(f'avg({c}) as {c}' for c in COORDS)}
                   from assigned group by k) n on n.k = o.k"""
    ),
    "lloyd_kmeans": centers(3),
    "lloyd_kmeans_planar": centers(3, dims=COORDS[:2]),
    "lloyd_kmeans_converged": centers(UNROLLED, extra=", moves::int as rounds", stop=0.1),
    "lloyd_planar_converged": centers(UNROLLED, extra=", moves::int as rounds", stop=0.1, dims=COORDS[:2]),
    "lloyd_pruned": centers(UNROLLED, extra=", moves::int as rounds", stop=0.1),
    "lloyd_resumed": centers(5),
    "zones_from_file": f"""{lloyd(UNROLLED, stop=0.1)},
sample as (select * from points order by md5(c_custkey::varchar), c_custkey limit 10)
select 'c' || c_custkey as label, arg_min(k, (dist, k))::int as cluster
from (select c_custkey, k, {distance('p', 'c', COORDS)} as dist from sample p, centers{UNROLLED} c)
group by c_custkey""",
    "assign_sample": f"""{lloyd(3)},
sample as (select * from points order by md5(c_custkey::varchar), c_custkey limit 10)
select c_custkey, arg_min(k, (dist, k))::int as cluster
from (select c_custkey, k, {distance('p', 'c', COORDS)} as dist from sample p, centers3 c)
group by c_custkey""",
    "silhouette": SILHOUETTE,
    # features
    "assemble_features": """select l_orderkey, l_linenumber, l_quantity as f0, l_discount as f1,
  l_tax as f2 from lineitem""",
    "string_index": f"""with {ranks('p', 'o_orderpriority', 'orders')},
{ranks('s', 'o_orderstatus', 'orders')}
select o_orderkey, p.i::int as o_orderpriority_index, s.i::int as o_orderstatus_index
from orders join p on p.v = o_orderpriority join s on s.v = o_orderstatus""",
    "string_index_keys": f"""with customers as (
  select o_orderkey, o_custkey::varchar as customer from orders),
{ranks('r', 'customer', 'customers')}
select o_orderkey, r.i::int as customer_index from customers join r on r.v = customer""",
    "one_hot": f"""with {ranks('p', 'o_orderpriority', 'orders')}
select o_orderkey, {indicators('p', 4, 0)} from orders join p on p.v = o_orderpriority""",
    "pipeline_features": PIPELINE,
    # regression
    "linear_fit": f"""
select 'l_quantity' as term,
  {rounded('regr_slope(l_extendedprice, l_quantity)', 4)} as coefficient from lineitem
union all
select '(intercept)', {rounded('regr_intercept(l_extendedprice, l_quantity)', 4)} from lineitem""",
    "linear_fit_ridge": RIDGE,
    "linear_fit_features": LEAST_SQUARES,
    "linear_tune": f"""{TUNED}select reg_param, {rounded('metric', 4)} as metric,
  reg_param = (select reg_param from chosen) as is_best from tuned""",
    "linear_best_model": TUNED
    + "union all ".join(
        f"select '{term}' as term, {rounded(w, 3)} as coefficient, reg_param from best "
        for term, w in zip(("l_quantity", "l_discount", "l_tax", "(intercept)"), ("w1", "w2", "w3", "w0"))
    ),
    "linear_score": PRICED,
    "prices_from_file": PRICED,
    "regression_metrics": f"""select {rounded(f'sqrt(avg(power({_ERROR}, 2)))', 2)} as rmse,
  {rounded(f'avg(power({_ERROR}, 2))', 2)} as mse, {rounded(f'avg(abs({_ERROR}))', 2)} as mae,
  {rounded(f'1 - sum(power({_ERROR}, 2)) / (var_pop(l_extendedprice) * count(*))')} as r2
  from lineitem""",
    # classification
    "logistic_fit": f"""with {SHARES}
select k::int as class, j::int as position,
       {rounded('case when j >= 0 then 0.0 when k = 1 then half else -half end', SOLVER_PLACES)} as coefficient
from shares, range(2) a(k), range(-1, 10) b(j)""",
    "logistic_score": f"""with {SHARES}
select o_orderkey, label, (p1 > 0.5)::double as prediction, {rounded('p1', SOLVER_PLACES)} as probability
from binary_rows, shares where {bucket('o_orderkey')} >= 70""",
    "fitted_confusion": f"""with {CELLS} select prediction, label, count(*) as n from scored group by prediction, label""",
    "fitted_accuracy": FITTED_ACCURACY,
    "fitted_roc": roc("probability", CELLS, "scored"),
    "subscriptions_from_file": FITTED_ACCURACY,
    "confusion_matrix": f"""with {FIXED_RULE}
select prediction, label, count(*) as n from fixed group by prediction, label""",
    "accuracy": f"""with {FIXED_RULE}
select {rounded('avg((prediction = label)::double)')} as accuracy from fixed""",
    "roc_curve": roc("prediction"),
    "roc_curve_scores": roc("o_totalprice"),
}
