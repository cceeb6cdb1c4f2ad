"""The registered queries once more, as SQL for a second engine to check them against."""

from __future__ import annotations

from shelfrisk.operators.sales import FLAGS, READINGS
from shelfrisk.plans.risk import PLAIN_LIMIT
from shelfrisk.plans.sales import LINEAR, PREDICTORS, TERM_NAMES, TREE
from shelfrisk.sources.views import (GAPPY_ORDERS_SQL, MESSY_FEATURES, MESSY_LINES_SQL, N_FEATURES, SALES_SQL, STORES_SQL,
                                     TABLES, WEATHER_SQL)

SPARSE_LINES = """
select vec_id, concat('0.', cast(label as varchar), case when len(tok) = 0 then '' else ' ' end,
                      array_to_string(tok, ' ')) as line
from (select vec_id, label,
        list_filter(list_transform(range(0, 64), lambda i: case when floor(abs(cast(embedding[i+1] as double)) * 10) > 0
          then concat(cast(i as varchar), ':', cast(cast(floor(abs(cast(embedding[i+1] as double)) * 10) as int) as varchar)) end),
          lambda x: x is not null) as tok
      from embeddings) t"""

INPUTS = {
    "train": SALES_SQL, "stores": STORES_SQL, "weather": WEATHER_SQL,
    "joined": f"""
select t.date, t.store_nbr, t.item_nbr, t.units, w.station_nbr, {', '.join('w.' + c for c in READINGS)}
from train t join stores k on t.store_nbr = k.store_nbr
join weather w on k.station_nbr = w.station_nbr and t.date = w.date""",
    "ranked": """
select item_nbr, sum(units) as total_units_sold, row_number() over (order by sum(units) desc, item_nbr) as place
from train group by item_nbr""",
    "clean": """
select date, store_nbr, item_nbr, units, station_nbr, codesum,
  case when preciptotal = '' then null when preciptotal = 'T' then 0.002::double
       else try_cast(preciptotal as double) end as preciptotal,
  try_cast(tavg as double) as tavg, cast(year(date) as int) as year, cast(month(date) as int) as month
from joined""",
    "medians": """
select *, median(preciptotal) over (partition by station_nbr, month) as p_group,
  median(tavg) over (partition by station_nbr, month) as t_group from clean""",
    "overall": "select median(preciptotal) as p_all, median(tavg) as t_all from clean",
    "filled": """
select date, store_nbr, item_nbr, units, station_nbr, month, codesum,
  coalesce(preciptotal, p_group, p_all) as preciptotal, coalesce(tavg, t_group, t_all) as tavg,
  dayofweek(date) in (0, 6) as is_weekend,
  coalesce(regexp_matches(codesum, 'ra|dz|sh', 'i'), false) as is_rainy_day,
  coalesce(regexp_matches(codesum, 'sn|sg|gs|pl|ic', 'i'), false) as is_snowy_day,
  coalesce(regexp_matches(codesum, '\\+fc|fc|ts|gr|sq', 'i'), false) as is_stormy_day
from medians, overall""",
    "caps": "select item_nbr, quantile_cont(units, 0.99) as cap from joined group by item_nbr",
    "capped": """
select f.*, case when units is null then null else least(units, cap) end as units_capped,
  cast(units > cap as int) as units_was_capped from filled f left join caps using (item_nbr)""",
    "days": """
select item_nbr, date, round(coalesce(sum(units_capped), 0.0), 6) as units, round(avg(tavg), 6) as tavg,
  round(avg(preciptotal), 6) as preciptotal, bool_or(is_weekend) as is_weekend,
  max(cast(is_rainy_day as int)) as is_rainy_day, max(cast(is_snowy_day as int)) as is_snowy_day,
  max(cast(is_stormy_day as int)) as is_stormy_day
from capped group by item_nbr, date
having avg(tavg) is not null and avg(preciptotal) is not null""",
    "split_days": """
select *, case when substr(md5(concat(cast(item_nbr as varchar), '|', cast(date as varchar))), 1, 8) < 'cccccccd'
  then 'train' else 'test' end as split from days""",
    "top_days": "select * from split_days where item_nbr in (select item_nbr from ranked where place <= 3)",
    "fit_rows": f"""
select item_nbr, units as y, [{', '.join(f'cast({p} as double)' for p in PREDICTORS)}] as x
from top_days where split = 'train'""",
    "test_rows": f"""
select item_nbr, date, units as y, [{', '.join(f'cast({p} as double)' for p in PREDICTORS)}] as x
from top_days where split = 'test'""",
}


def _best_split(rows: str) -> str:
    """The best split of every node found in `rows` (item_nbr, node, x, y, root_risk)."""
    return f"""
  select item_nbr, node, n, s, q, root_risk, feature, cut, gain from (
    select *, row_number() over (partition by item_nbr, node order by ok desc, case when ok then score end desc,
                                 feature, value) as place
    from (
      select *, round(gain / root_risk, 9) as score, (value + next_value) / 2 as cut,
        next_value is not null and n >= 20 and left_n >= 7 and n - left_n >= 7
          and q - s * s / n > 0.0001 * root_risk and round(gain / root_risk, 9) > 0 as ok
      from (
        select *, left_s * left_s / left_n + case when n > left_n then (s - left_s) * (s - left_s) / (n - left_n) end
                  - s * s / n as gain
        from (
          select *, sum(vn) over upto as left_n, sum(vs) over upto as left_s, lead(value) over w as next_value,
            sum(vn) over (partition by item_nbr, node, feature) as n, sum(vs) over (partition by item_nbr, node, feature) as s,
            sum(vq) over (partition by item_nbr, node, feature) as q
          from (select item_nbr, node, feature, x[feature] as value, max(root_risk) as root_risk,
                  count(*) as vn, sum(y) as vs, sum(y * y) as vq
                from (select *, unnest(range(1, {len(PREDICTORS) + 1})) as feature from {rows}) u
                group by item_nbr, node, feature, x[feature]) v
          window w as (partition by item_nbr, node, feature order by value),
            upto as (partition by item_nbr, node, feature order by value rows unbounded preceding)) r) g) o) p
  where place = 1 and ok"""


def _tree_ctes(max_depth: int) -> dict[str, str]:
    labels = "[" + ", ".join(f"'{p}'" for p in PREDICTORS) + "]"
    return {
        "roots": "select item_nbr, avg(y) as centre, count(*) * var_pop(y) as root_risk from fit_rows group by item_nbr",
        "grow(depth, item_nbr, node, x, y, root_risk)": f"""
select 0, f.item_nbr, 1::bigint, x, y - centre, root_risk from fit_rows f join roots using (item_nbr)
union all
select g.depth + 1, g.item_nbr, g.node * 2 + cast(g.x[b.feature] >= b.cut as int), g.x, g.y, g.root_risk
from grow g join ({_best_split('grow')}) b on g.item_nbr = b.item_nbr and g.node = b.node
where g.depth < {max_depth}""",
        "grown": f"""
select a.*, centre + s / n as mean, q - s * s / n as risk, 0.0001 * a.root_risk as price, b.feature, b.cut, b.gain
from (select item_nbr, node, depth, max(root_risk) as root_risk, count(*) as n, sum(y) as s, sum(y * y) as q
      from grow group by item_nbr, node, depth) a join roots using (item_nbr)
left join (select item_nbr, node, feature, cut, gain from ({_best_split(f'(select * from grow where depth < {max_depth})')})) b
  on a.item_nbr = b.item_nbr and a.node = b.node""",
        "weighed(depth, item_nbr, node, cost, as_leaf, is_split)": """
select depth, item_nbr, node, risk + price, risk + price, false from grown where depth = (select max(depth) from grown)
union all
select a.depth, a.item_nbr, a.node, least(a.risk + a.price, coalesce(c.subtree, a.risk + a.price)), a.risk + a.price,
  a.feature is not null
from grown a left join (select item_nbr, node // 2 as node, sum(cost) as subtree from weighed group by item_nbr, node // 2) c
  on a.item_nbr = c.item_nbr and a.node = c.node
where a.depth = (select min(depth) from weighed) - 1""",
        "ends": "select item_nbr, node from weighed where is_split and cost >= as_leaf",
        "kept": f"""
select a.item_nbr, a.node, a.n, a.mean, case when e.node is null then {labels}[a.feature] end as feature,
  case when e.node is null then a.feature end as ask, case when e.node is null then a.cut end as cut,
  case when e.node is null then a.gain end as gain
from grown a left join ends e on a.item_nbr = e.item_nbr and a.node = e.node
where not exists (select 1 from ends u, range(1, 31) r(up)
                  where u.item_nbr = a.item_nbr and u.node = a.node >> cast(up as int) and a.depth >= up)""",
        "walk(item_nbr, date, x, y, node, prediction, ask, cut)": """
select t.item_nbr, t.date, t.x, t.y, k.node, k.mean, k.ask, k.cut from test_rows t join kept k
  on t.item_nbr = k.item_nbr and k.node = 1
union all
select w.item_nbr, w.date, w.x, w.y, k.node, k.mean, k.ask, k.cut from walk w join kept k
  on w.item_nbr = k.item_nbr and k.node = w.node * 2 + cast(w.x[w.ask] >= w.cut as int)
where w.ask is not null""",
        "tree_predicted": "select item_nbr, y, prediction from walk where ask is null",
    }


def _linear_ctes(tolerance: str = "1e-12") -> dict[str, str]:
    size = len(PREDICTORS)
    cells = [(i, j) for i in range(size) for j in range(size + 1)]
    column = [f"x[{i + 1}]" for i in range(size)] + ["y"]
    ctes = {"e0": "select item_nbr, unnest([" + ", ".join(
        f"{{'i': {i}, 'j': {j}, 'v': covar_pop({column[i]}, {column[j]})}}" for i, j in cells)
        + "], recursive := true) from fit_rows group by item_nbr"}
    for k in range(size):
        ctes[f"p{k}"] = f"""
select a.item_nbr, {k} as i, a.v > {tolerance} * o.v and o.v > 0 as ok
from e{k} a join e0 o using (item_nbr, i, j) where i = {k} and j = {k}"""
        ctes[f"e{k + 1}"] = f"""
select a.item_nbr, a.i, a.j, case when not u.ok then a.v when a.i = {k} then a.v / p.v
  else a.v - r.v * c.v / p.v end as v
from e{k} a join p{k} u on u.item_nbr = a.item_nbr
join e{k} p on p.item_nbr = a.item_nbr and p.i = {k} and p.j = {k}
join e{k} r on r.item_nbr = a.item_nbr and r.i = a.i and r.j = {k}
join e{k} c on c.item_nbr = a.item_nbr and c.i = {k} and c.j = a.j"""
    ctes["pivots"] = " union all ".join(f"select * from p{k}" for k in range(size))
    ctes["slopes"] = f"""
select item_nbr, i, case when ok then v end as b from e{size} join pivots using (item_nbr, i) where j = {size}"""
    ctes["linear_models"] = "select item_nbr from pivots group by item_nbr having bool_and(ok)"
    ctes["intercepts"] = """
select m.item_nbr, max(m.y) - coalesce(sum(s.b * m.means[s.i + 1]), 0) as b0 from (
  select item_nbr, avg(y) as y, [""" + ", ".join(f"avg(x[{i + 1}])" for i in range(size)) + """] as means
  from fit_rows group by item_nbr) m join slopes s using (item_nbr) group by m.item_nbr"""
    ctes["linear_predicted"] = """
select t.item_nbr, max(t.y) as y, max(c.b0) + sum(s.b * t.x[s.i + 1]) as prediction
from test_rows t join slopes s using (item_nbr) join intercepts c using (item_nbr)
where t.item_nbr in (select item_nbr from linear_models) group by t.item_nbr, t.date"""
    return ctes


SCORES = """
select item_nbr, '{model}' as model,
  round(case when coalesce(count(y) * var_pop(y), 0) = 0 then 1
             else 1 - sum((y - prediction) ** 2) / (count(y) * var_pop(y)) end, 4) as "R2",
  coalesce(round(sqrt(avg((y - prediction) ** 2)), 4), 'nan'::double) as "RMSE",
  coalesce(round(avg(abs(y - prediction)), 4), 'nan'::double) as "MAE"
from {models} m left join {rows} p using (item_nbr) group by item_nbr"""

SPARSE = {
    "lines": SPARSE_LINES,
    "parts": r"select vec_id, line, string_split_regex(trim(line), '\s+') as p from lines",
    "pairs": """
select vec_id, line, cast(p[1] as double) as risk, unnest(list_filter(p[2:], lambda t: contains(t, ':'))) as token from parts""",
    "long": """
select vec_id, line, risk, cast(split_part(token, ':', 1) as int) as feature_number,
  cast(split_part(token, ':', 2) as double) as value from pairs""",
    "labels_": """
select vec_id, line, cast(p[1] as double) as risk_score, cast(cast(p[1] as double) >= 0.3 as int) as target from parts""",
    "mapping": """
select concat('f', cast(number % 60 as varchar)) as feature_name, number as feature_number
from (select distinct unnest(range(0, len(embedding)))::int as number from embeddings) d""",
    "names": """
select case when (select count(feature_name) > count(distinct feature_name) from mapping)
    then concat(feature_name, '_', cast(feature_number as varchar)) else feature_name end as feature_name, feature_number
from mapping""",
    "ranks": """
select vec_id, target, row_number() over (partition by target order by md5(cast(vec_id as varchar)), vec_id) - 1 as r
from labels_""",
    "sizes": """
select target, count(*) as rows, coalesce(sum(count(*)) over (order by target rows between unbounded preceding and 1 preceding), 0) as start
from labels_ group by target""",
    "fold_sizes": """
select target, i, (start + rows + 4 - i) // 5 - (start + 4 - i) // 5 as size from sizes, range(0, 5) f(i)""",
    "ends_": "select target, i, sum(size) over (partition by target order by i) as until from fold_sizes",
    "folds": """
select r.vec_id, r.target, cast(count(*) filter (where e.until <= r.r) as int) as fold
from ranks r join ends_ e using (target) group by r.vec_id, r.target, r.r""",
    "totals": "select vec_id, sum(value) as total from long group by vec_id",
    "called": f"""
select f.vec_id, f.target, f.fold, cast(coalesce(total, 0) >= {PLAIN_LIMIT} as int) as predicted
from folds f left join totals using (vec_id)""",
    "fold_scores": """
select fold, coalesce(sum(cast(target = 1 and predicted = 1 as int)) / nullif(sum(predicted), 0), 0.0) as precision,
  coalesce(sum(cast(target = 1 and predicted = 1 as int)) / nullif(sum(target), 0), 0.0) as recall
from called group by fold""",
}


MESSY = {
    "lines": MESSY_LINES_SQL,
    "parts": r"select vec_id, string_split_regex(trim(line), '\s+') as w from lines",
    "tokens": """
select vec_id, i, try_cast(split_part(w[i], ':', 1) as int) as feature, try_cast(split_part(w[i], ':', 2) as double) as value
from parts, range(2, 20) r(i) where i <= len(w) and contains(w[i], ':')""",
    "judged": """
select vec_id, try_cast(w[1] as double) as risk, case when w[1] = '' then 'blank'
    when try_cast(w[1] as double) is null then 'bad risk'
    when vec_id in (select vec_id from tokens where feature is null or value is null) then 'bad pair' end as problem
from parts""",
    "cells": """
select vec_id, feature, arg_max(case when isnan(value) then 0 else value end, i) as value
from tokens group by vec_id, feature""",
}


def _wide(names: list[str], extra: str = "") -> str:
    columns = ", ".join(f"coalesce(max(case when feature_number = {i} then value end), 0.0) as {name}"
                        for i, name in enumerate(names))
    return f"""select l.vec_id, {columns}, max(risk_score) as risk_score, max(target) as target
from labels_ l left join long using (vec_id) group by l.vec_id"""


def _profile() -> str:
    numbers = {"units": "double", "store_nbr": "bigint", "item_nbr": "int", "station_nbr": "int", "dewpoint": "int",
               "wetbulb": "int", "stnpressure": "double", "sealevel": "double", "resultspeed": "double",
               "resultdir": "int", "avgspeed": "double"}
    parts = []
    for c in ["date", "store_nbr", "item_nbr", "units", "station_nbr", *READINGS]:
        dtype = numbers.get(c, "date" if c == "date" else "string")
        head = f"""select '{c}' as "column", '{dtype}' as dtype, count(*) as n_rows, count(*) - count({c}) as n_missing,
  count({c}) as non_null, round(1 - (count(*) - count({c})) / count(*), 6) as complete_rate, """
        if c in numbers:
            quartiles = ", ".join(f"cast(quantile_cont({c}, {p}) as double) as {name}" for name, p in
                                  [("p0", 0.0), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p100", 1.0)])
            tail = f"""round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as sd, {quartiles},
  null::bigint as min_length, null::bigint as max_length, null::bigint as empty, null::bigint as n_unique,
  null::bigint as whitespace"""
        else:
            text = f"cast({c} as varchar)"
            tail = f"""null::double as mean, null::double as sd, null::double as p0, null::double as p25,
  null::double as p50, null::double as p75, null::double as p100,
  min(length({text})) as min_length, max(length({text})) as max_length,
  count(*) filter (where {text} = '') as empty, count(distinct {text}) as n_unique,
  count(*) filter (where regexp_full_match({text}, '\\s+')) as whitespace"""
        parts.append(f"{head}{tail} from joined")
    return "\nunion all\n".join(parts)


def _with(ctes: dict[str, str], final: str) -> str:
    parts = ",\n".join(f"{name} as ({body})" for name, body in ctes.items())
    return f"with recursive {parts}\n{final}"


def _sales(final: str, *more: dict[str, str], upto: str | None = None) -> str:
    ctes = {}
    for name, body in INPUTS.items():
        ctes[name] = body
        if name == upto:
            break
    for extra in more:
        ctes |= extra
    return _with(ctes, final)


def _sparse(final: str, *more: dict[str, str]) -> str:
    ctes = SPARSE
    for extra in more:
        ctes = ctes | extra
    return _with(ctes, final)


def _round_ctes(tree: str, rows: str, values: str) -> dict[str, str]:
    """One regression tree of depth 2, fitted to the `rows` (vec_id, r, train) that train: a<tree>_<depth> places all rows,
    b<tree>_<depth> splits nodes. Cuts lie half-way to the next of the feature's `values` (feature, value, next_value)."""
    ctes = {f"a{tree}_0": f"select vec_id, 1::bigint as node, r, train from ({rows})"}
    for depth in (0, 1):
        at, best = f"a{tree}_{depth}", f"b{tree}_{depth}"
        ctes[best] = f"""
select node, feature, cut, gain from (
  select *, row_number() over (partition by node order by round(gain, 10) desc, feature, value) as place from (
    select *, (value + next_value) / 2 as cut,
      (left_s * left_s / left_n + (s - left_s) * (s - left_s) / nullif(n - left_n, 0) - s * s / n) as gain
    from (
      select v.*, next_value, sum(vn) over upto as left_n, sum(vs) over upto as left_s,
        sum(vn) over (partition by node, feature) as n, sum(vs) over (partition by node, feature) as s
      from (select node, feature, value, count(*) as vn, sum(r) as vs from {at} join cells using (vec_id) where train group by all) v
      join {values} using (feature, value)
      window upto as (partition by node, feature order by value rows unbounded preceding)))
  where left_n < n and round(gain, 10) > 0)
where place = 1"""
        ctes[f"a{tree}_{depth + 1}"] = f"""
select a.vec_id, a.node * 2 + cast(c.value > b.cut as int) as node, a.r, a.train
from {at} a join {best} b using (node) join cells c on c.vec_id = a.vec_id and c.feature = b.feature"""
    ctes[f"placed{tree}"] = " union all ".join(f"select * from a{tree}_{d}" for d in range(3))
    ctes[f"nodes{tree}"] = f"""
select p.node, n, mean, feature, cut, gain
from (select node, count(*) as n, avg(r) as mean from placed{tree} where train group by node) p
left join (select * from b{tree}_0 union all select * from b{tree}_1) b on p.node = b.node"""
    ctes[f"said{tree}"] = f"""
select vec_id, arg_max(mean, node) as mean from placed{tree} join nodes{tree} using (node) group by vec_id"""
    return ctes


# Dense cells and labels of -1 and 1.
BOOST = {
    "cells": f"""
select l.vec_id, f.i as feature, coalesce(v.value, 0) as value
from labels_ l cross join range(0, {N_FEATURES}) f(i) left join long v on v.vec_id = l.vec_id and v.feature_number = f.i""",
    "signs": "select vec_id, 2.0::double * target - 1 as y from labels_",
}


def _two_rounds(name: str, train: str, rows: str) -> dict[str, str]:
    """The first tree fits the labels, the second 4y / (1 + exp(2yF)); `rows` has vec_id, y and what `train` needs."""
    values = {f"values{name}": f"""
select feature, value, lead(value) over (partition by feature order by value) as next_value
from (select distinct feature, value from cells join ({rows}) using (vec_id) where {train})"""}
    return (values | _round_ctes(f"{name}1", f"select vec_id, y as r, {train} as train from ({rows})", f"values{name}")
            | _round_ctes(f"{name}2", f"select vec_id, 4 * y / (1 + exp(2 * y * mean)) as r, {train} as train from ({rows}) join said{name}1 using (vec_id)",
                          f"values{name}"))


def _boost_ctes() -> dict[str, str]:
    """Both trees on all rows; the second counts a tenth."""
    return BOOST | _two_rounds("", "true", "select * from signs") | {
        "boosted": "select 0 as tree, * from nodes1 union all select 1 as tree, * from nodes2"}


def _cross_validated_ctes(folds: int = 5) -> dict[str, str]:
    """Every row with the class that the trees fitted without its fold give it."""
    ctes, parts = dict(BOOST), []
    for f in range(folds):
        ctes |= _two_rounds(f"_{f}_", f"fold <> {f}", "select vec_id, y, fold from signs join folds using (vec_id)")
        parts.append(f"""
select vec_id, target, fold, cast(a.mean + 0.1::double * b.mean > 0 as int) as predicted
from folds join said_{f}_1 a using (vec_id) join said_{f}_2 b using (vec_id) where fold = {f}""")
    ctes["cv_called"] = " union all ".join(parts)
    ctes["cv_scores"] = SPARSE["fold_scores"].replace("from called", "from cv_called")
    return ctes


def _daily(place: int, temperature: str) -> str:
    return f"""select date, item_nbr, sum(units) as daily_units_sold, round(avg({temperature}), 4) as avg_tavg
from joined where item_nbr = (select item_nbr from ranked where place = {place}) group by date, item_nbr"""


def _by_flag(rows: str) -> str:
    return "\nunion all\n".join(
        f"""select item_nbr, '{f}' as flag, {f"upper(cast(cast({f} as boolean) as varchar))" if f == FLAGS[0] else f"cast(cast({f} as int) as varchar)"} as flag_value,
  round(avg(units), 4) as avg_units from {rows} group by item_nbr, {f}""" for f in FLAGS[:3])


def oracle_sql() -> dict[str, str]:
    linear, tree, root, boost = _linear_ctes(), _tree_ctes(30), _tree_ctes(1), _boost_ctes()
    linear_scores = SCORES.format(model=LINEAR, models="linear_models", rows="linear_predicted")
    tree_scores = SCORES.format(model=TREE, models="roots", rows="tree_predicted")
    terms = "[" + ", ".join(f"'{TERM_NAMES[p]}'" for p in PREDICTORS) + "]"
    return {
        "table_sizes": " union all ".join(f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in TABLES),
        "top_products": _sales("select item_nbr, total_units_sold from ranked where place <= 3", upto="ranked"),
        "ranked_products": _sales("select item_nbr, total_units_sold, place from ranked", upto="ranked"),
        "nth_top_product": _sales("select item_nbr, total_units_sold from ranked where place = 2", upto="ranked"),
        "sales_weather_join": _sales("select * from joined", upto="joined"),
        "daily_units_and_temp": _sales(_daily(1, "try_cast(tavg as double)"), upto="ranked"),
        "daily_units_placed": _sales(f"select *, row_number() over (order by date) as place from ({_daily(1, 'try_cast(tavg as double)')})", upto="ranked"),
        "daily_units_and_temp_untyped": _sales(_daily(2, "coalesce(try_cast(tavg as double), 0)"), upto="ranked"),
        "clean_precip": _sales("select item_nbr, store_nbr, date, station_nbr, preciptotal, tavg, year, month from clean",
                               upto="clean"),
        "match_counts": _sales("""select n as n_sales, m as n_matched, n - m as n_dropped
from (select count(*) as n from train), (select count(*) as m from joined)""", upto="joined"),
        "station_month_medians": _sales("""select distinct station_nbr, date, preciptotal, tavg,
  p_group as preciptotal_group, p_all as preciptotal_all, t_group as tavg_group, t_all as tavg_all
from medians, overall""", upto="overall"),
        "impute_station_month": _sales(
            "select item_nbr, store_nbr, date, station_nbr, month, preciptotal, tavg from filled", upto="filled"),
        "cap_units_p99": _sales("""select item_nbr, store_nbr, date, units, round(units_capped, 4) as units_capped,
units_was_capped from capped""", upto="capped"),
        "weather_flags": _sales(f"select item_nbr, store_nbr, date, {', '.join(FLAGS)} from filled", upto="filled"),
        "product_day": _sales("select * from days", upto="days"),
        "first_product_days": _sales("select * from days order by item_nbr, date limit 6", upto="days"),
        "profile_joined": _sales(_profile(), upto="joined"),
        "column_listing": _sales(f'select "column", non_null, dtype from ({_profile()})', upto="joined"),
        "split_membership": _sales("select item_nbr, date, split from split_days", upto="split_days"),
        "exact_split_membership": _sales("""select item_nbr, date, case when place <= floor(n * 0.8::double)
  then 'train' else 'test' end as split
from (select item_nbr, date, count(*) over () as n, row_number() over (order by
        substr(md5(concat(cast(item_nbr as varchar), '|', cast(date as varchar))), 1, 15)) as place from days)""",
                                         upto="days"),
        "units_by_flag": _sales(_by_flag("(select * from top_days where split = 'train')"), upto="top_days"),
        "units_by_flag_chosen": _sales(
            _by_flag("(select * from split_days where split = 'train' and item_nbr in (5, 9, 45))"), upto="split_days"),
        "temp_trend": _sales("""select item_nbr, round(regr_slope(units, tavg), 4) as slope,
  round(regr_intercept(units, tavg), 4) as intercept, round(regr_r2(units, tavg), 4) as r2, count(*) as n_days
from top_days where split = 'train' group by item_nbr""", upto="top_days"),
        "ols_coefficients": _sales(f"""select item_nbr, {terms}[i + 1] as variable, round(b, 4) as value from slopes where b is not null
union all select item_nbr, '(Intercept)', round(b0, 4) from intercepts""", linear),
        "ols_metrics": _sales(linear_scores, linear),
        # Few days make predictors depend on each other outright or not at all: the limit here is not the one of the fit.
        "ols_status": _sales("""
select item_nbr, n, case when n_defined = size then 'fitted' when n <= size then 'too few rows' else 'undefined coefficients' end as status, n_defined
from (select item_nbr, count(*) as size, cast(count(*) filter (ok) as int) as n_defined from pivots group by item_nbr)
join (select item_nbr, count(*) as n from fit_rows group by item_nbr) using (item_nbr)""", {"fit_rows": f"""
select item_nbr, units as y, [{', '.join(f'cast({p} as double)' for p in PREDICTORS)}] as x
from days where month(date) = 1 and day(date) <= item_nbr % 8 + 1"""} | _linear_ctes("1e-9"), upto="days"),
        "tree_root_split": _sales("""select item_nbr, n, round(mean, 4) as mean, feature, round(cut, 8) as cut,
  round(gain, 4) as gain from kept where feature is not null""", root),
        "tree_nodes": _sales(
            "select item_nbr, node, n, round(mean, 4) as mean, feature, round(cut, 8) as cut from kept", tree),
        "tree_metrics": _sales(tree_scores, tree),
        "model_comparison": _sales(f"{linear_scores}\nunion all\n{tree_scores}", linear, tree),
        "impact_summary": _sales(f"""select *, row_number() over (order by item_nbr, model, metric_type, abs(value) desc, variable) as place from (
select item_nbr, '{LINEAR}' as model, {terms}[i + 1] as variable,
  'Coefficient' as metric_type, round(b, 4) as value from slopes where b is not null
union all
select item_nbr, '{TREE}', feature, 'Importance', round(sum(gain), 4) from kept
where feature is not null group by item_nbr, feature)""", linear, tree),
        "sparse_long": _sparse("select vec_id, risk, feature_number, value from long"),
        "sparse_wide": _sparse(_wide([f"feature_{i}" for i in range(N_FEATURES)])),
        "text_folder": _sparse("select line, risk, feature_number, value from long"),
        "rejected_lines": r"""
select doc_id, case when t = '' then 'blank' when not regexp_full_match(w[1], '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')
    then 'bad risk' else 'bad pair' end as problem
from (select doc_id, t, string_split_regex(t, '\s+') as w
      from (select doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') as t from documents))
where t = '' or not regexp_full_match(w[1], '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')
  or len(list_filter(w[2:], lambda p: contains(p, ':')
         and not regexp_full_match(p, '[+-]?[0-9]+:[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?(:.*)?'))) > 0""",
        "messy_rejects": _with(MESSY, "select vec_id, problem from judged where problem is not null"),
        "messy_wide": _with(MESSY, "select j.vec_id, " + ", ".join(
            f"coalesce(max(case when feature = {i} then value end), 0.0) as feature_{i}" for i in range(MESSY_FEATURES))
            + """, max(case when isnan(risk) then 0 else risk end) as risk_score,
  max(cast(not isnan(risk) and risk >= 0.3 as int)) as target
from judged j left join cells using (vec_id) where problem is null group by j.vec_id"""),
        "messy_observed": _with(MESSY, "select j.vec_id, " + ", ".join(
            f'coalesce(max(case when feature = {i} then value end), 0.0) as "feature_{i}"' for i in (-1, *range(MESSY_FEATURES - 1), 9))
            + """, max(case when isnan(risk) then 0 else risk end) as risk_score,
  max(cast(not isnan(risk) and risk >= 0.3 as int)) as target
from judged j left join cells using (vec_id) where problem is null group by j.vec_id"""),
        "filled_gaps": _with({"gappy": GAPPY_ORDERS_SQL}, """
select case when price is null or isnan(price) then 0 else price end as price, 0.0::double as o_discount, o_orderkey
from gappy"""),
        "text_days": _with({"gappy": GAPPY_ORDERS_SQL}, """
select o_orderkey, cast(replace(nullif(regexp_extract(day_text,
    '^[0-9]{4}(-[0-9]{1,2}-|/[0-9]{1,2}/)[0-9]{1,2}'), ''), '/', '-') as date) as day from gappy"""),
        "risk_label": _sparse("select vec_id, risk_score, target from labels_"),
        "unique_feature_names": _sparse("select feature_name, feature_number from names"),
        "labelled_features": _sparse(_wide([f"f{i % 60}_{i}" for i in range(N_FEATURES)])),
        "labelled_long": _sparse("""select vec_id, risk, feature_number, value,
  coalesce(feature_name, concat('feature_', cast(feature_number as varchar))) as feature_name
from long left join names using (feature_number)"""),
        "flat_files": _sparse(_wide([f"f{i % 60}_{i}" for i in range(N_FEATURES)])),
        "forced_columns": """select coalesce(o_totalprice, 0) as o_totalprice, 0.0::double as o_discount, o_custkey, o_orderkey
from orders""",
        "stratified_folds": _sparse("select vec_id, target, fold from folds"),
        "hashed_folds": _sparse("""select vec_id, target,
  cast(cast(concat('0x', substr(md5(line), 1, 8)) as bigint) % 5 as int) as fold from labels_"""),
        "fold_precision_recall": _sparse(
            "select fold, round(precision, 4) as precision, round(recall, 4) as recall from fold_scores"),
        "gbt_cv_first_rounds": _sparse(
            "select fold, round(precision, 4) as precision, round(recall, 4) as recall from cv_scores", _cross_validated_ctes()),
        "gbt_first_rounds": _sparse(
            "select tree, node, n, round(mean, 6) as mean, cast(feature as int) as feature, round(cut, 6) as cut from boosted", boost),
        "score_first_rounds": _sparse("""select vec_id, cast(a.mean + 0.1::double * b.mean > 0 as int) as predicted_risk_class
from said1 a join said2 b using (vec_id)""", boost),
        "importance_first_rounds": _sparse("""select feature_name as feature,
  round(coalesce(sum(gain), 0.0) / (select sum(gain) from boosted), 6) as importance
from names left join boosted on feature = feature_number group by feature_name
order by importance desc, feature_name limit 20""", boost),
        "mean_precision_recall": _sparse(
            "select round(avg(precision), 4) as precision, round(avg(recall), 4) as recall from fold_scores"),
    }
