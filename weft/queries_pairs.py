"""Queries of pair features and what follows from them, with SQL that computes each feature from its definition."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft import queries as q
from weft import schemas
from weft.operators import blocking, decide, features
from weft.plans import model as models

#: Of the pairs of a CTE ``todo(x, y)``, strings of up to 60 characters: lengths of longest common subsequences, and ratios.
_LENGTHS = """
spelt as (select distinct x, y, string_split(x, '') as xs, string_split(y, '') as ys from todo where x <> '' and y <> ''),
letters as (select x, map(ks, list_transform(ks, lambda k: list_sum(list_transform(range(1, len(xs) + 1), lambda i: case when xs[i] = k then (1::bigint << (i - 1)::int) else 0 end))::bigint)) as m
  from (select distinct x, xs, list_distinct(xs) as ks from spelt)),
lengths as (select s.x, s.y, len(s.xs) - bit_count(list_reduce(list_transform(s.ys, lambda c: coalesce(l.m[c], 0::bigint)), lambda r, h: (((r + (r & h)) | (r - (r & h))) & ((1::bigint << len(s.xs)::int) - 1)), (1::bigint << len(s.xs)::int) - 1)) as n
  from spelt s join letters l on s.x = l.x),
ratios as (select t.x, t.y, case when t.x = t.y then 100.0::double else 200.0::double * coalesce(n, 0) / (length(t.x) + length(t.y)) end as r from (select distinct x, y from todo) t left join lengths l on t.x = l.x and t.y = l.y)"""

_TOKENS = "list_filter(string_split({0}, ' '), lambda t: t <> '')"
_SORTED = "array_to_string(list_sort(" + _TOKENS + "), ' ')"

#: Windows of the longer string of ``compared(x, y)``: all of the shorter one's length, and shorter ones at the ends.
_WINDOWS = """
sided as (select distinct case when length(x) <= length(y) then x else y end as s, case when length(x) <= length(y) then y else x end as l from compared where x <> '' and y <> ''),
turned as (select s, l, s as a, l as b from sided union select s, l, l, s from sided where length(s) = length(l)),
windows as (select s, l, a, substr(b, greatest(0, e - length(a)) + 1, least(e, length(b)) - greatest(0, e - length(a))) as w from (select *, unnest(range(1, length(a) + length(b))) as e from turned)),
todo as (select distinct a as x, w as y from windows)"""
_PARTIAL = "partials as (select s, l, max(r) as r from windows join ratios on x = a and y = w group by s, l)"


@q.query(f", compared as (select name_a as x, name_b as y from names), {_WINDOWS}, {_LENGTHS}, {_PARTIAL} select x as name_a, y as name_b, round(case when x = '' and y = '' then 100.0 when x = '' or y = '' then 0.0 else r end, 4) as ratio from compared left join partials on s = case when length(x) <= length(y) then x else y end and l = case when length(x) <= length(y) then y else x end", "names")
def partial_ratio(spark, d):
    return q._compared(spark, d, ratio=q.similarity.partial_ratio)


def _token_sets(name: str, one: str, two: str) -> str:
    """CTE of the texts that a token set ratio compares, for pairs ``rec``."""
    return f"""{name}_t as (select *, array_to_string(list_sort(common), ' ') as i, trim(concat(array_to_string(list_sort(common), ' '), ' ', array_to_string(list_sort(da), ' '))) as fa,
    trim(concat(array_to_string(list_sort(common), ' '), ' ', array_to_string(list_sort(db), ' '))) as fb
  from (select {one} as x, {two} as y, list_filter(xs, lambda t: list_contains(ys, t)) as common, list_filter(xs, lambda t: not list_contains(ys, t)) as da, list_filter(ys, lambda t: not list_contains(xs, t)) as db, xs, ys
    from (select distinct {one}, {two}, list_distinct({_TOKENS.format(one)}) as xs, list_distinct({_TOKENS.format(two)}) as ys from rec)))"""


def _set_ratio(name: str) -> str:
    return f"""{name}_r as (select t.x, t.y, case when len(xs) = 0 or len(ys) = 0 then 0.0 when i <> '' and (len(da) = 0 or len(db) = 0) then 100.0 when i = '' then r1.r else greatest(r1.r, r2.r, r3.r) end::double as r
  from {name}_t t left join ratios r1 on r1.x = fa and r1.y = fb left join ratios r2 on r2.x = i and r2.y = fa left join ratios r3 on r3.x = i and r3.y = fb)"""


_JACCARD = "case when len(list_distinct(x)) = 0 or len(list_distinct(y)) = 0 then {empty} else len(list_intersect(x, y)) / (len(list_distinct(x)) + len(list_distinct(y)) - len(list_intersect(x, y))) end"
_RECORDS = """rec as (select p.a_id, p.b_id, p.sim_name, p.sim_addr, a.country, a.name_core as na, b.name_core as nb, a.name_compact as ca, b.name_compact as cb, a.name_norm as fna, b.name_norm as fnb,
    a.addr_norm as aa, b.addr_norm as ab, a.addr_nums as ua, b.addr_nums as ub, a.house_no as ha, b.house_no as hb, a.state as sa, b.state as sb, a.amb_name, a.amb_addr, a.name_uniq_state,
    (b.name_script <> 'latin')::int::double as b_nonlatin, b.name_domain::double as b_domain, b.addr_missing::double as b_addr_missing
  from blocked p join (select *, (count(*) over (partition by country, name_core))::double as amb_name, case when addr_norm = '' then 0.0 else count(*) over (partition by country, addr_norm, house_no) end::double as amb_addr,
    (count(*) over (partition by country, state, name_compact))::double as name_uniq_state from side_a) a on a.entity_id = p.a_id join side_b b on b.entity_id = p.b_id)"""
_BLOCKED = f"blocked as (select a_id, b_id, max(n)::double as sim_name, max(x)::double as sim_addr from (select a_id, b_id, sim as n, 0.0 as x from ({q._KEPT('name', blocking.NAME)}) union all select a_id, b_id, 0.0, sim from ({q._KEPT('addr', blocking.ADDRESS)})) group by a_id, b_id)"
_SIMS = {"n_ratio": ("na", "nb"), "n_cmp_ratio": ("ca", "cb"), "n_full_ratio": ("fna", "fnb"), "a_ratio": ("aa", "ab"), "house": ("ha", "hb")}
_SORTS = {"n_tsort": ("na", "nb"), "a_tsort": ("aa", "ab")}
_BOTH_WAYS = "case when length({0}) <= length({1}) then {0} else {1} end"


def _pairs_sql() -> str:
    """CTEs up to ``pairwise``: each pair with its context and its 25 similarities."""
    todo = [f"select {a} as x, {b} as y from rec" for a, b in _SIMS.values()]
    todo += [f"select {_SORTED.format(a)}, {_SORTED.format(b)} from rec" for a, b in _SORTS.values()]
    todo += [f"select fa, fb from {n}_t union select i, fa from {n}_t union select i, fb from {n}_t" for n in ("nset", "aset")]
    windows = _WINDOWS.replace("todo as (select distinct a as x, w as y from windows)", f"todo as (select distinct a as x, w as y from windows union {' union '.join(todo)})")
    joins = [f"left join ratios {n} on {n}.x = {a} and {n}.y = {b}" for n, (a, b) in _SIMS.items()]
    joins += [f"left join ratios {n} on {n}.x = {_SORTED.format(a)} and {n}.y = {_SORTED.format(b)}" for n, (a, b) in _SORTS.items()]
    joins += [f"left join {n}_r {n} on {n}.x = {a} and {n}.y = {b}" for n, a, b in (("nset", "na", "nb"), ("aset", "aa", "ab"))]
    joins += [f"left join partials {n} on {n}.s = {_BOTH_WAYS.format(a, b)} and {n}.l = case when length({a}) <= length({b}) then {b} else {a} end" for n, a, b in (("npart", "na", "nb"), ("apart", "aa", "ab"))]
    full = lambda x, a, b: f"case when {a} = '' and {b} = '' then 100.0 when {a} = '' or {b} = '' then 0.0 else {x} end"
    address = lambda x: f"case when aa = '' or ab = '' then -1.0 else {x} end::double"
    jaccard = lambda a, b, empty: f"(select {_JACCARD.format(empty=empty)} from (select {_TOKENS.format(a)} as x, {_TOKENS.format(b)} as y))::double"
    equal = lambda a, b: f"case when {a} = '' or {b} = '' then 0.0 when {a} = {b} then 1.0 else -1.0 end::double"
    columns = {
        "n_ratio": "n_ratio.r", "n_tsr": "nset.r", "n_tsort": "n_tsort.r", "n_partial": full("npart.r", "na", "nb"), "n_cmp_ratio": "n_cmp_ratio.r", "n_jw": "100 * jaro_winkler_similarity(ca, cb)",
        "n_jacc": jaccard("na", "nb", "0.0"), "n_full_ratio": "n_full_ratio.r", "n_first_eq": f"({_TOKENS.format('na')}[1] = {_TOKENS.format('nb')}[1])::int::double", "n_len_a": f"len({_TOKENS.format('na')})::double", "n_len_b": f"len({_TOKENS.format('nb')})::double",
        "n_prefix": "(ca <> '' and cb <> '' and (starts_with(ca, cb) or starts_with(cb, ca)))::int::double", "n_cmp_eq": "(ca <> '' and ca = cb)::int::double",
        "a_ratio": address("a_ratio.r"), "a_tsr": address("aset.r"), "a_tsort": address("a_tsort.r"), "a_partial": address(full("apart.r", "aa", "ab")), "a_jacc": jaccard("aa", "ab", "-1.0"), "a_num_jacc": jaccard("ua", "ub", "-1.0"),
        "a_num_inter": f"len(list_intersect({_TOKENS.format('ua')}, {_TOKENS.format('ub')}))::double", "a_len_a": f"len({_TOKENS.format('aa')})::double", "a_len_b": f"len({_TOKENS.format('ab')})::double",
        "house_rel": equal("ha", "hb"), "house_ratio": "case when ha = '' or hb = '' then -1.0 else house.r end::double", "state_rel": equal("sa", "sb"),
    }
    assert list(columns) == schemas.PAIR_FEATURES
    context = ", ".join(f"rec.{c}" for c in ("a_id", "b_id", "country", *schemas.CONTEXT_FEATURES, "name_uniq_state"))
    return f"""{_BLOCKED}, {_RECORDS}, compared as (select na as x, nb as y from rec union select aa, ab from rec), {_token_sets("nset", "na", "nb")}, {_token_sets("aset", "aa", "ab")}, {windows}, {_LENGTHS}, {_PARTIAL}, {_set_ratio("nset")}, {_set_ratio("aset")},
pairwise as (select {context}, {", ".join(f"{sql} as {c}" for c, sql in columns.items())} from rec {" ".join(joins)})"""


def _group_sql() -> str:
    """CTE ``featured``: how each pair stands among those of its A and of its B."""
    number = lambda condition, by: f"(count(*) filter ({condition}) {by})::double"
    house, name = "house_rel = 1", "n_cmp_eq = 1"
    columns = {"n_cands": f"(count(*) {q._A})::double", "b_deg": f"(count(*) {q._B})::double", "n_hi_name": number("n_tsr >= 90", q._A), "n_hi_addr": number("a_tsr >= 90", q._A), "n_house_eq": number(house, q._A), "n_name_eq": number(name, q._A)}
    columns |= {"n_both_eq": number(f"{house} and {name}", q._A), "b_name_eq_cnt": number(name, q._B), "b_house_eq_cnt": number(house, q._B)}
    for value, key, by, prefix in (("n_tsr", "a_id", q._A, "n_tsr"), ("a_tsr", "a_id", q._A, "a_tsr"), ("combo", "a_id", q._A, "combo"), ("combo", "b_id", q._B, "b_combo")):
        columns |= {f"{prefix}_max": f"max({value}) {by}", f"{prefix}_rank": f"(rank() over (partition by {key} order by {value} desc))::double", f"{prefix}_gap": f"max({value}) {by} - {value}"}
    columns["twin_better"] = f"case when house_rel = -1 and count(*) filter ({house} and {name}) {q._A} > 0 then 1.0 else 0.0 end::double"
    combo = "select *, greatest(least(n_tsr, 100.0::double), 0.0::double) / 2 + greatest(least(a_tsr, 100.0::double), 0.0::double) / 2 as combo from pairwise"
    return f"featured as (select *, {', '.join(f'{sql} as {c}' for c, sql in columns.items())} from ({combo}))"


_FEATURED = f"{_pairs_sql()}, {_group_sql()}"


def _rounded(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 4) + 0.0 as {c}" for c in columns)


@q.query(q._retrieval(f"select a_id, b_id, country, sim_name, sim_addr, {_rounded(schemas.FEATURES[2:])} from featured", "name", "addr").replace("\nselect", f", {_FEATURED}\nselect"), "side_a", "side_b")
def pair_features(spark, d):
    pairs = blocking.candidate_pairs(q.view(spark, d, "side_a"), q.view(spark, d, "side_b"))
    found = features.pair_features(pairs, q.view(spark, d, "side_a"), q.view(spark, d, "side_b"))
    return found.select("a_id", "b_id", "country", "sim_name", "sim_addr", *((F.round(c, 4) + F.lit(0.0)).alias(c) for c in schemas.FEATURES[2:]))


_LINKED = "linked as (select a_id, b_id, p, g from (select *, row_number() over (partition by b_id order by p desc, a_id) as k from (select *, (combo / 100 + sim_addr) / 2 as p, 4 * (b_addr_missing > 0)::int + 2 * (amb_name > 1)::int + (n_cands <= 1)::int as g from featured) where p >= 0.5) where k = 1)"


def _link_sql(select: str) -> str:
    return q._retrieval(select, "name", "addr").replace(f"\n{select}", f", {_FEATURED}, {_LINKED}\n{select}")


@q.query(_link_sql("select a_id, b_id, round(p, 6) as p, g from linked"), "side_a", "side_b")
def entry_link(spark, d):
    """Retrieval, comparison and one-to-one decision over suppliers and customers; a fixed score stands for a model."""
    a, b = q.view(spark, d, "side_a"), q.view(spark, d, "side_b")
    rows = features.pair_features(blocking.candidate_pairs(a, b), a, b)
    p = (F.col("combo") / 100 + F.col("sim_addr")) / 2
    return decide.decided(models.with_group(rows.withColumn("p", p)), 0.5).select("a_id", "b_id", F.round("p", 6).alias("p"), "g")


@q.query(_link_sql("select e.a_id as source1_entity_id, coalesce(string_agg(l.b_id, ',' order by l.b_id), '') as matched_entity_ids from entities e left join linked l using (a_id) group by e.a_id"), "side_a", "side_b", "entities")
def linked_lists(spark, d):
    return decide.match_lists(entry_link(spark, d), q.view(spark, d, "entities"))
