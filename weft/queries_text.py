"""Queries of the normaliser over names and addresses made up from customers. Each customer gets one of several shapes by
its key; the SQL spells out what the shape must become."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft import queries as q
from weft import schemas
from weft.functions import similarity, text
from weft.operators import dictionary

#: A word and a number of each customer; the word never is in a table of the normaliser, the number has three digits or more.
_BASE = "(select c_custkey, c_custkey + 101 as k, replace(lower(r_name), ' ', '') as w, upper(replace(r_name, ' ', '')) as u from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"

#: Raw address, its country, and what must come of it: words, numbers, house number, state.
ADDRESSES = [
    ("concat(k, ' North ', u, ' Street, Apt B', k, ', Dallas, TX')", "US", "concat('n ', w, ' st dallas')", "concat(k, ' b', k)", "k", "TX"),
    ("concat(k, 'th ', u, ' Ave, Washington, DC')", "US", "concat(w, ' ave washington')", "k", "k", "DC"),
    ("concat(k, '/b ', u, ' Road, Pune, Maharashtra')", "India", "concat(w, ' rd pune')", "concat(k, '/b')", "concat(k, '/b')", "MH"),
    ("concat('Flat No 7-', k, ', ', u, ' Nagar, महाराष्ट्र')", "India", "concat(w, ' ngr')", "concat('7-', k)", "''", "MH"),
    ("concat('<NULL>, ', k, ' ', u, ' Lane, NA')", "US", "concat(w, ' ln')", "k", "k", ""),
    ("concat('PO Box ', k, ', ', u, ', CA 9', k)", "US", "concat(w, ' ca')", "concat(k, ' 9', k)", "concat('9', k)", ""),
    ("concat('75', k, ', ', k, ' Rue de ', u, ', Bretagne')", "France", "concat('rue ', w)", "concat('75', k, ' ', k)", "k", "BRE"),
    ("concat(k, ' Allée de l''Église ', u, ', Île-de-France')", "France", "concat('all leglise ', w)", "k", "k", "IDF"),
    ("concat(k, ' GrandÂ Rue ', u)", "France", "concat('grand rue ', w)", "k", "k", ""),
    ("concat('Fifth ', u, ' Avenue, ', k, ' Third Square')", "US", "concat(w, ' ave sq')", "concat('5 ', k, ' 3')", "'5'", ""),
    ("concat(k, ' ', u, ' ', u, ' Road, ', u, ' Road, ', k)", "US", "concat(w, ' rd')", "k", "k", ""),
    ("concat('# ', k, ' ', u, ' Highway, Austin, Texas')", "US", "concat(w, ' hwy austin')", "k", "k", "TX"),
    ("concat(k, '-A/', u, ', Block C-', k)", "India", "'block'", "concat(k, '-a/', w, ' c-', k)", "concat(k, '-a/', w)", ""),
    ("''", "US", "''", "''", "''", ""),
    ("concat('00', k, ' ', u, ' Blvd.')", "US", "concat(w, ' blvd')", "k", "k", ""),
    ("concat(k, ' ', u, ' & Sons Road, Plot O''Neill')", "US", "concat(w, ' sons rd oneill')", "k", "k", ""),
    ("concat('Suite ', k, ', N° ', k, ' ', u, ' Court, New York')", "US", "concat(w, ' ct')", "k", "k", "NY"),
    ("concat('शॉप ', k, ' ', u, ', दिल्ली')", "India", "concat('shp ', w)", "k", "k", "DL"),
]

#: Raw name, and what must come of it: normalised, core, script, whether it is a domain.
NAMES = [
    ("concat(u, ' Construction LLC')", "concat(w, ' construction llc')", "concat(w, ' construction')", "latin", 0),
    ("concat('www.', w, '-', k, '.com')", "concat(w, ' ', k)", "concat(w, ' ', k)", "latin", 1),
    ("concat(u, ' f/k/a Jones Inc')", "concat(w, ' jones inc')", "concat(w, ' jones')", "latin", 0),
    ("concat('A.B.C. ', u, ' L.L.C.')", "concat('abc ', w, ' llc')", "concat('abc ', w)", "latin", 0),
    ("concat(u, '1a0 Trad3rs ', k)", "concat(w, 'lao trad3rs ', k)", "concat(w, 'lao trad3rs ', k)", "latin", 0),
    ("concat(u, ' & Söhne GmbH + Co @ Home')", "concat(w, ' and sohne gmbh plus co at home')", "concat(w, ' and sohne plus at home')", "latin", 0),
    ("'The Company'", "'the company'", "'the company'", "latin", 0),
    ("concat('Émile ', u, '''s Café')", "concat('emile ', w, 's cafe')", "concat('emile ', w, 's cafe')", "latin", 0),
    ("concat(u, ' dba Aka formerly ', k)", "concat(w, ' ', k)", "concat(w, ' ', k)", "latin", 0),
    ("concat('राम ', u)", "concat('ram ', w)", "concat('ram ', w)", "DEVANAGARI", 0),
    ("concat('Ωmega ', u)", "concat('mega ', w)", "concat('mega ', w)", "GREEK", 0),
    ("concat('শ্রী ', u)", "concat('shrii ', w)", "concat('shrii ', w)", "BENGALI", 0),
    ("concat('१२ ', u)", "concat('12 ', w)", "concat('12 ', w)", "latin", 0),
    ("''", "''", "''", "latin", 0),
    ("concat(u, 'Â Shop')", "concat(w, ' shop')", "concat(w, ' shop')", "latin", 0),
    ("concat('Straße Ægir ', u)", "concat('strasse aegir ', w)", "concat('strasse aegir ', w)", "latin", 0),
]


def _shaped(column: int, shapes: list[tuple]) -> str:
    """The column of a customer's shape, as text."""
    cases = " ".join(f"when {k} then concat('', {x})" for k, x in enumerate(s[column] for s in shapes))
    return f"case c_custkey % {len(shapes)} {cases} end"


def _fixed(column: int, shapes: list[tuple]) -> str:
    return f"case c_custkey % {len(shapes)} {' '.join(f'''when {k} then {s[column]!r}''' for k, s in enumerate(shapes))} end"


def _raw(spark, d, name: str, address: str, country: str):
    tables = {t: q.table(spark, d, t) for t in ("customer", "nation", "region")}
    base = _BASE
    for t in tables:
        base = base.replace(f"from {t} ", f"from {{{t}}} as {t} ").replace(f"join {t} ", f"join {{{t}}} as {t} ")
    return spark.sql(f"select concat('S2-', c_custkey) as entity_id, {name} as business_name, {address} as business_address, {country} as country from {base}", **tables)


@q.query(f"select concat('S2-', c_custkey) as entity_id, {_shaped(2, ADDRESSES)} as addr_norm, {_shaped(3, ADDRESSES)} as addr_nums, {_shaped(4, ADDRESSES)} as house_no, {_fixed(5, ADDRESSES)} as state, (c_custkey % {len(ADDRESSES)} = 13)::int as addr_missing, {_fixed(1, ADDRESSES)} as country from {_BASE}")
def normalised_addresses(spark, d):
    raw = _raw(spark, d, "''", _shaped(0, ADDRESSES), _fixed(1, ADDRESSES))
    return text.normalised(raw).select("entity_id", "addr_norm", "addr_nums", "house_no", "state", F.col("addr_missing").cast("int").alias("addr_missing"), "country")


@q.query(f"select concat('S2-', c_custkey) as entity_id, {_shaped(1, NAMES)} as name_norm, {_shaped(2, NAMES)} as name_core, replace({_shaped(2, NAMES)}, ' ', '') as name_compact, {_fixed(3, NAMES)} as name_script, {_fixed(4, NAMES)} as name_domain from {_BASE}")
def normalised_names(spark, d):
    raw = _raw(spark, d, _shaped(0, NAMES), "''", "'US'")
    found = text.normalised(raw, {"राम": "ram"})
    return found.select("entity_id", "name_norm", "name_core", "name_compact", "name_script", F.col("name_domain").cast("int").alias("name_domain"))


@q.query(f"select concat('S2-', c_custkey) as entity_id, {_fixed(1, ADDRESSES)} as country, 'latin' as name_script, concat(w, ' ', k) as name_norm, {_shaped(2, ADDRESSES)} as addr_norm, {_fixed(5, ADDRESSES)} as state from {_BASE}")
def normalised_records(spark, d):
    """Whole records: name and address of one row."""
    raw = _raw(spark, d, "concat(u, ' ', k)", _shaped(0, ADDRESSES), _fixed(1, ADDRESSES))
    return text.normalised(raw).select("entity_id", "country", "name_script", "name_norm", "addr_norm", "state")


@q.query(f"select c_custkey, case when c_custkey % 2 = 0 then case when c_custkey % 4 = 0 then 'TX' else '' end else case when c_custkey % 4 = 1 then 'TX' else '' end end as strict, case c_custkey % 4 when 0 then 'TX' when 1 then 'TX' when 2 then 'TX' else 'GA' end as loose from {_BASE}")
def state_codes(spark, d):
    """Codes of one country in addresses of another count unless countries are held apart."""
    raw = q.table(spark, d, "customer").select("c_custkey", F.expr("case c_custkey % 4 when 0 then '1 Elm, TX' when 1 then '1 Elm, Texas' when 2 then '1 Elm, TX' else '1 Elm, GA' end").alias("business_address"), F.expr("case c_custkey % 4 when 0 then 'US' when 1 then 'US' when 2 then 'France' else 'France' end").alias("country"))
    raw = raw.select(F.col("c_custkey").cast("string").alias("entity_id"), F.lit("").alias("business_name"), "business_address", "country")
    states = lambda strict, name: text.normalised(raw, strict_country=strict).select(F.col("entity_id").cast("long").alias("c_custkey"), F.col("state").alias(name))
    return states(True, "strict").join(states(False, "loose"), "c_custkey")


_SCRIPTS = "case c_custkey % 5 when 0 then concat('राम ', c_name) when 1 then concat(c_name, ' Ωmega') when 2 then concat('é', c_name) when 3 then concat('தமிழ் ', c_name) else c_name end"


@q.query("select c_custkey, case c_custkey % 5 when 0 then 'DEVANAGARI' when 1 then 'GREEK' when 3 then 'TAMIL' else 'latin' end as script from customer")
def script_of_text(spark, d):
    return q.table(spark, d, "customer").select("c_custkey", text.script_column(F.expr(_SCRIPTS)).alias("script"))


@q.query(f"select c_custkey, [w, 'and', 's', cast(k as varchar)] as latin, case when c_custkey % 2 = 0 then ['राम', 'शॉप'] else [] end as native from {_BASE}")
def name_words(spark, d):
    """Words of both sides of a pair of names, from which spellings are learnt."""
    rows = _raw(spark, d, "concat(u, ' & ''s\t', k, '.')", "concat(case when c_custkey % 2 = 0 then 'राम-शॉप ' else '' end, u, '!')", "cast(c_custkey as string)")
    pairs = rows.select(F.col("business_name").alias("latin_name"), F.col("business_address").alias("native_name"))
    found = dictionary.tokenised(pairs.withColumn("native_name", F.col("native_name")))
    keys = F.element_at("latin", -1).cast("long") - 101
    return found.select(keys.alias("c_custkey"), "latin", "native")


_STRINGS = """select distinct name_a, name_b, name_a as na, name_b as nb, replace(name_a, ' ', '') as ca, case when length(name_a) % 3 = 0 then replace(name_a, ' ', '') else replace(name_b, ' ', '') end as cb, upper(name_a) as fna, upper(name_b) as fnb,
  case when length(name_a) % 4 = 0 then '' else concat(name_a, ' road') end as aa, case when length(name_b) % 4 = 0 then '' else concat('old ', name_b) end as ab,
  concat('', length(name_a), ' ', length(name_b)) as ua, concat('', length(name_b)) as ub, case when length(name_a) % 2 = 0 then concat('', length(name_a)) else '' end as ha, concat('', length(name_b)) as hb,
  substr(name_a, 1, 1) as sa, case when length(name_b) % 5 = 0 then '' else substr(name_b, 1, 1) end as sb from names"""
_SIDES = {"name_core": "n", "name_compact": "c", "name_norm": "fn", "addr_norm": "a", "addr_nums": "u", "house_no": "h", "state": "s"}


def _string_sql() -> str:
    from weft import queries_pairs as pairs

    nothing = ", ".join(f"0.0::double as {c}" for c in (*schemas.CONTEXT_FEATURES, "name_uniq_state"))
    rec = f"rec as (select name_a as a_id, name_b as b_id, '' as country, {nothing}, * exclude (name_a, name_b) from ({_STRINGS}))"
    ctes = pairs._pairs_sql().replace(f"{pairs._BLOCKED}, {pairs._RECORDS}", rec)
    return f", {ctes} select a_id as name_a, b_id as name_b, {pairs._rounded(schemas.PAIR_FEATURES)} from pairwise"


@q.query(_string_sql(), "names")
def string_features(spark, d):
    """The 25 similarities over part names, of which some are equal, prefixes of each other, or missing."""
    names = q.view(spark, d, "names")
    rows = spark.sql(_STRINGS.replace("from names", "from {names}"), names=names)
    rows = rows.select("name_a", "name_b", *(F.col(f"{short}{s}").alias(f"{c}_{s}") for c, short in _SIDES.items() for s in "ab"))
    return similarity.with_pair_features(rows).select("name_a", "name_b", *((F.round(c, 4) + F.lit(0.0)).alias(c) for c in schemas.PAIR_FEATURES))
