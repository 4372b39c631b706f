"""Operators on the benchmark tables: assets are users or customers, instants are event times."""

from __future__ import annotations

from pyspark.sql import functions as F

from gustledger.functions import columns as C
from gustledger.operators import (
    cleaning,
    completeness,
    contract,
    distribution,
    duplicates,
    joins,
    keys,
    profile,
)
from gustledger.plans import analytics, medallion
from gustledger.plans import domain as D
from gustledger.queries.registry import exact, folder, query, rounded, table
from gustledger.session import stage
from gustledger.sources import files, sinks
from gustledger.sources.snapshots import Store

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


# --- generation ---------------------------------------------------------------------------

def _event_facts(spark, d, *more):
    value, kind = F.col("value"), F.col("event_type")
    return table(spark, d, "events").select(
        F.col("user_id").alias("spe"),
        F.col("ts").alias("din_instante"),
        value.alias("val_geracaoverificada"),
        F.when(kind == "error", value).alias("val_geracaoestimada"),
        C.soft_drop(value, 0, 40, kind == "error").alias("val_ventoverificado"),
        *more,
    )


def _order_facts(spark, d):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("spe"),
        F.col("o_orderdate").alias("din_instante"),
        price.alias("val_geracaoverificada"),
        F.when(status == "F", price).alias("val_geracaoestimada"),
        F.when(status == "P", price).alias("val_ventoverificado"),
    )


def _customer_assets(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("spe"),
        F.col("c_mktsegment").alias("projeto_cv"),
        F.col("c_nationkey").alias("id_ons_conjunto"),
    )


def _generation_sql(period: str, facts: str, where: str = "TRUE") -> str:
    energy = {c: rounded(f"SUM({exact(c)} * 0.5)", 2) for c in ("verified", "estimated")}
    wind = rounded(f"CAST(SUM({exact('wind')}) AS DOUBLE) / NULLIF(COUNT(wind), 0)", 2)
    return f"""
        SELECT {period} AS periodo,
               {energy['verified']} AS total_mwh_verificado,
               {energy['estimated']} AS total_mwh_estimado,
               {wind} AS vento_medio_ms,
               COUNT(DISTINCT spe) AS qtd_spes_ativas
        FROM ({facts}) f JOIN customer c ON f.spe = c.c_custkey
        WHERE c.c_mktsegment = 'BUILDING' AND {where}
        GROUP BY 1 ORDER BY 1"""


_EVENT_FACTS = """
    SELECT user_id AS spe, ts AS din, value AS verified,
           CASE WHEN event_type = 'error' THEN value END AS estimated,
           CASE WHEN value BETWEEN 0 AND 40 AND event_type <> 'error' THEN value END AS wind
    FROM events"""

_ORDER_FACTS = """
    SELECT o_custkey AS spe, o_orderdate AS din, o_totalprice AS verified,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS estimated,
           CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS wind
    FROM orders"""


@query("generation_daily", _generation_sql("CAST(din AS DATE)", _EVENT_FACTS))
def generation_daily(spark, d):
    return analytics.generation(_event_facts(spark, d), _customer_assets(spark, d), "BUILDING")


@query(
    "generation_daily_range",
    _generation_sql(
        "CAST(din AS DATE)",
        _ORDER_FACTS,
        "din >= TIMESTAMP '1996-03-01' AND din <= TIMESTAMP '1997-03-01'",
    ),
)
def generation_daily_range(spark, d):
    return analytics.generation(
        _order_facts(spark, d), _customer_assets(spark, d), "BUILDING", C.DAILY, "1996-03-01", "1997-03-01"
    )


@query("generation_monthly", _generation_sql("DATE_TRUNC('month', din)", _ORDER_FACTS))
def generation_monthly(spark, d):
    return analytics.generation(_order_facts(spark, d), _customer_assets(spark, d), "BUILDING", C.MONTHLY)


# --- projects and restrictions --------------------------------------------------------------

@query(
    "projects",
    """
    SELECT c_mktsegment AS id_projeto, n_name AS nome_conjunto, r_name AS subsistema,
           CAST(n_regionkey AS VARCHAR) AS estado, COUNT(c_custkey) AS qtd_spes
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2, 3, 4 ORDER BY 1""",
)
def projects(spark, d):
    nation = table(spark, d, "nation")
    groups = nation.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("id_ons_conjunto"),
        F.col("n_name").alias("nom_conjunto"),
        F.col("r_name").alias("nom_subsistema"),
        F.col("n_regionkey").cast("string").alias("id_estado"),
    )
    return analytics.projects(_customer_assets(spark, d), groups)


# The code table of these queries: one pair is unused, and the low priority has no text.
_CODES = [
    (status, priority, f"{status} {priority}")
    for status in ("F", "O", "X")
    for priority in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
]


def _restrictions(spark, d, **options):
    price = F.col("o_totalprice")
    facts = table(spark, d, "orders").select(
        F.col("o_custkey").alias("id_ons_conjunto"),
        F.col("o_orderdate").alias("din_instante"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("cod_razaorestricao"),
        F.col("o_orderpriority").alias("cod_origemrestricao"),
        F.concat(F.lit("own "), "o_orderpriority").alias("dsc_restricao"),
        F.when(F.col("o_orderpriority") != "2-HIGH", price).alias("val_geracaoreferenciafinal"),
        (price * 0.5).alias("val_geracaoreferencia"),
        F.when(F.col("o_orderpriority") != "1-URGENT", price * 0.75).alias("val_geracaolimitada"),
    )
    customer = table(spark, d, "customer")
    groups = customer.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id_ons_conjunto"), F.col("n_name").alias("nom_conjunto")
    )
    assets = customer.select(
        F.col("c_custkey").alias("id_ons_conjunto"), F.col("c_mktsegment").alias("projeto_cv")
    )
    codes = files.constants(
        spark, _CODES, "cod_razaorestricao string, cod_origemrestricao string, dsc_restricao_completa string"
    )
    return analytics.restrictions(facts, groups, assets, codes, **options)


def _restrictions_sql(where: str = "TRUE") -> str:
    values = ", ".join(f"('{s}', '{p}', '{t}')" for s, p, t in _CODES)
    return f"""
        WITH f AS (
            SELECT o_custkey AS g, o_orderdate AS din,
                   CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS reason,
                   o_orderpriority AS origin, 'own ' || o_orderpriority AS own,
                   {exact("COALESCE(CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice END, o_totalprice * 0.5)")}
                 - {exact("CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice * 0.75 END")} AS cut
            FROM orders),
        codes(reason, origin, txt) AS (VALUES {values})
        SELECT c_mktsegment AS projeto, n_name AS nome_conjunto, f.reason AS razao_restricao,
               f.origin AS origem, COALESCE(MIN(txt), MIN(own)) AS descricao,
               {rounded("COUNT(*) * 0.5", 1)} AS total_horas_com_restricao,
               {rounded("SUM(cut)", 2)} AS total_mwh_cortado,
               {rounded("SUM(cut) * 0.5", 2)} AS energia_cortada_mwh
        FROM f JOIN customer ON g = c_custkey JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN codes ON f.reason = codes.reason AND f.origin = codes.origin
        WHERE f.reason IS NOT NULL AND {where}
        GROUP BY 1, 2, 3, 4 ORDER BY total_mwh_cortado DESC NULLS LAST"""


@query("restrictions_summary", _restrictions_sql())
def restrictions_summary(spark, d):
    return _restrictions(spark, d)


@query("restrictions_project", _restrictions_sql("c_mktsegment = 'BUILDING'"))
def restrictions_project(spark, d):
    return _restrictions(spark, d, project="BUILDING")


@query(
    "restrictions_range",
    _restrictions_sql("din >= TIMESTAMP '1997-01-01' AND din <= TIMESTAMP '1999-06-30'"),
)
def restrictions_range(spark, d):
    return _restrictions(spark, d, start="1997-01-01", end="1999-06-30")


# --- joins ----------------------------------------------------------------------------------

@query(
    "regex_key_join",
    r"""
    SELECT c_custkey, c_name, s_suppkey
    FROM customer JOIN (SELECT s_suppkey, regexp_extract(s_name, '\d{9}') AS code FROM supplier)
      ON regexp_extract(c_name, '\d{9}') = code""",
)
def regex_key_join(spark, d):
    registry = table(spark, d, "supplier").select(
        "s_suppkey", C.embedded_key(F.col("s_name"), r"\d{9}").alias("code")
    )
    facts = table(spark, d, "customer").select("c_custkey", "c_name")
    return joins.embedded_key_join(facts, registry, "c_name", "code", r"\d{9}")


@query(
    "semi_filter",
    """
    SELECT c_custkey, c_nationkey FROM customer
    WHERE UPPER('Nation ' || c_nationkey) IN
          (SELECT DISTINCT UPPER('NATION ' || s_nationkey) FROM supplier WHERE s_acctbal < 0)""",
)
def semi_filter(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, d, "supplier").filter(F.col("s_acctbal") < 0)
    return joins.semi_filter(
        customers,
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")),
        suppliers,
        F.concat(F.lit("NATION "), F.col("s_nationkey").cast("string")),
    )


@query(
    "ci_left_join",
    """
    SELECT e.event_id, e.event_type, e.hour, r.n
    FROM (SELECT event_id, event_type, DATE_TRUNC('hour', ts) AS hour,
                 UPPER(CASE WHEN event_type = 'click' THEN 'Grp ' || user_id ELSE 'usr ' || user_id END) AS k
          FROM events) e
    LEFT JOIN (SELECT UPPER('Usr ' || user_id) AS k, DATE_TRUNC('hour', ts) AS hour, COUNT(*) AS n
               FROM events WHERE event_type IN ('click', 'error') GROUP BY 1, 2) r
      ON e.k = r.k AND e.hour = r.hour""",
)
def ci_left_join(spark, d):
    user = F.col("user_id").cast("string")
    events = table(spark, d, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    hourly = (
        events.filter(F.col("event_type").isin("click", "error"))
        .groupBy(F.concat(F.lit("Usr "), user).alias("name"), "hour")
        .agg(F.count("*").alias("n"))
    )
    name = C.choose_key(
        F.col("event_type"), "click", F.concat(F.lit("Grp "), user), F.concat(F.lit("usr "), user)
    )
    left = events.select("event_id", "event_type", "hour", name.alias("name_left"))
    return joins.case_insensitive_left_join(left, hourly, F.col("name_left"), F.col("name"), ["hour"]).select(
        "event_id", "event_type", "hour", "n"
    )


@query(
    "key_difference",
    """
    SELECT event_id, event_type FROM events e
    WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.event_type = 'error'
                      AND x.user_id = e.user_id AND CAST(x.ts AS DATE) = CAST(e.ts AS DATE))""",
)
def key_difference(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type", "user_id", F.to_date("ts").alias("day"))
    bad = stage(events.filter(F.col("event_type") == "error").select("user_id", "day").distinct(), "bad_keys")
    return joins.key_difference(events, bad, ["user_id", "day"]).select("event_id", "event_type")


@query(
    "missing_assets",
    """
    SELECT c_custkey AS spe, c_mktsegment AS projeto FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
)
def missing_assets(spark, d):
    registry = table(spark, d, "customer").select(
        F.col("c_custkey").alias("spe"), F.col("c_mktsegment").alias("projeto")
    )
    return joins.missing_keys(registry, table(spark, d, "events"), "spe", "user_id")


# --- cells ----------------------------------------------------------------------------------

@query(
    "soft_drop_range",
    """
    SELECT event_id, CASE WHEN value < 0 OR value > 40 THEN NULL
                          WHEN event_type = 'error' THEN NULL ELSE value END AS value
    FROM events""",
)
def soft_drop_range(spark, d):
    value = C.soft_drop(F.col("value"), 0, 40, F.col("event_type") == "error")
    return table(spark, d, "events").select("event_id", value.alias("value"))


@query(
    "soft_drop_negative",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer",
)
def soft_drop_negative(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", C.soft_drop(F.col("c_acctbal"), low=0).alias("c_acctbal")
    )


@query(
    "flag_limit",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
           CASE WHEN l_extendedprice > COALESCE(CASE WHEN p_size > 25 THEN p_retailprice * l_quantity END,
                                                p_retailprice * 20) THEN 1 ELSE 0 END AS flg_alerta_limitada
    FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def flag_limit(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"
    )
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice")
    priced = joins.lookup_join(lines, parts, ["l_partkey"])
    final = F.when(F.col("p_size") > 25, F.col("p_retailprice") * F.col("l_quantity"))
    alert = C.exceeds_reference(F.col("l_extendedprice"), final, F.col("p_retailprice") * 20)
    return priced.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", alert.alias("flg_alerta_limitada")
    )


@query(
    "flag_state",
    """
    SELECT CASE event_type WHEN 'error' THEN 1.0::DOUBLE WHEN 'view' THEN NULL ELSE 0.0::DOUBLE END AS flg_dado,
           CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS flg_historico, COUNT(*) AS total_linhas
    FROM events GROUP BY 1, 2""",
)
def flag_state(spark, d):
    kind = F.col("event_type")
    text = F.when(kind == "error", "1.0").when(kind != "view", "0.0")
    flags = table(spark, d, "events").select(
        C.to_double(text).alias("flg_dado"), C.flag(C.to_int(text) == 1).alias("flg_historico")
    )
    return profile.count_by(flags, "flg_dado", "flg_historico")


def _token_sql(c: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in (*C.NULL_TOKENS, "system"))
    return rf"CASE WHEN regexp_full_match({c}, '\s*') OR {c} IN ({tokens}) THEN NULL ELSE {c} END AS {c}"


@query(
    "null_tokens",
    f"SELECT conv_id, turn, {_token_sql('role')}, {_token_sql('text')} FROM conversations",
)
def null_tokens(spark, d):
    return cleaning.clean_null_tokens(table(spark, d, "conversations"), (*C.NULL_TOKENS, "system"))


@query(
    "coerce_numeric",
    r"""
    SELECT event_id, TRY_CAST(regexp_extract(props, '\d+') AS DOUBLE) AS val_k,
           TRY_CAST(event_type AS DOUBLE) AS val_tipo,
           CAST(event_type = 'click' AS INTEGER)::DOUBLE AS flg_click,
           TRY_CAST(regexp_extract(props, '\d+') || '.0' AS INTEGER) AS k_int,
           CASE WHEN event_type <> 'view' THEN DATE_TRUNC('second', ts) END AS instante
    FROM events""",
)
def coerce_numeric(spark, d):
    digits, kind = C.embedded_key(F.col("props"), r"\d+"), F.col("event_type")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw = table(spark, d, "events").select(
        "event_id",
        digits.alias("val_k"),
        kind.alias("val_tipo"),
        F.when(kind == "click", "1.0").otherwise("0").alias("flg_click"),
        C.to_int(F.concat(digits, F.lit(".0"))).alias("k_int"),
        F.when(kind == "view", "not a date").otherwise(stamp).alias("instante"),
    )
    return cleaning.coerce_instant(cleaning.coerce_numbers(raw), "instante")


# --- contract and duplicates ----------------------------------------------------------------

_RULES = [
    contract.Rule("c_acctbal", ge=0),
    contract.Rule("c_mktsegment", isin=("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")),
    contract.Rule("c_nationkey", nullable=True, in_range=(0, 20)),
]

_REASON_SQL = """concat_ws('; ',
    CASE WHEN c_acctbal < 0 THEN 'c_acctbal:greater_than_or_equal_to(0)' END,
    CASE WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD', 'MACHINERY')
         THEN 'c_mktsegment:isin([''AUTOMOBILE'', ''BUILDING'', ''HOUSEHOLD'', ''MACHINERY''])' END,
    CASE WHEN c_nationkey NOT BETWEEN 0 AND 20 THEN 'c_nationkey:in_range(0, 20)' END)"""


def _contract(spark, d):
    return contract.split(table(spark, d, "customer"), _RULES, "motivo", "etapa", "contrato")


@query(
    "contract_rejects",
    f"""
    SELECT * FROM (SELECT *, {_REASON_SQL} AS motivo, 'contrato' AS etapa FROM customer) WHERE motivo <> ''""",
)
def contract_rejects(spark, d):
    return _contract(spark, d)[1]


@query("contract_clean", f"SELECT * FROM customer WHERE {_REASON_SQL} = ''")
def contract_clean(spark, d):
    return _contract(spark, d)[0]


_DUP_SQL = """
    WITH r AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events),
    f AS (SELECT *, COUNT(*) OVER (PARTITION BY user_id, day) AS kn,
                 COUNT(*) OVER (PARTITION BY user_id, day, event_type) AS fn FROM r),
    k AS (SELECT *, MIN(fn) OVER (PARTITION BY user_id, day) AS mn FROM f)
    """


def _duplicates(spark, d, policy):
    rows = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    return duplicates.split_duplicates(rows, ["user_id", "day"], policy=policy)


@query("dup_quarantine_doc", _DUP_SQL + "SELECT user_id, day, event_type FROM k WHERE kn <> fn")
def dup_quarantine_doc(spark, d):
    return _duplicates(spark, d, duplicates.DOCUMENTED).quarantined


@query("dup_clean_doc", _DUP_SQL + "SELECT DISTINCT user_id, day, event_type FROM k WHERE kn = fn")
def dup_clean_doc(spark, d):
    return _duplicates(spark, d, duplicates.DOCUMENTED).clean


@query("dup_quarantine_ref", _DUP_SQL + "SELECT user_id, day, event_type FROM k WHERE kn > 1 AND fn = 1")
def dup_quarantine_ref(spark, d):
    return _duplicates(spark, d, duplicates.REFERENCE).quarantined


@query(
    "dup_clean_ref",
    _DUP_SQL + """SELECT user_id, day, MIN(event_type) AS event_type FROM k
    WHERE kn = 1 OR mn > 1 GROUP BY user_id, day""",
)
def dup_clean_ref(spark, d):
    return _duplicates(spark, d, duplicates.REFERENCE).clean


_FIRST_SQL = """
    WITH r AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, event_id AS place FROM events),
    f AS (SELECT *, COUNT(*) OVER (PARTITION BY user_id, day) AS kn,
                 COUNT(*) OVER (PARTITION BY user_id, day, event_type) AS fn FROM r),
    k AS (SELECT *, MIN(fn) OVER (PARTITION BY user_id, day) AS mn FROM f)
    """


def _first_rows(spark, d):
    """Events are numbered in the order of their file, so SQL finds a row's place in ``event_id``."""
    rows = files.read_union(spark, [f"{d}/events.parquet"], file_column=None, address_column="address")
    rows = rows.select("user_id", F.to_date("ts").alias("day"), "event_type", "address")
    return duplicates.split_duplicates(rows, ["user_id", "day"], policy=duplicates.FIRST, address="address")


@query(
    "dup_clean_first",
    _FIRST_SQL + """SELECT user_id, day, MIN_BY(event_type, place) AS event_type, MIN(place) AS place FROM k
    WHERE kn = 1 OR mn > 1 GROUP BY user_id, day""",
)
def dup_clean_first(spark, d):
    return _first_rows(spark, d).clean.select("user_id", "day", "event_type", F.col("address.row").alias("place"))


@query("dup_quarantine_first", _FIRST_SQL + "SELECT user_id, day, event_type, place FROM k WHERE kn > 1 AND fn = 1")
def dup_quarantine_first(spark, d):
    return _first_rows(spark, d).quarantined.select("user_id", "day", "event_type", F.col("address.row").alias("place"))


@query(
    "dup_counts",
    _DUP_SQL + """, p AS (SELECT user_id, day, MIN(kn) AS kn, MIN(mn) AS mn, MAX(fn) AS mx,
                                 COUNT(*) FILTER (fn = 1) AS lone FROM k GROUP BY 1, 2)
    SELECT 'documented' AS policy,
           CAST(COALESCE(SUM(kn - 1) FILTER (kn = mx), 0) AS BIGINT) AS identical_removed,
           CAST(COALESCE(SUM(kn) FILTER (kn <> mx), 0) AS BIGINT) AS conflicting FROM p
    UNION ALL
    SELECT 'reference', CAST(COALESCE(SUM(kn - 1) FILTER (mn > 1), 0) AS BIGINT),
           CAST(COALESCE(SUM(lone) FILTER (kn > 1), 0) AS BIGINT) FROM p""",
)
def dup_counts(spark, d):
    return profile.union_all(
        [
            _duplicates(spark, d, policy).counts.withColumn("policy", F.lit(policy))
            for policy in (duplicates.DOCUMENTED, duplicates.REFERENCE)
        ]
    )


@query(
    "key_violations",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def key_violations(spark, d):
    return keys.key_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- series ---------------------------------------------------------------------------------

@query(
    "gaps",
    """
    SELECT user_id, COUNT(*) FILTER (step > INTERVAL 1440 MINUTE) AS gaps
    FROM (SELECT user_id, ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) AS step FROM events)
    GROUP BY user_id""",
)
def gaps(spark, d):
    return completeness.gaps(table(spark, d, "events"), "user_id", "ts", 1440)


# Readings fall on half hours, but for the assets whose clock is off.
_SLOT_EVENTS = """
    SELECT user_id, value, CASE WHEN user_id % 7 = 0 THEN ts ELSE time_bucket(INTERVAL 30 MINUTE, ts) END AS ts FROM events"""


def _slot_events(spark, d):
    slot = F.window("ts", "30 minutes")["start"]
    ts = F.when(F.col("user_id") % 7 == 0, F.col("ts")).otherwise(slot)
    return table(spark, d, "events").select("user_id", "value", ts.alias("ts"))


@query(
    "slot_gaps",
    f"""
    SELECT user_id, COUNT(*) FILTER (step > INTERVAL 45 MINUTE) AS gaps
    FROM (SELECT user_id, ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) AS step FROM ({_SLOT_EVENTS}))
    GROUP BY user_id""",
)
def slot_gaps(spark, d):
    return completeness.gaps(_slot_events(spark, d), "user_id", "ts")


@query(
    "slot_gaps_long",
    f"""
    SELECT user_id, COUNT(*) FILTER (step > INTERVAL 700 MINUTE) AS gaps
    FROM (SELECT user_id, ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) AS step FROM ({_SLOT_EVENTS}))
    GROUP BY user_id""",
)
def slot_gaps_long(spark, d):
    """Gaps of many slots, inside and between the words of the bitmaps."""
    return completeness.gaps(_slot_events(spark, d), "user_id", "ts", 700)


@query(
    "slot_words",
    """
    WITH s AS (SELECT user_id, value, epoch(time_bucket(INTERVAL 30 MINUTE, ts))::BIGINT // 1800 AS slot FROM events)
    SELECT user_id, slot // 60 AS word, bit_or(1::BIGINT << (slot % 60)) AS bits,
           COALESCE(bit_or(1::BIGINT << (slot % 60)) FILTER (value <= 40), 0) AS valid_bits,
           MIN(slot) AS first, MAX(slot) AS last, 0::BIGINT AS off_grid FROM s GROUP BY 1, 2""",
)
def slot_words(spark, d):
    """The bitmaps themselves: two deliveries, each aggregated alone, then merged."""
    events = table(spark, d, "events").withColumn("ts", F.window("ts", "30 minutes")["start"])
    early = F.col("event_id") % 2 == 0
    parts = [completeness.slot_words(events.filter(p), ["user_id"], "ts", F.col("value") <= 40) for p in (early, ~early)]
    return completeness.merge_words(parts[0].unionByName(parts[1]), ["user_id"])


_SERIES_SQL = f"""
    WITH p AS (SELECT CAST((date_diff('day', DATE_TRUNC('month', MIN(ts)), LAST_DAY(MAX(ts))) + 1) * 48
                           AS BIGINT) AS slots FROM events),
    steps AS (SELECT user_id, ts, value,
                     ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) AS step FROM events),
    a AS (SELECT user_id, COUNT(DISTINCT ts) AS received,
                 COUNT(DISTINCT CASE WHEN value <= 40 THEN ts END) AS valid,
                 COUNT(*) FILTER (step > INTERVAL 45 MINUTE) AS gaps
          FROM steps GROUP BY user_id),
    assets AS (SELECT c_custkey AS asset, c_mktsegment AS project, COALESCE(received, 0) AS received,
                      COALESCE(valid, 0) AS valid, COALESCE(gaps, 0) AS gaps, received IS NOT NULL AS has_data,
                      (SELECT slots FROM p) AS expected
               FROM customer LEFT JOIN a ON c_custkey = user_id),
    c AS (SELECT *, {rounded("100.0::DOUBLE * received / expected", 1)} AS pct FROM assets)
    """


def _asset_completeness(spark, d):
    registry = table(spark, d, "customer").select(
        F.col("c_custkey").alias("asset"), F.col("c_mktsegment").alias("project")
    )
    series = table(spark, d, "events").select(F.col("user_id").alias("asset"), "ts", "value")
    return completeness.asset_completeness(series, registry, "asset", "project", "ts", F.col("value") <= 40)


@query(
    "slot_completeness",
    _SERIES_SQL.replace("FROM events)", f"FROM ({_SLOT_EVENTS}))") + "SELECT * FROM c",
)
def slot_completeness(spark, d):
    registry = table(spark, d, "customer").select(F.col("c_custkey").alias("asset"), F.col("c_mktsegment").alias("project"))
    series = _slot_events(spark, d).withColumnRenamed("user_id", "asset")
    return completeness.asset_completeness(series, registry, "asset", "project", "ts", F.col("value") <= 40)


@query("completeness_assets", _SERIES_SQL + "SELECT * FROM c")
def completeness_assets(spark, d):
    return _asset_completeness(spark, d)


@query(
    "completeness",
    _SERIES_SQL + f"""
    , s AS (SELECT project, COUNT(*) AS spes_esperadas, COUNT(*) FILTER (NOT has_data) AS spes_sem_dado,
                 COUNT(*) FILTER (has_data AND (pct < 100 OR gaps > 0)) AS spes_com_problema,
                 MAX(expected) AS n_periodos_fixo_por_spe,
                 CAST(SUM(expected) AS BIGINT) AS esperado_total,
                 CAST(SUM(received) AS BIGINT) AS recebido_total,
                 CAST(SUM(valid) AS BIGINT) AS recebido_valido,
                 CAST(SUM(gaps) AS BIGINT) AS gaps_detectados FROM c GROUP BY project),
    q AS (SELECT *, {rounded("100.0::DOUBLE * recebido_total / esperado_total", 1)} AS pct_envio,
                 {rounded("100.0::DOUBLE * recebido_valido / esperado_total", 1)} AS pct_dados_validos FROM s)
    SELECT *, pct_envio < 95 OR pct_dados_validos < 95 AS alerta FROM q""",
)
def project_completeness(spark, d):
    return completeness.project_completeness(_asset_completeness(spark, d), "project")


@query(
    "completeness_problems",
    _SERIES_SQL + """
    SELECT project, asset, received AS recebido, expected AS esperado, pct, gaps FROM c
    WHERE has_data AND (pct < 100 OR gaps > 0)""",
)
def completeness_problems(spark, d):
    return completeness.problem_assets(_asset_completeness(spark, d), "project", "asset")


_AS_OF = ["2024-01-20", "2024-02-15", "2024-06-15"]


@query(
    "freshness",
    " UNION ALL ".join(
        f"""
    SELECT '{day}' AS as_of,
           CASE WHEN last IS NULL OR last < want THEN 'FALHA' WHEN last = want THEN 'OK' ELSE 'ALERTA' END AS status,
           COALESCE(last = want, FALSE) AS ok, strftime(want, '%m/%Y') AS ultimo_mes_esperado,
           CASE WHEN last = want THEN 'Último registro: ' || strftime(ts, '%d/%m/%Y %H:%M')
                WHEN last > want THEN 'Base contém dados do mês atual (' || strftime(ts, '%m/%Y') || ')'
                ELSE 'Dados desatualizados. Último: ' || strftime(ts, '%d/%m/%Y %H:%M') END AS mensagem
    FROM (SELECT MAX(ts) AS ts, DATE_TRUNC('month', MAX(ts)) AS last,
                 DATE_TRUNC('month', DATE '{day}') - INTERVAL 1 MONTH AS want FROM events)"""
        for day in _AS_OF
    ),
)
def freshness(spark, d):
    """Seen from three days: the last month is the current one, the one before, and long ago."""
    events = table(spark, d, "events")
    return profile.union_all(
        [completeness.freshness(events, "ts", F.lit(day).cast("date")).select(F.lit(day).alias("as_of"), "*") for day in _AS_OF]
    )


@query(
    "period",
    """
    SELECT MIN(ts) AS first, MAX(ts) AS last, strftime(MIN(ts), '%Y-%m-%d') AS inicio,
           strftime(MAX(ts), '%Y-%m-%d') AS fim,
           CAST((date_diff('day', DATE_TRUNC('month', MIN(ts)), LAST_DAY(MAX(ts))) + 1) * 48 AS BIGINT) AS slots
    FROM events""",
)
def period(spark, d):
    return completeness.data_period(table(spark, d, "events"), "ts")


@query(
    "month_labels",
    """
    WITH l AS (SELECT DATE_TRUNC('month', MAX(o_orderdate)) AS m FROM orders),
    s AS (SELECT strftime(m - INTERVAL 1 MONTH * i, '%Y_%m') AS mes FROM l, range(1, 7) t(i))
    SELECT mes, COUNT(o_orderkey) AS pedidos
    FROM s LEFT JOIN orders ON strftime(o_orderdate, '%Y_%m') = mes GROUP BY mes""",
)
def month_labels(spark, d):
    orders = table(spark, d, "orders")
    labels = orders.agg(F.max("o_orderdate").alias("last")).select(
        F.explode(C.month_labels(F.col("last"))).alias("mes")
    )
    per_month = orders.groupBy(F.date_format("o_orderdate", "yyyy_MM").alias("mes")).agg(
        F.count("*").alias("pedidos")
    )
    return labels.join(per_month, "mes", "left").select("mes", F.coalesce("pedidos", F.lit(0)).alias("pedidos"))


@query(
    "distribution",
    f"""
    SELECT event_type, 'value' AS coluna, {rounded("MIN(value)", 4)} AS min,
           {rounded("quantile_cont(value, 0.25)", 4)} AS p25, {rounded("quantile_cont(value, 0.5)", 4)} AS p50,
           {rounded("quantile_cont(value, 0.75)", 4)} AS p75, {rounded("MAX(value)", 4)} AS max,
           {rounded(f"CAST(SUM({exact('value')}) AS DOUBLE) / COUNT(value)", 4)} AS media
    FROM events GROUP BY event_type""",
)
def value_distribution(spark, d):
    return distribution.distribution(table(spark, d, "events"), ["value"], ["event_type"])


@query(
    "distribution_lines",
    " UNION ALL ".join(
        f"""
    SELECT '{c}' AS coluna, {rounded(f"MIN({c})", 4)} AS min,
           {rounded(f"quantile_cont({c}, 0.25)", 4)} AS p25, {rounded(f"quantile_cont({c}, 0.5)", 4)} AS p50,
           {rounded(f"quantile_cont({c}, 0.75)", 4)} AS p75, {rounded(f"MAX({c})", 4)} AS max,
           {rounded(f"CAST(SUM({exact(c)}) AS DOUBLE) / COUNT({c})", 4)} AS media
    FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def line_distribution(spark, d):
    return distribution.distribution(
        table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]
    )


# --- profiles -------------------------------------------------------------------------------

@query(
    "count_by_key",
    "SELECT user_id, COUNT(*) AS total_linhas FROM events GROUP BY 1 ORDER BY 2 DESC, 1",
)
def count_by_key(spark, d):
    return profile.count_by(table(spark, d, "events"), "user_id", by_count=True)


@query("count_by_file", "SELECT 'lineitem.parquet' AS filename, COUNT(*) AS total_linhas FROM lineitem")
def count_by_file(spark, d):
    return profile.count_by_file(table(spark, d, "lineitem"))


@query(
    "assets_per_project",
    "SELECT c_mktsegment AS projeto, COUNT(c_custkey) AS spes FROM customer GROUP BY 1 ORDER BY 1",
)
def assets_per_project(spark, d):
    return profile.count_by(
        table(spark, d, "customer").select(F.col("c_mktsegment").alias("projeto")), "projeto", name="spes"
    )


@query(
    "null_profile",
    f"""
    SELECT 'value' AS coluna, 0.0::DOUBLE AS antes_pct,
           {rounded("100.0::DOUBLE * COUNT(*) FILTER (value > 40 OR event_type = 'error') / COUNT(*)", 2)}
           AS depois_pct FROM events
    UNION ALL
    SELECT 'parcial', {rounded("100.0::DOUBLE * COUNT(*) FILTER (event_type = 'view') / COUNT(*)", 2)},
           {rounded("100.0::DOUBLE * COUNT(*) FILTER (event_type = 'view') / COUNT(*)", 2)} FROM events""",
)
def null_profile(spark, d):
    before = table(spark, d, "events").withColumn("parcial", F.when(F.col("event_type") != "view", F.col("value")))
    after = before.withColumn("value", C.soft_drop(F.col("value"), 0, 40, F.col("event_type") == "error"))
    return profile.null_profile(before, after, ["value", "parcial", "absent"])


@query(
    "fact_coverage",
    """
    SELECT COUNT(*) AS assets, COUNT(u) AS with_facts, COUNT(*) - COUNT(u) AS without_facts,
           COUNT(*) FILTER (c_nationkey IS NULL) AS without_group
    FROM customer LEFT JOIN (SELECT DISTINCT user_id AS u FROM events) ON c_custkey = u""",
)
def fact_coverage(spark, d):
    return profile.coverage(
        table(spark, d, "events"), table(spark, d, "customer"), "user_id", "c_custkey", "c_nationkey"
    )


@query(
    "trace",
    """
    SELECT 'raw' AS layer, COUNT(*) AS n, MIN(doc_id) AS example FROM documents WHERE text LIKE '%the%'
    UNION ALL SELECT 'filtered', COUNT(*), MIN(doc_id) FROM documents WHERE lang = 'en' AND text LIKE '%the%'
    UNION ALL SELECT 'final', COUNT(*), MIN(doc_id) FROM documents JOIN labels USING (doc_id)
              WHERE quality = 1 AND text LIKE '%the%'""",
)
def trace(spark, d):
    documents = table(spark, d, "documents")
    labelled = documents.join(table(spark, d, "labels"), "doc_id")
    word = F.col("text").like("%the%")
    return profile.trace(
        {
            "raw": (documents, word),
            "filtered": (documents, (F.col("lang") == "en") & word),
            "final": (labelled, (F.col("quality") == 1) & word),
        },
        "doc_id",
    )


@query(
    "health",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", CASE WHEN COUNT(*) > 0 THEN 'UP' ELSE 'DEGRADED' END AS status, COUNT(*) AS n,"
        f" CAST(NULL AS VARCHAR) AS detail FROM {t}"
        for t in TABLES
    ),
)
def health(spark, d):
    return profile.health(spark, {t: f"{d}/{t}.parquet" for t in TABLES})


@query(
    "health_states",
    " UNION ALL ".join([
        *[
            f"SELECT '{t}' AS \"table\", CASE WHEN COUNT(*) > 0 THEN 'UP' ELSE 'DEGRADED' END AS status, COUNT(*) AS n,"
            f" CAST(NULL AS VARCHAR) AS detail FROM {t}"
            for t in TABLES
        ],
        "SELECT 'no_orders', CASE WHEN COUNT(*) > 0 THEN 'UP' ELSE 'DEGRADED' END, COUNT(*), NULL FROM orders WHERE o_orderkey IS NULL",
        "SELECT 'never_written', 'DOWN', NULL, 'PATH_NOT_FOUND'",
    ]),
)
def health_states(spark, d):
    """The given tables, one written without rows, and one that nobody wrote."""
    base = folder(spark, "health")
    table(spark, d, "orders").filter("o_orderkey IS NULL").write.parquet(f"{base}/no_orders")
    paths = {n: f"{base}/{n}" for n in ("no_orders", "never_written")}
    return profile.health(spark, {**{t: f"{d}/{t}.parquet" for t in TABLES}, **paths})


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", COUNT(*) AS n FROM {t}" for t in TABLES),
)
def table_counts(spark, d):
    return profile.table_counts({t: table(spark, d, t) for t in TABLES})


_ORDER_COLUMNS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
    "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


@query(
    "table_profile",
    " UNION ALL ".join([
        "SELECT 'count' AS section, 'total_linhas' AS item, CAST(COUNT(*) AS VARCHAR) AS value FROM orders",
        *[f"SELECT 'schema', '{c}', '{t}'" for c, t in _ORDER_COLUMNS.items()],
        "SELECT 'files', 'orders.parquet', CAST(COUNT(*) AS VARCHAR) FROM orders",
        """SELECT 'sample', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR)
           FROM (SELECT * FROM orders ORDER BY o_orderkey NULLS LAST, o_custkey NULLS LAST LIMIT 5)""",
    ]),
)
def table_profile(spark, d):
    """The parts of a profile as (section, item, value)."""
    parts = profile.table_profile(table(spark, d, "orders"), ["o_orderkey", "o_custkey"])
    cells = {
        "count": (F.lit("total_linhas"), F.col("total_linhas")),
        "schema": (F.col("column_name"), F.col("column_type")),
        "sample": (F.col("o_orderkey"), F.col("o_custkey")),
        "files": (F.col("filename"), F.col("total_linhas")),
    }
    return profile.union_all(
        [parts[n].select(F.lit(n).alias("section"), k.cast("string").alias("item"), v.cast("string").alias("value")) for n, (k, v) in cells.items()]
    )


@query(
    "sample_rows",
    """
    SELECT user_id, ts, event_id, event_type FROM events
    ORDER BY user_id NULLS LAST, ts NULLS LAST, event_id NULLS LAST LIMIT 100""",
)
def sample_rows(spark, d):
    rows = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    return profile.sample_rows(rows, ["user_id", "ts", "event_id"], 100)


@query(
    "json_records",
    """
    SELECT '{"o_orderkey":' || o_orderkey || ',"status":'
           || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END
           || ',"date":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000"}' AS json
    FROM orders""",
)
def json_records(spark, d):
    return sinks.json_records(
        table(spark, d, "orders").select(
            "o_orderkey",
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
            F.col("o_orderdate").alias("date"),
        )
    )


# --- files ----------------------------------------------------------------------------------

@query(
    "union_drift",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority
    FROM orders""",
)
def union_drift(spark, d):
    """One folder of three deliveries: prices as numbers, as text, and with a further column."""
    orders, path = table(spark, d, "orders"), folder(spark, "deliveries")
    plain = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    of = lambda i: F.col("o_orderkey") % 3 == i
    plain.filter(of(0)).write.parquet(f"{path}/a")
    plain.filter(of(1)).withColumn("o_totalprice", F.col("o_totalprice").cast("string")).write.parquet(f"{path}/b")
    orders.filter(of(2)).select(*plain.columns, "o_orderpriority").write.parquet(f"{path}/c")
    return files.read_union(spark, [path], {"o_totalprice": "double"}, file_column=None)


@query(
    "salted_lookup",
    "SELECT l_orderkey, l_linenumber, l_partkey, p_size FROM lineitem JOIN part ON l_partkey = p_partkey",
)
def salted_lookup(spark, d):
    """Keys of different types, and every key with more than ten rows split."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, d, "part").select(F.col("p_partkey").cast("double").alias("l_partkey"), "p_size")
    return joins.salted_join(lines, parts, ["l_partkey"], rows_per_task=10)


@query(
    "monthly_files",
    """
    SELECT strftime(o_orderdate, '%Y_%m') AS mes, COUNT(*) AS pedidos, CAST(MIN(o_orderkey) AS BIGINT) AS primeiro
    FROM orders WHERE o_orderdate >= (SELECT DATE_TRUNC('month', MAX(o_orderdate)) - INTERVAL 3 MONTH FROM orders)
                  AND o_orderdate < (SELECT DATE_TRUNC('month', MAX(o_orderdate)) FROM orders)
    GROUP BY 1""",
)
def monthly_files(spark, d):
    """The last three whole months, delivered as parquet and CSV in turn, found and read by month."""
    orders, base = table(spark, d, "orders"), folder(spark, "months")
    labelled = orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy_MM").alias("mes"))
    months = files.month_list(orders.agg(F.max("o_orderdate")).first()[0].date(), 3)
    for i, month in enumerate(months):
        rows, path = labelled.filter(F.col("mes") == month), f"{base}/orders_{month}"
        if i % 2:
            rows.write.option("header", True).csv(f"{path}.csv")
        else:
            rows.write.parquet(f"{path}.parquet")
    found = files.read_monthly(spark, base, "orders", months, {"o_orderkey": "bigint"})
    return found.groupBy("mes").agg(F.count("*").alias("pedidos"), F.min("o_orderkey").alias("primeiro"))


@query("registry_file", "SELECT CAST(c_custkey AS VARCHAR) AS spe, c_name AS ceg, c_mktsegment AS projeto FROM customer")
def registry_file(spark, d):
    """A registry written as CSV and read with its declared schema."""
    path = folder(spark, "registry")
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("spe"), F.col("c_name").alias("ceg"), F.col("c_mktsegment").alias("projeto"))
    rows.write.option("header", True).csv(path)
    return files.read_registry(spark, path, "spe string, ceg string, projeto string")


@query(
    "table_sink",
    """
    SELECT version, o_orderkey, o_totalprice + CASE version WHEN 2 THEN 1 ELSE 0 END AS o_totalprice, o_orderdate,
           strftime(o_orderdate, '%Y_%m') AS mes
    FROM orders, (VALUES (1), (2)) v(version)""",
)
def table_sink(spark, d):
    """All orders written by month, then replaced by changed ones; both versions as read back."""
    path = folder(spark, "table")
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", F.date_format("o_orderdate", "yyyy_MM").alias("mes"))
    sinks.write_table(rows, path, "mes")
    sinks.write_table(rows.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, "mes")
    store = Store(spark, path)
    return profile.union_all([store.read(v)[""].withColumn("version", F.lit(v)) for v in store.versions()])


@query("pruned_generation", _generation_sql("DATE_TRUNC('month', din)", _EVENT_FACTS))
def pruned_generation(spark, d):
    """The facts as Gold stores them, by month and in ranges of their key, read for one project."""
    store, name = Store(spark, folder(spark, "facts")), "fato_geracao_spe"
    key = (*D.GOLD_KEYS[name], "event_id")  # a user may have several events at one time
    facts = store.write(medallion.by_month(_event_facts(spark, d, "event_id")), name, D.MONTH, key)
    store.publish()
    return analytics.generation(facts, _customer_assets(spark, d), "BUILDING", C.MONTHLY)


@query(
    "json_sink",
    """SELECT '{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS value FROM customer""",
)
def json_sink(spark, d):
    path = folder(spark, "lines")
    sinks.write_json_lines(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), path)
    return spark.read.text(path)
