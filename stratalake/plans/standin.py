"""Literacy-shaped raw tables derived from the order / customer / line-item / event tables.

The derivations are plain SQL that Spark and other engines read alike but for the names of two functions,
so a check can prepare the same inputs elsewhere. Dirt that cleaning must handle comes from the content: deliveries that arrive twice,
keys missing for some statuses, padded lower-case codes of some regions, text where a number is due.
Years move to the range that has targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.plans import literacy_tables as tables

YEAR_SHIFT = 29


def _year(column: str) -> str:
    return f"(CAST(year({column}) AS INT) + {YEAR_SHIFT})"


def _targets(base: str, step: float, years=tables.TARGET_YEARS) -> str:
    first = tables.TARGET_YEARS[0]
    return ", ".join(
        f"{base} + CAST({step * (y - first)} AS DOUBLE) AS {tables.TARGET_PREFIX}{y}" for y in years
    )


def _copies(times: str) -> str:
    """Column that repeats each row ``times`` times: a second delivery without a second scan."""
    return f"{{explode}}({{series}}(1, {times})) AS delivery_no"


def _percent(part: str, whole: str = "n") -> str:
    return f"CAST({part} AS DOUBLE) * CAST(100 AS DOUBLE) / CAST({whole} AS DOUBLE)"


_META_NAMES = [f"{tables.TARGET_PREFIX}{y}" for y in tables.TARGET_YEARS]

_STATUS_COUNTS = (
    "count(*) AS n, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_f, "
    "count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS n_o, "
    "count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS n_p"
)

# Orders per state, year and network code. Orders are summed per customer before the joins, so a customer
# with a large share of the orders is a handful of rows in the shuffle.
_PER_STATE = f"""
per_customer AS (
  SELECT o_custkey, {_year("o_orderdate")} AS y, substr(o_orderpriority, 1, 1) AS code, {_STATUS_COUNTS},
         sum(CAST(o_totalprice AS DECIMAL(15, 2))) AS total
  FROM {{orders}} GROUP BY 1, 2, 3
),
per_state AS (
  SELECT n_name, r_name, y, code, sum(n) AS n, sum(n_f) AS n_f, sum(n_o) AS n_o, sum(n_p) AS n_p,
         sum(total) AS total
  FROM per_customer
  JOIN {{customer}} ON o_custkey = c_custkey
  JOIN {{nation}} ON c_nationkey = n_nationkey
  JOIN {{region}} ON n_regionkey = r_regionkey
  GROUP BY 1, 2, 3, 4
)"""

RAW_SQL = {
    "uf": f"""
WITH {_PER_STATE},
delivery AS (
  SELECT CAST(y AS STRING) AS ano,
         CASE WHEN code = '4' AND r_name = 'AMERICA' THEN NULL
              WHEN r_name = 'ASIA' THEN concat('  ', lower(n_name), ' ')
              ELSE n_name END AS sigla_uf,
         '2' AS serie,
         CASE WHEN code = '1' THEN 'Federal' ELSE code END AS rede,
         {_percent("n_f")} AS taxa_alfabetizacao,
         CAST(total AS DOUBLE) / CAST(n AS DOUBLE) AS media_portugues
  FROM per_state
)
SELECT ano, sigla_uf, serie, rede, taxa_alfabetizacao, media_portugues
FROM (SELECT *, {_copies("CASE WHEN rede = '5' THEN 2 ELSE 1 END")} FROM delivery) AS d""",
    "municipio": f"""
WITH sent AS (
  SELECT *, {_copies("CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END")} FROM {{orders}}
)
  SELECT CAST({_year("o_orderdate")} AS STRING) AS ano,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
              ELSE CAST(o_custkey AS STRING) END AS id_municipio,
         CASE WHEN o_orderstatus = 'F' THEN '2' WHEN o_orderstatus = 'P' THEN 'n/d'
              WHEN delivery_no = 1 THEN '5' ELSE '9' END AS serie,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'Estadual'
              ELSE substr(o_orderpriority, 1, 1) END AS rede,
         o_totalprice / CAST(5000 AS DOUBLE) AS taxa_alfabetizacao,
         o_totalprice AS media_portugues
  FROM sent""",
    "meta_brasil": f"""
WITH national AS (
  SELECT {_year("o_orderdate")} AS y, substr(o_orderpriority, 1, 1) AS code, {_STATUS_COUNTS}
  FROM {{orders}} GROUP BY 1, 2
),
delivery AS (
  SELECT CAST(y AS STRING) AS ano, CASE WHEN code = '5' THEN 'Pública' ELSE code END AS rede,
         {_percent("n_f")} AS taxa_alfabetizacao, {_targets(_percent("n_o"), 0.25)}
  FROM national
)
SELECT ano, rede, taxa_alfabetizacao, {", ".join(_META_NAMES)}
FROM (SELECT *, {_copies("2")} FROM delivery) AS d""",
    "meta_por_uf": f"""
WITH {_PER_STATE},
delivery AS (
  SELECT CAST(y AS STRING) AS ano,
         CASE r_name WHEN 'AFRICA' THEN NULL WHEN 'EUROPE' THEN concat(' ', lower(n_name)) ELSE n_name END AS sigla_uf,
         CASE WHEN code = '5' THEN 'Pública' ELSE concat('Rede ', code) END AS rede,
         {_percent("n_o")} AS taxa_alfabetizacao,
         {_targets(_percent("n_o"), 0.5, tables.TARGET_YEARS[:-1])},
         CAST(CAST(n_o AS BIGINT) AS STRING) AS {tables.TARGET_PREFIX}{tables.TARGET_YEARS[-1]},
         {_percent("n_p")} AS percentual_participacao
  FROM per_state
)
SELECT ano, sigla_uf, rede, taxa_alfabetizacao, {", ".join(_META_NAMES)}, percentual_participacao
FROM (SELECT *, {_copies("2")} FROM delivery) AS d""",
    "meta_por_municipio": f"""
WITH agreed AS (
  SELECT o_custkey, {_year("o_orderdate")} AS y, substr(o_orderpriority, 1, 1) AS code, {_STATUS_COUNTS}
  FROM {{orders}} GROUP BY 1, 2, 3
),
delivery AS (
  SELECT CAST(y AS STRING) AS ano, CASE WHEN code <> '1' THEN CAST(o_custkey AS STRING) END AS id_municipio,
         CASE WHEN code = '3' THEN 'Municipal' ELSE concat('Rede ', code) END AS rede,
         {_percent("n_o")} AS taxa_alfabetizacao, {_targets(_percent("n_o"), 1.5)},
         CAST(n AS INT) AS nivel_alfabetizacao, {_percent("n_p")} AS percentual_participacao
  FROM agreed
)
SELECT ano, id_municipio, rede, taxa_alfabetizacao, {", ".join(_META_NAMES)}, nivel_alfabetizacao,
       percentual_participacao
FROM (SELECT *, {_copies("CASE WHEN nivel_alfabetizacao = 1 THEN 2 ELSE 1 END")} FROM delivery) AS d""",
    "ts_municipio": """
WITH entity AS (
  SELECT c_custkey AS id, c_nationkey AS nation_id, c_mktsegment AS segment, c_acctbal AS balance FROM {customer}
  UNION ALL
  SELECT s_suppkey AS id, s_nationkey AS nation_id, 'BUILDING' AS segment, s_acctbal AS balance FROM {supplier}
)
SELECT CASE WHEN segment = 'MACHINERY' THEN '2024' ELSE '2025' END AS NU_ANO_AVALIACAO,
       CASE WHEN segment = 'HOUSEHOLD' AND balance < 0 THEN NULL ELSE CAST(id AS STRING) END AS CO_MUNICIPIO,
       CASE WHEN segment = 'BUILDING' THEN concat(' ', lower(n_name), '  ') ELSE n_name END AS SG_UF,
       balance AS PC_ALUNO_ALFABETIZADO,
       2 AS TP_SERIE,
       CASE segment WHEN 'BUILDING' THEN 3 WHEN 'AUTOMOBILE' THEN 2 ELSE 5 END AS ID_TIPO_REDE
FROM entity JOIN {nation} ON nation_id = n_nationkey""",
    "ts_estado": """
SELECT CASE WHEN s_acctbal < 0 THEN NULL ELSE '2025' END AS NU_ANO_AVALIACAO,
       s_nationkey AS CO_UF,
       n_name AS SG_UF,
       s_acctbal AS PC_ALUNO_ALFABETIZADO,
       CASE WHEN s_acctbal > 5000 THEN 2 ELSE 5 END AS TP_SERIE,
       3 AS ID_TIPO_REDE
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "ts_item": """
SELECT p_partkey AS CO_ITEM, p_brand AS CO_BLOCO, p_size AS NU_POSICAO, p_type AS TX_GABARITO,
       p_retailprice AS NU_PARAM_A1
FROM {part}""",
    "ts_aluno": f"""
WITH sent AS (
  SELECT *, {_copies("CASE WHEN l_tax > CAST(0.05 AS DOUBLE) THEN 2 ELSE 1 END")} FROM {{lineitem}}
)
  SELECT {_year("l_shipdate")} AS NU_ANO_AVALIACAO,
         l_linenumber AS CO_UF,
         CASE WHEN l_returnflag = 'R' THEN concat(' ', lower(l_returnflag), l_linestatus, ' ')
              ELSE concat(l_returnflag, l_linestatus) END AS SG_UF,
         CASE WHEN l_returnflag = 'N' AND l_tax = 0 THEN NULL ELSE l_orderkey END AS ID_ALUNO,
         l_linenumber AS TP_SERIE,
         l_suppkey AS ID_ESCOLA,
         CASE WHEN l_returnflag = 'A' THEN 2 ELSE 3 END AS TP_DEPENDENCIA,
         l_partkey AS CO_MUNICIPIO,
         concat('Part ', CAST(l_partkey AS STRING)) AS NO_MUNICIPIO,
         CASE WHEN l_linestatus = 'F' THEN 1 WHEN l_returnflag = 'N' THEN NULL ELSE 0 END AS IN_PRESENCA_LP,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS IN_PREENCHIMENTO_LP,
         l_linenumber AS CO_CADERNO_LP,
         1 AS CO_BLOCO_1, concat(l_returnflag, 'BC') AS TX_RESPOSTA_BLOCO_1, 'ABC' AS TX_GABARITO_BLOCO_1,
         2 AS CO_BLOCO_2, concat(l_returnflag, 'CD') AS TX_RESPOSTA_BLOCO_2, 'BCD' AS TX_GABARITO_BLOCO_2,
         3 AS CO_BLOCO_3, concat(l_returnflag, 'DA') AS TX_RESPOSTA_BLOCO_3, 'CDA' AS TX_GABARITO_BLOCO_3,
         4 AS CO_BLOCO_4, concat(l_returnflag, 'AB') AS TX_RESPOSTA_BLOCO_4, 'DAB' AS TX_GABARITO_BLOCO_4,
         l_tax AS VL_PESO_ALUNO_LP,
         CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity END AS VL_PROFICIENCIA_LP,
         CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS IN_ALFABETIZADO
  FROM sent""",
}

INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def raw_sql(name: str, table_names: dict[str, str], explode: str, series: str) -> str:
    """The derivation of raw table ``name`` for an engine with these table and function names."""
    return RAW_SQL[name].format(**table_names, explode=explode, series=series)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Raw literacy table ``name``."""
    sql = raw_sql(name, {t: "{" + t + "}" for t in INPUTS}, explode="explode", series="sequence")
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in INPUTS if "{" + t + "}" in sql})


# Event type of the given events to the event type of the literacy stream. "error" has none: part of it is
# JSON without a type, part is not JSON.
EVENT_KINDS = {
    "view": "dados_aluno",
    "click": "dados_municipio",
    "purchase": "dados_indicadores",
    "signup": "dados_itens",
}


def _event_text(events: DataFrame) -> tuple[Column, Column]:
    """The type of each event, NULL without one, and its JSON text."""
    kind = F.coalesce(*[F.when(F.col("event_type") == given, F.lit(k)) for given, k in EVENT_KINDS.items()])
    field = {
        "tipo_mensagem": kind,
        "NU_ANO": F.year("ts"),
        "CO_UF": F.when(F.col("value") >= 0.05, F.col("user_id").try_cast("int")),
        "SG_UF": F.when(F.col("value") < 10, F.lit(" ro ")).otherwise(F.lit("RO")),
        "ID_ALUNO": F.col("event_id"),
        "TP_SERIE": F.lit(2),
        "ID_ESCOLA": F.col("user_id"),
        "TP_DEPENDENCIA": F.lit(3),
        "CO_MUNICIPIO": F.when(F.col("value") >= 1, F.col("user_id")),
        "NO_MUNICIPIO": F.concat(F.lit("Município "), F.col("user_id").cast("string")),
        "IN_PRESENCA": F.lit(1),
        "VL_PROFICIENCIA": F.col("value"),
        "IN_ALFABETIZADO": (F.col("value") >= 50).cast("int"),
        "VL_MEDIA": F.col("value"),
        "ID_TIPO_REDE": F.lit(2),
        "PC_ALUNO_MEDIA": F.col("value"),
        "PC_ALUNO_NIVEL_8_LP": F.col("value") / 8,
        "CO_BLOCO": F.lit("4A"),
        "NU_POSICAO": F.dayofmonth("ts"),
        "CO_ITEM": F.when(F.col("value") >= 1, F.col("event_id").try_cast("int")),
        "TP_DISCIPLINA": F.lit(1),
        "NU_DESCR_ITEM": F.col("props"),
        "TX_GABARITO": F.lit("B"),
        "NU_PARAM_A1": F.col("value") / 4,
        "NU_PARAM_B1": -F.col("value"),
        "IN_ITEM_COMUM": F.lit(0),
        "timestamp_evento": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    }

    def where_declared(name):
        given = [g for g, k in EVENT_KINDS.items() if name in tables.EVENTS[k].schema.fieldNames()]
        return F.when(F.col("event_type").isin(given), field[name]).alias(name)

    # One JSON text with the fields of the event's own type: NULL fields are left out.
    typed = F.to_json(F.struct(*[where_declared(name) for name in field]))
    untyped = F.to_json(F.struct(field["timestamp_evento"].alias("timestamp_evento")))
    broken = F.concat(F.lit("<event "), F.col("event_id").cast("string"), F.lit(">"))
    payload = F.when(kind.isNotNull(), typed).when(F.col("value") < 10, broken).otherwise(untyped)
    return kind, payload


def event_payloads(events: DataFrame) -> DataFrame:
    """One binary ``body`` per event, as a message bus would deliver it. Works on streams too."""
    return events.select(_event_text(events)[1].cast("binary").alias("body"))


# Events with a value below these limits reach the store damaged; the others below 50 come in envelopes.
DAMAGE = {2: "line is no JSON object", 4: "payload is no JSON object", 6: "no declared field", 8: "value does not fit"}


def damaged_lines(events: DataFrame) -> DataFrame:
    """Stored lines of the events that have a type, some torn, some with other content, with that type."""
    kind, payload = _event_text(events)
    value, torn = F.col("value"), F.expr("substring(payload, 1, length(payload) - 7)")
    line = (
        F.when(value < 2, torn)
        .when(value < 4, F.to_json(F.struct(torn.alias("_raw_data"))))
        .when(value < 6, F.lit('{"other": 1}'))
        .when(value < 8, F.regexp_replace("payload", '"NU_ANO":[0-9]+', '"NU_ANO":"n/d"'))
        .when(value < 50, F.to_json(F.struct(F.col("payload").alias("_raw_data"))))
        .otherwise(F.col("payload"))
    )
    known = events.select("value", kind.alias("tipo_mensagem"), payload.alias("payload")).where("tipo_mensagem is not null")
    return known.select(line.alias("value"), "tipo_mensagem")
