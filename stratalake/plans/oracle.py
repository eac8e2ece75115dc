"""SQL that gives the result of each registered query on the same tables, for checking.

The raw tables come from the shared derivations; everything after that is written independently.
"""

from __future__ import annotations

from stratalake.plans import literacy_tables as tables
from stratalake.plans.standin import DAMAGE, INPUTS, RAW_SQL, raw_sql

_TABLES = {name: name for name in INPUTS}
_METAS = [f"{tables.TARGET_PREFIX}{y}" for y in tables.TARGET_YEARS]


def _case(column: str, labels: dict[int, str]) -> str:
    branches = " ".join(f"WHEN {code} THEN '{label}'" for code, label in labels.items())
    return f"CASE {column} {branches} ELSE '{tables.UNCLASSIFIED}' END"


def _cols(names, alias: str) -> str:
    return ", ".join(f"{alias}.{name}" for name in names)


_TARGET_OF_YEAR = "CASE ano " + " ".join(f"WHEN {y} THEN {m}" for y, m in zip(tables.TARGET_YEARS, _METAS)) + " END"

# Building blocks: name -> (blocks it reads, SELECT).
_BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    **{f"raw_{name}": ((), raw_sql(name, _TABLES, explode="unnest", series="generate_series")) for name in RAW_SQL},
    "uf": (
        ("raw_uf",),
        """SELECT TRY_CAST(ano AS INTEGER) AS ano, upper(trim(sigla_uf)) AS sigla_uf,
                  TRY_CAST(serie AS INTEGER) AS serie, TRY_CAST(rede AS INTEGER) AS rede,
                  taxa_alfabetizacao, media_portugues
           FROM (SELECT DISTINCT * FROM raw_uf) WHERE ano IS NOT NULL AND sigla_uf IS NOT NULL""",
    ),
    "municipio": (
        ("raw_municipio",),
        """SELECT TRY_CAST(ano AS INTEGER) AS ano, TRY_CAST(id_municipio AS BIGINT) AS id_municipio,
                  TRY_CAST(serie AS INTEGER) AS serie, TRY_CAST(rede AS INTEGER) AS rede,
                  taxa_alfabetizacao, media_portugues
           FROM (SELECT DISTINCT * FROM raw_municipio) WHERE ano IS NOT NULL AND id_municipio IS NOT NULL""",
    ),
    "meta_brasil": (
        ("raw_meta_brasil",),
        f"""SELECT TRY_CAST(ano AS INTEGER) AS ano, TRY_CAST(rede AS INTEGER) AS rede, taxa_alfabetizacao,
                   {", ".join(_METAS)}
            FROM (SELECT DISTINCT * FROM raw_meta_brasil) WHERE ano IS NOT NULL""",
    ),
    "meta_por_uf": (
        ("raw_meta_por_uf",),
        f"""SELECT TRY_CAST(ano AS INTEGER) AS ano, upper(trim(sigla_uf)) AS sigla_uf, rede, taxa_alfabetizacao,
                   {", ".join(_METAS)}, percentual_participacao
            FROM (SELECT DISTINCT * FROM raw_meta_por_uf) WHERE ano IS NOT NULL AND sigla_uf IS NOT NULL""",
    ),
    "meta_por_municipio": (
        ("raw_meta_por_municipio",),
        f"""SELECT TRY_CAST(ano AS INTEGER) AS ano, TRY_CAST(id_municipio AS BIGINT) AS id_municipio, rede,
                   taxa_alfabetizacao, {", ".join(_METAS)}, nivel_alfabetizacao, percentual_participacao
            FROM (SELECT DISTINCT * FROM raw_meta_por_municipio)
            WHERE ano IS NOT NULL AND id_municipio IS NOT NULL""",
    ),
    "ts_municipio": (
        ("raw_ts_municipio",),
        """SELECT TRY_CAST(NU_ANO_AVALIACAO AS INTEGER) AS ano, TRY_CAST(CO_MUNICIPIO AS BIGINT) AS id_municipio,
                  SG_UF AS sigla_uf, PC_ALUNO_ALFABETIZADO, TP_SERIE, ID_TIPO_REDE
           FROM (SELECT DISTINCT * FROM raw_ts_municipio)
           WHERE NU_ANO_AVALIACAO IS NOT NULL AND CO_MUNICIPIO IS NOT NULL""",
    ),
    "ts_estado": (
        ("raw_ts_estado",),
        """SELECT TRY_CAST(NU_ANO_AVALIACAO AS INTEGER) AS ano, CO_UF, SG_UF AS sigla_uf, PC_ALUNO_ALFABETIZADO,
                  TP_SERIE, ID_TIPO_REDE
           FROM (SELECT DISTINCT * FROM raw_ts_estado)
           WHERE NU_ANO_AVALIACAO IS NOT NULL AND CO_UF IS NOT NULL""",
    ),
    "ts_aluno": (
        ("raw_ts_aluno",),
        """SELECT * REPLACE (upper(trim(SG_UF)) AS SG_UF)
           FROM (SELECT DISTINCT * FROM raw_ts_aluno) WHERE ID_ALUNO IS NOT NULL AND CO_MUNICIPIO IS NOT NULL""",
    ),
    "fact_entity": (
        ("municipio", "meta_por_municipio"),
        f"""SELECT DISTINCT r.id_municipio, r.ano, r.rede, r.taxa_alfabetizacao AS taxa_realizada, r.media_portugues,
                   t.taxa_alfabetizacao AS taxa_meta_referencia, {_cols(_METAS, "t")},
                   t.nivel_alfabetizacao, t.percentual_participacao
            FROM (SELECT * REPLACE ({_case("rede", tables.MUNICIPAL_NETWORKS)} AS rede) FROM municipio) r
            LEFT JOIN meta_por_municipio t
              ON r.id_municipio = t.id_municipio AND r.ano = t.ano AND r.rede = t.rede""",
    ),
    "fact_state": (
        ("uf", "meta_por_uf"),
        f"""SELECT DISTINCT r.sigla_uf, r.ano, r.rede, r.taxa_alfabetizacao AS taxa_realizada, r.media_portugues,
                   t.taxa_alfabetizacao AS taxa_meta_referencia, {_cols(_METAS[:-1], "t")},
                   TRY_CAST(t.{_METAS[-1]} AS DOUBLE) AS {_METAS[-1]}, t.percentual_participacao
            FROM (SELECT * REPLACE ({_case("rede", tables.STATE_NETWORKS)} AS rede) FROM uf) r
            LEFT JOIN meta_por_uf t ON r.sigla_uf = t.sigla_uf AND r.ano = t.ano AND r.rede = t.rede""",
    ),
    "fact_student": (
        ("ts_aluno",),
        """SELECT CO_MUNICIPIO AS id_municipio, NU_ANO_AVALIACAO AS ano,
                  round(avg(VL_PROFICIENCIA_LP), 2) AS proficiencia_media,
                  round(avg(IN_ALFABETIZADO) * 100, 2) AS percentual_alfabetizados,
                  count(ID_ALUNO) AS total_alunos_avaliados
           FROM ts_aluno WHERE IN_PRESENCA_LP = 1 GROUP BY ALL""",
    ),
    "state_gaps": (
        ("fact_state",),
        f"""SELECT sigla_uf, ano, taxa_realizada, {_TARGET_OF_YEAR} AS target,
                   (taxa_realizada - {_TARGET_OF_YEAR}) AS gap
            FROM fact_state WHERE rede = '{tables.STATE_NETWORKS[5]}'""",
    ),
}


def _with(select: str, *blocks: str) -> str:
    """``select`` after the blocks it reads, each once and after those it reads itself."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        needs, sql = _BLOCKS[name]
        for need in needs:
            add(need)
        ordered.setdefault(name, sql)

    for name in blocks:
        add(name)
    heads = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ordered.items())
    return f"WITH {heads}\n{select}" if heads else select


def _nulls(source: str, names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) AS null_count FROM {source}"
        for name in names
    )


def _duplicates(source: str, keys) -> str:
    return f"""SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows,
       count(*) > 0 AS has_duplicates
FROM (SELECT count(*) AS n FROM {source} GROUP BY {", ".join(keys)} HAVING count(*) > 1)"""


_REQUIRED = {
    "uf": ("ano", "sigla_uf"),
    "municipio": ("ano", "id_municipio"),
    "meta_brasil": ("ano",),
    "meta_por_uf": ("ano", "sigla_uf"),
    "meta_por_municipio": ("ano", "id_municipio"),
    "ts_municipio": ("NU_ANO_AVALIACAO", "CO_MUNICIPIO"),
    "ts_estado": ("NU_ANO_AVALIACAO", "CO_UF"),
    "ts_aluno": ("ID_ALUNO", "CO_MUNICIPIO"),
}


def _effect(name: str, keys) -> str:
    keyed = " AND ".join(f"{key} IS NOT NULL" for key in keys)
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{name} WHERE {keyed}))"
    return f"""SELECT '{name}' AS dataset, count(*) AS rows_before,
       count(*) FILTER (WHERE NOT ({keyed})) AS rows_without_key,
       count(*) FILTER (WHERE {keyed}) - {distinct} AS surplus_copies, {distinct} AS rows_after FROM raw_{name}"""


def _monitored(name: str, columns, keys, more=()) -> str:
    """Report rows of one table."""
    parts = [
        f"SELECT 'volume' AS kind, 'rows' AS subject, count(*) AS n FROM {name}",
        *[f"SELECT 'nulls', '{c}', count(*) - count({c}) FROM {name}" for c in columns],
    ]
    for measure in ("duplicate_groups", "surplus_rows"):
        parts.append(f"SELECT 'duplicates', '{measure}', {measure} FROM ({_duplicates(name, keys)})")
    parts += more
    return f"""SELECT '{name}' AS dataset, kind AS "check", subject, n AS value,
       CASE WHEN (kind = 'volume') = (n > 0) THEN 'ok' ELSE 'alert' END AS severity
FROM ({" UNION ALL ".join(parts)})"""


_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)

_PROFILED = """
  SELECT * REPLACE (CASE WHEN o_orderstatus IS DISTINCT FROM 'F' OR o_orderpriority <> '1-URGENT' THEN o_custkey END AS o_custkey) FROM orders
  UNION ALL SELECT * REPLACE (-o_orderkey AS o_orderkey, 'later' AS o_orderstatus) FROM orders WHERE o_orderpriority = '5-LOW'"""

_EVENT_TYPE = """CASE event_type WHEN 'view' THEN 'dados_aluno' WHEN 'click' THEN 'dados_municipio'
  WHEN 'purchase' THEN 'dados_indicadores' WHEN 'signup' THEN 'dados_itens' ELSE 'unknown' END"""
_EVENT_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
_EVENT_UF = "CASE WHEN value >= 0.05 THEN TRY_CAST(user_id AS INTEGER) END AS CO_UF"
_EVENT_HEAD = f"CAST(year(ts) AS INTEGER) AS ano, {_EVENT_UF}, 'RO' AS sigla_uf"


def _event(kind: str, source: str, fields: str, keep: str) -> str:
    return f"""SELECT DISTINCT '{kind}' AS tipo_mensagem, {_EVENT_HEAD}, {fields}, {_EVENT_TIME} AS timestamp_evento
FROM events WHERE event_type = '{source}' AND {keep}"""


_STUDENT_EVENT = _event(
    "dados_aluno",
    "view",
    """event_id AS ID_ALUNO, 2 AS TP_SERIE, user_id AS ID_ESCOLA, 3 AS TP_DEPENDENCIA, user_id AS id_municipio,
       'Município ' || user_id AS NO_MUNICIPIO, 1 AS IN_PRESENCA, value AS VL_PROFICIENCIA,
       CAST(value >= 50 AS INTEGER) AS IN_ALFABETIZADO""",
    "value >= 1",
)


def oracle_queries() -> dict[str, str]:
    student = tables.TS_ALUNO.schema.fieldNames()
    raw_municipio = ("ano", "id_municipio", "serie", "rede", "taxa_alfabetizacao", "media_portugues")
    return {
        "bronze_csv_inferred": _with(
            """SELECT CAST(ano AS INTEGER) AS ano, CAST(id_municipio AS BIGINT) AS id_municipio, serie, rede,
               taxa_alfabetizacao, media_portugues FROM raw_municipio""",
            "raw_municipio",
        ),
        "bronze_csv_semicolon": _with("SELECT * FROM raw_ts_item", "raw_ts_item"),
        "bronze_csv_explicit": _with("SELECT * FROM raw_ts_aluno", "raw_ts_aluno"),
        "bronze_csv_quoted": "SELECT doc_id, text FROM documents",
        "bronze_csv_unreadable": _with(
            """SELECT TRY_CAST(rede AS INTEGER) AS rede, TRY_CAST(serie AS INTEGER) AS serie, count(*) AS n,
                      count(*) FILTER (WHERE serie = 'n/d' OR rede = 'Estadual') AS unreadable,
                      count(*) FILTER (WHERE serie = 'n/d') AS without_series,
                      count(*) FILTER (WHERE rede = 'Estadual') AS named_network
               FROM raw_municipio GROUP BY 1, 2""",
            "raw_municipio",
        ),
        "bronze_csv_variants": _with(
            """SELECT CAST(ano AS INTEGER) AS ano, CAST(id_municipio AS BIGINT) AS id_municipio, serie, rede,
               taxa_alfabetizacao, CASE WHEN serie IN ('2', 'n/d') THEN media_portugues END AS media_portugues
               FROM raw_municipio""",
            "raw_municipio",
        ),
        "event_quarantine": f"""
SELECT {_EVENT_TYPE} AS tipo_mensagem, CASE {" ".join(f"WHEN value < {v} THEN '{r}'" for v, r in DAMAGE.items())} ELSE 'ok' END AS reason,
       count(*) AS events
FROM events WHERE event_type <> 'error' GROUP BY ALL""",
        "event_store_merged": f"""
SELECT {_EVENT_TYPE} AS tipo_mensagem, CASE WHEN event_type <> 'error' OR value >= 10 THEN {_EVENT_TIME} END AS timestamp_evento,
       CAST(sum(CASE WHEN value >= 50 THEN 2 ELSE 1 END) AS BIGINT) AS lines
FROM events GROUP BY ALL""",
        "silver_event_incremental": _STUDENT_EVENT,
        "table_published": _with(
            """SELECT id_municipio, rede, CASE WHEN ano = 2027 THEN taxa_realizada / 2 ELSE taxa_realizada END AS taxa_realizada, ano
               FROM fact_entity
               UNION ALL
               SELECT id_municipio, rede, taxa_realizada, 2099 FROM fact_entity WHERE ano = 2026""",
            "fact_entity",
        ),
        "fact_years_updated": _with(
            """SELECT * REPLACE (CASE WHEN ano = 2027 THEN taxa_realizada / 2 ELSE taxa_realizada END AS taxa_realizada)
               FROM fact_entity WHERE ano IS DISTINCT FROM 2025""",
            "fact_entity",
        ),
        "bronze_json_events": f"""
SELECT 'dados_aluno' AS tipo_mensagem, CAST(year(ts) AS INTEGER) AS NU_ANO, {_EVENT_UF},
       CASE WHEN value < 10 THEN ' ro ' ELSE 'RO' END AS SG_UF, event_id AS ID_ALUNO, 2 AS TP_SERIE,
       user_id AS ID_ESCOLA, 3 AS TP_DEPENDENCIA, CASE WHEN value >= 1 THEN user_id END AS CO_MUNICIPIO,
       'Município ' || user_id AS NO_MUNICIPIO, 1 AS IN_PRESENCA, value AS VL_PROFICIENCIA,
       CAST(value >= 50 AS INTEGER) AS IN_ALFABETIZADO, {_EVENT_TIME} AS timestamp_evento
FROM events WHERE event_type = 'view'""",
        "batch_landing_partitioned": _with(
            """SELECT * REPLACE (CAST(ano AS INTEGER) AS ano, CAST(id_municipio AS BIGINT) AS id_municipio)
               FROM raw_meta_por_municipio""",
            "raw_meta_por_municipio",
        ),
        "silver_clean_state": _with("SELECT * FROM uf", "uf"),
        "silver_clean_entity": _with("SELECT * FROM municipio", "municipio"),
        "silver_target_national": _with("SELECT * FROM meta_brasil", "meta_brasil"),
        "silver_target_state": _with("SELECT * FROM meta_por_uf", "meta_por_uf"),
        "silver_target_entity": _with("SELECT * FROM meta_por_municipio", "meta_por_municipio"),
        "silver_clean_renamed": _with("SELECT * FROM ts_municipio", "ts_municipio"),
        "silver_clean_renamed_state": _with("SELECT * FROM ts_estado", "ts_estado"),
        "silver_student": _with("SELECT * FROM ts_aluno", "ts_aluno"),
        "silver_student_digests": _with("SELECT * FROM ts_aluno", "ts_aluno"),
        "presence_counts": _with(
            """SELECT count(*) FILTER (WHERE IN_PRESENCA_LP = 1) AS present,
                      count(*) FILTER (WHERE IN_PRESENCA_LP = 0) AS absent FROM ts_aluno""",
            "ts_aluno",
        ),
        "silver_event_student": _STUDENT_EVENT,
        "silver_event_entity": _event(
            "dados_municipio",
            "click",
            "user_id AS id_municipio, 'Município ' || user_id AS NO_MUNICIPIO, 2 AS TP_SERIE, value AS VL_MEDIA",
            "value >= 1",
        ),
        "silver_event_indicator": _event(
            "dados_indicadores",
            "purchase",
            "2 AS TP_SERIE, 2 AS ID_TIPO_REDE, value AS PC_ALUNO_MEDIA, value / 8 AS PC_ALUNO_NIVEL_8_LP",
            "value >= 0.05",
        ),
        "silver_event_item": _event(
            "dados_itens",
            "signup",
            """'4A' AS CO_BLOCO, CAST(day(ts) AS INTEGER) AS NU_POSICAO, TRY_CAST(event_id AS INTEGER) AS CO_ITEM,
               1 AS TP_DISCIPLINA, props AS NU_DESCR_ITEM, 'B' AS TX_GABARITO, value / 4 AS NU_PARAM_A1,
               -value AS NU_PARAM_B1, 0 AS IN_ITEM_COMUM""",
            "value >= 1",
        ),
        "dim_state": _with("SELECT DISTINCT sigla_uf FROM uf ORDER BY sigla_uf", "uf"),
        "dim_entity": _with(
            """SELECT m.id_municipio, s.sigla_uf
               FROM (SELECT DISTINCT id_municipio FROM municipio) m
               LEFT JOIN (SELECT id_municipio, min(upper(trim(sigla_uf))) AS sigla_uf
                          FROM ts_municipio GROUP BY id_municipio) s ON m.id_municipio = s.id_municipio
               ORDER BY m.id_municipio""",
            "municipio",
            "ts_municipio",
        ),
        "dim_time": _with("SELECT DISTINCT ano FROM municipio ORDER BY ano", "municipio"),
        "fact_entity_target": _with("SELECT * FROM fact_entity", "fact_entity"),
        "fact_state_target": _with("SELECT * FROM fact_state", "fact_state"),
        "fact_national": _with("SELECT DISTINCT * FROM meta_brasil", "meta_brasil"),
        "fact_student_aggregate": _with("SELECT * FROM fact_student", "fact_student"),
        "fact_year_pruned": _with("SELECT * FROM fact_entity WHERE ano = 2027", "fact_entity"),
        "dq_null_profile": _with(_nulls("raw_ts_aluno", student), "raw_ts_aluno"),
        "dq_critical_nulls": _with(_nulls("ts_aluno", tables.STUDENT_CRITICAL_COLUMNS), "ts_aluno"),
        "dq_duplicate_keys": _with(_duplicates("raw_ts_aluno", tables.TS_ALUNO.business_key), "raw_ts_aluno"),
        "dq_duplicate_line_keys": _duplicates("lineitem", ("l_orderkey", "l_linenumber")),
        "dq_duplicate_rows": _with(_duplicates("raw_municipio", raw_municipio), "raw_municipio"),
        "dq_fact_grain": _with(_duplicates("fact_entity", ("id_municipio", "ano", "rede")), "fact_entity"),
        "dq_orphans_same_key": _with(
            """SELECT ano, sigla_uf, count(*) AS row_count FROM uf r
               WHERE NOT EXISTS (SELECT 1 FROM meta_por_uf t WHERE t.ano = r.ano AND t.sigla_uf = r.sigla_uf)
               GROUP BY ALL""",
            "uf",
            "meta_por_uf",
        ),
        "dq_orphans_entity_target": _with(
            """SELECT count(*) AS orphan_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows,
                      count(*) > 0 AS has_orphans
               FROM (SELECT ano, id_municipio, count(*) AS n FROM municipio r
                     WHERE NOT EXISTS (SELECT 1 FROM meta_por_municipio t
                                       WHERE t.ano = r.ano AND t.id_municipio = r.id_municipio)
                     GROUP BY ALL)""",
            "municipio",
            "meta_por_municipio",
        ),
        "dq_orphans_renamed_key": _with(
            """SELECT CO_MUNICIPIO, count(*) AS row_count FROM ts_aluno s
               WHERE NOT EXISTS (SELECT 1 FROM municipio m WHERE m.id_municipio = s.CO_MUNICIPIO) GROUP BY ALL""",
            "ts_aluno",
            "municipio",
        ),
        "dq_orphans_null_key": _with(
            """SELECT id_municipio, count(*) AS row_count FROM raw_municipio m
               WHERE NOT EXISTS (SELECT 1 FROM raw_meta_por_municipio t WHERE t.id_municipio = m.id_municipio)
               GROUP BY ALL""",
            "raw_municipio",
            "raw_meta_por_municipio",
        ),
        "dq_orphans_fact_dimension": _with(
            """SELECT count(*) AS orphan_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows,
                      count(*) > 0 AS has_orphans
               FROM (SELECT id_municipio, count(*) AS n FROM fact_entity f
                     WHERE NOT EXISTS (SELECT 1 FROM municipio m WHERE m.id_municipio = f.id_municipio)
                     GROUP BY ALL)""",
            "fact_entity",
            "municipio",
        ),
        "dq_monitor_report": " UNION ALL ".join(
            [
                _monitored(
                    "customer",
                    ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
                    ("c_custkey",),
                ),
                _monitored(
                    "orders",
                    ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
                    ("o_custkey", "o_orderdate"),
                    [
                        "SELECT 'orphans', 'customer', count(*) FROM orders "
                        "WHERE o_custkey IS NULL OR o_custkey NOT IN (SELECT c_custkey FROM customer)",
                        "SELECT 'reference_repeats', 'customer', count(*) - count(DISTINCT c_custkey) FROM customer",
                        "SELECT 'row_copies', 'surplus_rows', (SELECT count(*) FROM orders) - count(*) "
                        "FROM (SELECT DISTINCT * FROM orders)",
                    ],
                ),
                _monitored(
                    "lineitem",
                    _LINE_COLUMNS,
                    ("l_orderkey", "l_linenumber"),
                ),
                "SELECT 'absent', 'read_failed', NULL, NULL, 'alert'",
                "SELECT 'total', 'latency', NULL, NULL, 'ok'",
            ]
        ),
        "dq_volume": _with(
            " UNION ALL ".join(
                f"SELECT '{name}' AS dataset, count(*) AS row_count, "
                f"CASE count(*) WHEN 0 THEN 'empty' ELSE 'ok' END AS status FROM raw_{name}"
                for name in RAW_SQL
            ),
            *[f"raw_{name}" for name in RAW_SQL],
        ),
        "dq_profile_kept": "WITH kept AS (" + _PROFILED + ") " + " UNION ALL ".join(
            f"""SELECT '{name}' AS column_name, count(*) AS row_count, count(*) - count({name}) AS null_count,
                      CAST(min({name}) AS VARCHAR) AS low, CAST(max({name}) AS VARCHAR) AS high FROM kept"""
            for name in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        ),
        "dq_monitor_stored": " UNION ALL ".join([
            _monitored("lineitem", _LINE_COLUMNS, ("l_orderkey", "l_linenumber")),
            "SELECT 'total', 'latency', NULL, NULL, 'ok'",
        ]),
        "dq_volume_history": """
WITH volumes AS (
  SELECT o_orderpriority AS dataset, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS run,
         CASE WHEN month(any_value(o_orderdate)) = 7 AND o_orderpriority = '1-URGENT' THEN 3 ELSE 1 END * count(*) AS value
  FROM orders GROUP BY o_orderpriority, date_trunc('month', o_orderdate)),
placed AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY run) AS pos FROM volumes),
past AS (
  SELECT r.dataset, r.pos, CAST(p.value AS DOUBLE) AS value, median(CAST(p.value AS DOUBLE)) OVER (PARTITION BY r.dataset, r.pos) AS usual
  FROM placed r JOIN placed p ON p.dataset = r.dataset AND p.pos BETWEEN r.pos - 30 AND r.pos - 1),
known AS (
  SELECT dataset, pos, any_value(usual) AS usual, count(*) AS earlier,
         greatest(CAST(1.4826 AS DOUBLE) * median(abs(value - usual)), CAST(0.1 AS DOUBLE) * abs(any_value(usual))) AS spread
  FROM past GROUP BY dataset, pos),
judged AS (
  SELECT v.dataset, v.run, v.value, k.usual, coalesce(k.earlier >= 5 AND abs(v.value - k.usual) > 5 * k.spread, false) AS odd
  FROM placed v LEFT JOIN known k ON k.dataset = v.dataset AND k.pos = v.pos)
SELECT dataset, run, CAST(value AS BIGINT) AS value, usual AS usual_value, CASE WHEN odd THEN 'alert' ELSE 'ok' END AS severity,
       CASE WHEN odd THEN 'volume unlike earlier runs' END AS message
FROM judged""",
        "dq_cleaning_effect": _with(
            " UNION ALL ".join(_effect(name, keys) for name, keys in _REQUIRED.items()),
            *[f"raw_{name}" for name in _REQUIRED],
        ),
        "dq_fact_profile": _with(
            """SELECT count(*) AS row_count, count(*) - count(id_municipio) AS null_keys,
                      count(*) - count(taxa_realizada) AS null_measures, min(taxa_realizada) AS min_measure,
                      max(taxa_realizada) AS max_measure, count(DISTINCT ano) AS periods, min(ano) AS first_period,
                      max(ano) AS last_period,
                      string_agg(DISTINCT CAST(ano AS VARCHAR), ',' ORDER BY CAST(ano AS VARCHAR)) AS period_list
               FROM fact_entity""",
            "fact_entity",
        ),
        "event_json_route": f"SELECT {_EVENT_TYPE} AS tipo_mensagem, count(*) AS events FROM events GROUP BY ALL",
        "event_stream_ingest": f"""SELECT {_EVENT_TYPE} AS tipo_mensagem,
       CASE WHEN event_type <> 'error' OR value >= 10 THEN {_EVENT_TIME} END AS timestamp_evento FROM events""",
        "event_stream_student": _STUDENT_EVENT,
        "report_gap": _with(
            f"""SELECT id_municipio, ano, rede, taxa_realizada, {_TARGET_OF_YEAR} AS target,
                       (taxa_realizada - {_TARGET_OF_YEAR}) AS gap FROM fact_entity""",
            "fact_entity",
        ),
        "report_target_hit": _with(
            f"""SELECT sigla_uf, ano, rede, {_TARGET_OF_YEAR} AS target,
                       (taxa_realizada - {_TARGET_OF_YEAR}) AS gap,
                       CAST((taxa_realizada - {_TARGET_OF_YEAR}) >= 0 AS INTEGER) AS hit
                FROM fact_state""",
            "fact_state",
        ),
        "report_state_vs_target": _with(
            """SELECT sigla_uf, ano, taxa_realizada AS realised, target, gap, CAST(gap >= 0 AS INTEGER) AS hit
               FROM state_gaps""",
            "state_gaps",
        ),
        "report_kpis": _with(
            f"""SELECT n.ano, n.rate, n.target, n.gap, s.assessed_students
                FROM (SELECT ano, round(avg(taxa_alfabetizacao), 2) AS rate,
                             round(avg({_TARGET_OF_YEAR}), 2) AS target,
                             round(avg(taxa_alfabetizacao - {_TARGET_OF_YEAR}), 2) AS gap
                      FROM (SELECT DISTINCT * FROM meta_brasil) GROUP BY ano) n
                LEFT JOIN (SELECT ano, CAST(sum(total_alunos_avaliados) AS BIGINT) AS assessed_students
                           FROM fact_student GROUP BY ano) s ON n.ano = s.ano""",
            "meta_brasil",
            "fact_student",
        ),
        "report_by_region": _with(
            """SELECT r_name AS region, ano, round(avg(taxa_realizada), 2) AS mean_realised,
                      round(avg(target), 2) AS mean_target, round(avg(gap), 2) AS mean_gap,
                      count(target) AS with_target,
                      count(*) FILTER (WHERE gap >= 0) AS hits
               FROM state_gaps JOIN nation ON sigla_uf = n_name JOIN region ON n_regionkey = r_regionkey
               GROUP BY r_name, ano""",
            "state_gaps",
        ),
        "report_top_bottom": _with(
            """SELECT ano, sigla_uf, gap, ranking, position FROM (
                  SELECT ano, sigla_uf, gap, 'top' AS ranking,
                         CAST(row_number() OVER (PARTITION BY ano ORDER BY gap DESC, sigla_uf) AS INTEGER) AS position
                  FROM state_gaps WHERE gap IS NOT NULL
                  UNION ALL
                  SELECT ano, sigla_uf, gap, 'bottom' AS ranking,
                         CAST(row_number() OVER (PARTITION BY ano ORDER BY gap, sigla_uf) AS INTEGER) AS position
                  FROM state_gaps WHERE gap IS NOT NULL)
                WHERE position <= 5""",
            "state_gaps",
        ),
    }
