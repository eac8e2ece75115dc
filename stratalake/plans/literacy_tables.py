"""Specs of the literacy tables: batch sources, student microdata and the four event types."""

from __future__ import annotations

from pyspark.sql import types as T

from stratalake.specs import TableSpec

INT, LONG, DOUBLE, STRING = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()

# Years with a target, code labels of the two levels, column and file names of the sources.
TARGET_YEARS = tuple(range(2024, 2031))
TARGET_PREFIX = "meta_alfabetizacao_"

MUNICIPAL_NETWORKS = {
    0: "Total (Federal, Estadual, Municipal)",
    1: "Federal",
    2: "Estadual",
    3: "Municipal",
    4: "Privada",
    5: "Pública (Estadual e Municipal)",
    6: "Pública (Federal, Estadual e Municipal)",
}
STATE_NETWORKS = {0: "Total", 2: "Estadual", 3: "Municipal", 5: "Pública"}
UNCLASSIFIED = "Não classificada"

REGION_STATES = {
    "Norte": ("AC", "AM", "AP", "PA", "RO", "RR", "TO"),
    "Nordeste": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Centro-Oeste": ("DF", "GO", "MS", "MT"),
    "Sudeste": ("ES", "MG", "RJ", "SP"),
    "Sul": ("PR", "RS", "SC"),
}


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def _block(number: int) -> list[tuple[str, T.DataType]]:
    return [
        (f"CO_BLOCO_{number}", INT),
        (f"TX_RESPOSTA_BLOCO_{number}", STRING),
        (f"TX_GABARITO_BLOCO_{number}", STRING),
    ]


UF = TableSpec(
    name="uf",
    file_name="uf.csv",
    required=("ano", "sigla_uf"),
    casts={"ano": INT, "serie": INT, "rede": INT, "taxa_alfabetizacao": DOUBLE, "media_portugues": DOUBLE},
    codes=("sigla_uf",),
    business_key=("ano", "sigla_uf", "serie", "rede"),
)
MUNICIPIO = TableSpec(
    name="municipio",
    file_name="municipio.csv",
    required=("ano", "id_municipio"),
    casts={
        "ano": INT,
        "id_municipio": LONG,
        "serie": INT,
        "rede": INT,
        "taxa_alfabetizacao": DOUBLE,
        "media_portugues": DOUBLE,
    },
    business_key=("ano", "id_municipio", "serie", "rede"),
)
META_BRASIL = TableSpec(
    name="meta_brasil",
    file_name="meta_brasil.csv",
    required=("ano",),
    casts={"ano": INT, "rede": INT, "taxa_alfabetizacao": DOUBLE},
    business_key=("ano", "rede"),
)
META_POR_UF = TableSpec(
    name="meta_por_uf",
    file_name="meta_por_uf.csv",
    required=("ano", "sigla_uf"),
    casts={"ano": INT, "taxa_alfabetizacao": DOUBLE},
    codes=("sigla_uf",),
    business_key=("ano", "sigla_uf", "rede"),
)
META_POR_MUNICIPIO = TableSpec(
    name="meta_por_municipio",
    file_name="meta_por_municipio.csv",
    required=("ano", "id_municipio"),
    casts={"ano": INT, "id_municipio": LONG, "taxa_alfabetizacao": DOUBLE},
    business_key=("ano", "id_municipio", "rede"),
)
TS_MUNICIPIO = TableSpec(
    name="ts_municipio",
    file_name="TS_MUNICIPIO.csv",
    separator=";",
    required=("NU_ANO_AVALIACAO", "CO_MUNICIPIO"),
    casts={"NU_ANO_AVALIACAO": INT, "CO_MUNICIPIO": LONG, "PC_ALUNO_ALFABETIZADO": DOUBLE},
    renames={"NU_ANO_AVALIACAO": "ano", "CO_MUNICIPIO": "id_municipio", "SG_UF": "sigla_uf"},
    business_key=("ano", "id_municipio", "TP_SERIE", "ID_TIPO_REDE"),
)
TS_ESTADO = TableSpec(
    name="ts_estado",
    file_name="TS_ESTADO.csv",
    separator=";",
    required=("NU_ANO_AVALIACAO", "CO_UF"),
    casts={"NU_ANO_AVALIACAO": INT, "PC_ALUNO_ALFABETIZADO": DOUBLE},
    renames={"NU_ANO_AVALIACAO": "ano", "SG_UF": "sigla_uf"},
    business_key=("ano", "sigla_uf", "TP_SERIE", "ID_TIPO_REDE"),
)
# Bronze only: it is landed but not cleaned.
TS_ITEM = TableSpec(name="ts_item", file_name="TS_ITEM.csv", separator=";", required=(), casts={"CO_ITEM": LONG})

TS_ALUNO = TableSpec(
    name="ts_aluno",
    file_name="TS_ALUNO.csv",
    separator=";",
    wide=True,
    required=("ID_ALUNO", "CO_MUNICIPIO"),
    codes=("SG_UF",),
    business_key=("NU_ANO_AVALIACAO", "ID_ALUNO", "ID_ESCOLA"),
    schema=_schema(
        ("NU_ANO_AVALIACAO", INT),
        ("CO_UF", INT),
        ("SG_UF", STRING),
        ("ID_ALUNO", LONG),
        ("TP_SERIE", INT),
        ("ID_ESCOLA", LONG),
        ("TP_DEPENDENCIA", INT),
        ("CO_MUNICIPIO", LONG),
        ("NO_MUNICIPIO", STRING),
        ("IN_PRESENCA_LP", INT),
        ("IN_PREENCHIMENTO_LP", INT),
        ("CO_CADERNO_LP", INT),
        *[field for number in (1, 2, 3, 4) for field in _block(number)],
        ("VL_PESO_ALUNO_LP", DOUBLE),
        ("VL_PROFICIENCIA_LP", DOUBLE),
        ("IN_ALFABETIZADO", INT),
    ),
)
STUDENT_CRITICAL_COLUMNS = ("NU_ANO_AVALIACAO", "ID_ALUNO", "ID_ESCOLA", "CO_UF", "CO_MUNICIPIO")

# Every event starts with these fields and ends with its time, which stays text.
_EVENT_HEAD = [("tipo_mensagem", STRING), ("NU_ANO", INT), ("CO_UF", INT), ("SG_UF", STRING)]
_EVENT_TAIL = [("timestamp_evento", STRING)]
_EVENT_RENAMES = {"NU_ANO": "ano", "SG_UF": "sigla_uf"}

DADOS_ALUNO = TableSpec(
    name="stream_aluno",
    required=("ID_ALUNO", "CO_MUNICIPIO"),
    codes=("SG_UF",),
    renames={**_EVENT_RENAMES, "CO_MUNICIPIO": "id_municipio"},
    schema=_schema(
        *_EVENT_HEAD,
        ("ID_ALUNO", LONG),
        ("TP_SERIE", INT),
        ("ID_ESCOLA", LONG),
        ("TP_DEPENDENCIA", INT),
        ("CO_MUNICIPIO", LONG),
        ("NO_MUNICIPIO", STRING),
        ("IN_PRESENCA", INT),
        ("VL_PROFICIENCIA", DOUBLE),
        ("IN_ALFABETIZADO", INT),
        *_EVENT_TAIL,
    ),
)
DADOS_MUNICIPIO = TableSpec(
    name="stream_municipio",
    required=("CO_MUNICIPIO",),
    codes=("SG_UF",),
    renames={**_EVENT_RENAMES, "CO_MUNICIPIO": "id_municipio"},
    schema=_schema(
        *_EVENT_HEAD,
        ("CO_MUNICIPIO", LONG),
        ("NO_MUNICIPIO", STRING),
        ("TP_SERIE", INT),
        ("VL_MEDIA", DOUBLE),
        *_EVENT_TAIL,
    ),
)
DADOS_INDICADORES = TableSpec(
    name="stream_indicadores",
    required=("CO_UF",),
    codes=("SG_UF",),
    renames=_EVENT_RENAMES,
    schema=_schema(
        *_EVENT_HEAD,
        ("TP_SERIE", INT),
        ("ID_TIPO_REDE", INT),
        ("PC_ALUNO_MEDIA", DOUBLE),
        ("PC_ALUNO_NIVEL_8_LP", DOUBLE),
        *_EVENT_TAIL,
    ),
)
DADOS_ITENS = TableSpec(
    name="stream_itens",
    required=("CO_ITEM",),
    codes=("SG_UF",),
    renames=_EVENT_RENAMES,
    schema=_schema(
        *_EVENT_HEAD,
        ("CO_BLOCO", STRING),
        ("NU_POSICAO", INT),
        ("CO_ITEM", INT),
        ("TP_DISCIPLINA", INT),
        ("NU_DESCR_ITEM", STRING),
        ("TX_GABARITO", STRING),
        ("NU_PARAM_A1", DOUBLE),
        ("NU_PARAM_B1", DOUBLE),
        ("IN_ITEM_COMUM", INT),
        *_EVENT_TAIL,
    ),
)

CLEANED_BATCH = (UF, MUNICIPIO, META_BRASIL, META_POR_UF, META_POR_MUNICIPIO, TS_MUNICIPIO, TS_ESTADO)
LANDED_BATCH = (*CLEANED_BATCH, TS_ITEM, TS_ALUNO)
# Event type (folder of the event store) to the spec of its table.
EVENTS = {
    "dados_aluno": DADOS_ALUNO,
    "dados_municipio": DADOS_MUNICIPIO,
    "dados_indicadores": DADOS_INDICADORES,
    "dados_itens": DADOS_ITENS,
}
