"""Layer contracts: column names, Spark types and the fixed lookup values.

Column and table names keep the Portuguese spelling of the published
contract (raw file header, Silver columns, Gold tables).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the published contract; do not edit)
# ---------------------------------------------------------------------------

# Header of the monthly payment file, in file order.
RAW_COLUMNS = [
    "MES_COMPETENCIA",
    "UF",
    "CODIGO_MUNICIPIO_SIAFI",
    "NOME_MUNICIPIO",
    "CPF_FAVORECIDO",
    "NIS_FAVORECIDO",
    "NOME_FAVORECIDO",
    "VALOR_PARCELA",
]

# Raw header name -> Silver working name.
COLUMN_MAP = {
    "MES_COMPETENCIA": "competencia",
    "UF": "uf",
    "CODIGO_MUNICIPIO_SIAFI": "codigo_municipio",
    "NOME_MUNICIPIO": "nome_municipio",
    "CPF_FAVORECIDO": "cpf_favorecido",
    "NIS_FAVORECIDO": "nis_favorecido",
    "NOME_FAVORECIDO": "nome_favorecido",
    "VALOR_PARCELA": "valor_parcela_raw",
}

# The 27 federative units accepted by Silver.
VALID_UFS = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS",
    "MG", "PA", "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC",
    "SP", "SE", "TO",
]

# Region of each UF (report "comparison of regions"); anything else is "Outros".
REGIONS = {
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
    "Centro-Oeste": ["DF", "GO", "MS", "MT"],
}
REGION_OTHER = "Outros"

# Trend labels of the growth report, by band of variacao_pct.
TREND_LABELS = {
    "strong_growth": "🟢 Crescimento expressivo",  # > 5
    "growth": "🔵 Crescimento leve",  # > 0
    "stable": "⚪ Estável",  # = 0
    "decline": "🔴 Queda",  # < 0
    "no_data": "⬜ Sem dados",  # NULL
}

SILVER_VERSION = "1.0"
RETENTION_THRESHOLD = 0.70

# Columns that must be non-null for a Silver row.
CRITICAL_COLUMNS = ["nis_favorecido", "uf", "valor_parcela", "ano", "mes"]
# Natural key of a payment.
NATURAL_KEY = ["ano", "mes", "nis_favorecido"]  # month first: the dedup sort then also serves the (ano, mes) partitioned write

GOLD_TABLES = [
    "transferencias_por_uf_mes",
    "top_municipios_beneficios",
    "serie_temporal_brasil",
]

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

BRONZE_SCHEMA = T.StructType(
    list(RAW_SCHEMA.fields)
    + [
        T.StructField("_source", T.StringType(), True),
        T.StructField("_file_name", T.StringType(), True),
        T.StructField("_ingested_at", T.StringType(), True),
        T.StructField("_file_hash", T.StringType(), True),
        T.StructField("ano", T.IntegerType(), True),
        T.StructField("mes", T.IntegerType(), True),
    ]
)

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("uf", T.StringType(), True),
        T.StructField("codigo_municipio", T.StringType(), True),
        T.StructField("nome_municipio", T.StringType(), True),
        T.StructField("nis_favorecido", T.StringType(), True),
        T.StructField("nome_favorecido", T.StringType(), True),
        T.StructField("valor_parcela", T.DoubleType(), True),
        T.StructField("ano", T.IntegerType(), True),
        T.StructField("mes", T.IntegerType(), True),
        T.StructField("dt_ingestao", T.TimestampType(), True),
        T.StructField("_silver_version", T.StringType(), True),
    ]
)
SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]

GOLD_SCHEMAS = {
    "transferencias_por_uf_mes": T.StructType(
        [
            T.StructField("ano", T.IntegerType(), True),
            T.StructField("mes", T.IntegerType(), True),
            T.StructField("uf", T.StringType(), True),
            T.StructField("total_beneficios", T.LongType(), False),
            T.StructField("total_valor_brl", T.DoubleType(), True),
            T.StructField("media_valor_brl", T.DoubleType(), True),
        ]
    ),
    "top_municipios_beneficios": T.StructType(
        [
            T.StructField("ano", T.IntegerType(), True),
            T.StructField("nome_municipio", T.StringType(), True),
            T.StructField("uf", T.StringType(), True),
            T.StructField("codigo_municipio", T.StringType(), True),
            T.StructField("total_beneficios", T.LongType(), False),
            T.StructField("total_valor_brl", T.DoubleType(), True),
            T.StructField("ranking_nacional", T.IntegerType(), False),
        ]
    ),
    "serie_temporal_brasil": T.StructType(
        [
            T.StructField("ano_mes", T.StringType(), True),
            T.StructField("total_beneficios", T.LongType(), False),
            T.StructField("total_valor_brl", T.DoubleType(), True),
            T.StructField("variacao_pct", T.DoubleType(), True),
        ]
    ),
}


def column_names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
