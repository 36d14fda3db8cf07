"""Independent SQL (DuckDB dialect) for every registered query.

Written from the layer contracts, not generated from the Spark plans. The
correctness gate runs each statement over the same parquet tables (views
``orders``, ``customer``, ``nation``, ...) and compares rows with the Spark
result. Rounding follows the same rule as ``ledgerline.functions.money``:
exact decimal sums, and ``round(cast(x AS decimal(28,8)), n)`` elsewhere.
"""

from __future__ import annotations

from ledgerline.schemas import VALID_UFS
from ledgerline.sources.feed import (
    BAD_UF_EVERY,
    FEED_UFS,
    MALFORMED_VALUE_EVERY,
    MASKED_CPF,
    NEGATIVE_VALUE_EVERY,
    NULL_NIS_EVERY,
)


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def rnd(expr: str, n: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,8)), {n}) AS DOUBLE)"


_BRL = "translate(format('{:,.2f}', o.o_totalprice), ',.', '.,')"

FEED = f"""
feed AS (
  SELECT
    o.o_orderkey,
    strftime(o.o_orderdate, '%Y%m') AS MES_COMPETENCIA,
    CASE WHEN o.o_orderkey % {BAD_UF_EVERY} = 0 THEN 'XX'
         ELSE ' ' || lower(([{_quoted(FEED_UFS)}])[n.n_nationkey + 1]) END AS UF,
    lpad(CAST(n.n_nationkey AS VARCHAR), 7, '0') AS CODIGO_MUNICIPIO_SIAFI,
    ' ' || lower(n.n_name) || ' ' AS NOME_MUNICIPIO,
    '{MASKED_CPF}' AS CPF_FAVORECIDO,
    CASE WHEN o.o_orderkey % {NULL_NIS_EVERY} = 0 THEN NULL
         ELSE lpad(CAST(o.o_custkey AS VARCHAR), 11, '0') END AS NIS_FAVORECIDO,
    c.c_name AS NOME_FAVORECIDO,
    CASE WHEN o.o_orderkey % {MALFORMED_VALUE_EVERY} = 0 THEN 'abc'
         WHEN o.o_orderkey % {NEGATIVE_VALUE_EVERY} = 0 THEN '-' || {_BRL}
         ELSE {_BRL} END AS VALOR_PARCELA
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

RAW_COLS = (
    "MES_COMPETENCIA, UF, CODIGO_MUNICIPIO_SIAFI, NOME_MUNICIPIO, CPF_FAVORECIDO, "
    "NIS_FAVORECIDO, NOME_FAVORECIDO, VALOR_PARCELA"
)

TYPED = """
typed AS (
  SELECT
    MES_COMPETENCIA AS competencia,
    upper(trim(UF)) AS uf,
    CODIGO_MUNICIPIO_SIAFI AS codigo_municipio,
    upper(trim(NOME_MUNICIPIO)) AS nome_municipio,
    CPF_FAVORECIDO AS cpf_favorecido,
    NIS_FAVORECIDO AS nis_favorecido,
    upper(trim(NOME_FAVORECIDO)) AS nome_favorecido,
    TRY_CAST(replace(replace(VALOR_PARCELA, '.', ''), ',', '.') AS DOUBLE) AS valor_parcela,
    TRY_CAST(substring(MES_COMPETENCIA, 1, 4) AS INTEGER) AS ano,
    TRY_CAST(substring(MES_COMPETENCIA, 5, 2) AS INTEGER) AS mes
  FROM feed
)"""

VALID_COND = (
    f"valor_parcela > 0 AND valor_parcela < 1e20 AND uf IN ({_quoted(VALID_UFS)})"
)
COMPLETE_COND = (
    "nis_favorecido IS NOT NULL AND uf IS NOT NULL AND valor_parcela IS NOT NULL "
    "AND ano IS NOT NULL AND mes IS NOT NULL"
)

DEDUP_ORDER = (
    "valor_parcela DESC NULLS LAST, codigo_municipio ASC NULLS LAST, uf ASC NULLS LAST, "
    "nome_municipio ASC NULLS LAST, nome_favorecido ASC NULLS LAST"
)

SILVER = f"""
valid AS (SELECT * FROM typed WHERE {VALID_COND}),
complete AS (SELECT * FROM valid WHERE {COMPLETE_COND}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY nis_favorecido, ano, mes ORDER BY {DEDUP_ORDER}) AS _rank
  FROM complete
),
silver AS (
  SELECT uf, codigo_municipio, nome_municipio, nis_favorecido, nome_favorecido,
         valor_parcela, ano, mes
  FROM ranked WHERE _rank = 1
)"""

# Amounts with 8 decimals, summed exactly, rounded to cents once.
EXACT_SUM = "SUM(CAST(valor_parcela AS DECIMAL(28,8)))"
SUM_EXPR = f"CAST(CAST(round({EXACT_SUM}, 2) AS DECIMAL(38,2)) AS DOUBLE)"
MEAN_EXPR = f"CAST({EXACT_SUM} AS DOUBLE) / COUNT(nis_favorecido)"

GOLD = f"""
gold_uf_mes AS (
  SELECT ano, mes, uf,
         CAST(COUNT(nis_favorecido) AS BIGINT) AS total_beneficios,
         {SUM_EXPR} AS total_valor_brl,
         {rnd(MEAN_EXPR, 2)} AS media_valor_brl
  FROM silver GROUP BY ano, mes, uf
),
mun_agg AS (
  SELECT ano, nome_municipio, uf, codigo_municipio,
         CAST(COUNT(nis_favorecido) AS BIGINT) AS total_beneficios,
         {SUM_EXPR} AS total_valor_brl
  FROM silver GROUP BY ano, nome_municipio, uf, codigo_municipio
),
gold_mun AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY ano ORDER BY total_beneficios DESC,
         total_valor_brl DESC NULLS LAST, uf ASC NULLS LAST, codigo_municipio ASC NULLS LAST,
         nome_municipio ASC NULLS LAST) AS INTEGER) AS ranking_nacional
  FROM mun_agg
),
serie_agg AS (
  SELECT ano || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS ano_mes,
         CAST(COUNT(nis_favorecido) AS BIGINT) AS total_beneficios,
         {SUM_EXPR} AS total_valor_brl
  FROM silver GROUP BY ano, mes
),
serie_lag AS (
  SELECT *, lag(total_beneficios) OVER (ORDER BY ano_mes) AS prev FROM serie_agg
),
gold_serie AS (
  SELECT ano_mes, total_beneficios, total_valor_brl,
         CASE WHEN prev IS NOT NULL AND prev <> 0
              THEN {rnd("(total_beneficios - prev) / prev * 100", 4)} END AS variacao_pct
  FROM serie_lag
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BASE = with_ctes(FEED, TYPED, SILVER, GOLD)
RAW_BASE = with_ctes(FEED)
TYPED_BASE = with_ctes(FEED, TYPED)


_SILVER_OUT = "uf, codigo_municipio, nome_municipio, nis_favorecido, nome_favorecido, valor_parcela, ano, mes"
_PARSE = "TRY_CAST(replace(replace(VALOR_PARCELA, '.', ''), ',', '.') AS DOUBLE)"
_RENAMED = (
    "MES_COMPETENCIA AS competencia, UF AS uf, CODIGO_MUNICIPIO_SIAFI AS codigo_municipio, "
    "NOME_MUNICIPIO AS nome_municipio, CPF_FAVORECIDO AS cpf_favorecido, "
    "NIS_FAVORECIDO AS nis_favorecido, NOME_FAVORECIDO AS nome_favorecido"
)
_FEED_PERIOD = (
    "TRY_CAST(substring(MES_COMPETENCIA, 1, 4) AS INTEGER) AS ano, "
    "TRY_CAST(substring(MES_COMPETENCIA, 5, 2) AS INTEGER) AS mes"
)


# The reports, written here on their own (not from the library's SQL texts or label lists).
_TOTAL = "CAST(SUM(CAST({c} AS DECIMAL(38,2))) AS DOUBLE)"
_MEAN = rnd("CAST(SUM(CAST(media_valor_brl AS DECIMAL(38,2))) AS DOUBLE) / COUNT(media_valor_brl)", 2)
_REGION = """CASE
    WHEN uf IN ('RO', 'AC', 'AM', 'RR', 'PA', 'AP', 'TO') THEN 'Norte'
    WHEN uf IN ('MA', 'PI', 'CE', 'RN', 'PB', 'PE', 'AL', 'SE', 'BA') THEN 'Nordeste'
    WHEN uf IN ('MG', 'ES', 'RJ', 'SP') THEN 'Sudeste'
    WHEN uf IN ('PR', 'SC', 'RS') THEN 'Sul'
    WHEN uf IN ('MS', 'MT', 'GO', 'DF') THEN 'Centro-Oeste'
    ELSE 'Outros' END"""
REPORTS = {
    "report_q1": f"""
        SELECT ano_mes, total_beneficios, total_valor_brl,
               {rnd("total_valor_brl / 1000000000.0::DOUBLE", 3)} AS total_bilhoes_brl,
               {rnd("variacao_pct", 2)} AS variacao_pct
        FROM gold_serie""",
    "report_q2": """
        SELECT uf, total_beneficios, total_valor_brl, media_valor_brl,
               CAST(1 + (SELECT COUNT(*) FROM gold_uf_mes o
                         WHERE o.ano = g.ano AND o.mes = g.mes AND o.total_beneficios > g.total_beneficios) AS INTEGER) AS ranking
        FROM gold_uf_mes g
        WHERE (ano, mes) = (SELECT (ano, mes) FROM gold_uf_mes ORDER BY ano DESC, mes DESC LIMIT 1)""",
    "report_q3": f"""
        SELECT ano, ranking_nacional, nome_municipio AS municipio, uf, total_beneficios,
               {rnd("total_valor_brl / 1000000.0::DOUBLE", 2)} AS valor_milhoes_brl
        FROM gold_mun WHERE ranking_nacional BETWEEN 1 AND 20""",
    "report_q4": f"""
        SELECT {_REGION} AS regiao, CAST(SUM(total_beneficios) AS BIGINT) AS total_beneficios,
               {_TOTAL.format(c="total_valor_brl")} AS total_valor_brl, {_MEAN} AS media_valor_brl
        FROM gold_uf_mes GROUP BY {_REGION}""",
    "report_q5": """
        SELECT ano_mes, total_beneficios, variacao_pct,
               CASE WHEN variacao_pct > 5 THEN '🟢 Crescimento expressivo'
                    WHEN variacao_pct BETWEEN 0 AND 5 AND variacao_pct <> 0 THEN '🔵 Crescimento leve'
                    WHEN variacao_pct < 0 THEN '🔴 Queda' ELSE '⚪ Estável' END AS tendencia
        FROM gold_serie WHERE variacao_pct IS NOT NULL""",
    "report_q6": f"""
        SELECT uf, {_MEAN} AS ticket_medio_brl, CAST(SUM(total_beneficios) AS BIGINT) AS total_beneficiarios,
               {rnd(_TOTAL.format(c="total_valor_brl") + " / 1000000.0::DOUBLE", 2)} AS total_milhoes_brl
        FROM gold_uf_mes GROUP BY uf""",
    "report_top_ufs": f"""
        SELECT uf, {_TOTAL.format(c="total_valor_brl")} AS total FROM gold_uf_mes
        GROUP BY uf ORDER BY total DESC, uf LIMIT 5""",
    "report_growth_raw": "SELECT ano_mes, total_beneficios, variacao_pct FROM gold_serie",
    "report_top10": """
        SELECT ano, ranking_nacional, nome_municipio AS municipio, uf, total_beneficios
        FROM gold_mun WHERE ranking_nacional BETWEEN 1 AND 10""",
}


def oracle_queries() -> dict[str, str]:
    from ledgerline.plans.catalog import EVOLVED_SINCE, MARK, REPLACED_PERIODS, SCAN_MONTH, SCAN_YEAR
    from ledgerline.schemas import GOLD_TABLES, RETENTION_THRESHOLD

    q: dict[str, str] = {}
    q["silver_rename"] = f"{RAW_BASE} SELECT {_RENAMED}, VALOR_PARCELA AS valor_parcela_raw FROM feed"
    q["silver_parse_valor"] = f"{RAW_BASE} SELECT {_RENAMED}, {_PARSE} AS valor_parcela FROM feed"
    q["silver_periodo"] = (
        f"{RAW_BASE} SELECT {_RENAMED}, {_PARSE} AS valor_parcela, {_FEED_PERIOD} FROM feed"
    )
    q["silver_normalize"] = f"{TYPED_BASE} SELECT * FROM typed"
    q["silver_filter_invalid"] = f"{BASE} SELECT * FROM valid"
    q["silver_filter_nulls"] = f"{BASE} SELECT * FROM complete"
    q["silver_dedup"] = f"{BASE} SELECT * EXCLUDE (_rank) FROM ranked WHERE _rank = 1"
    q["silver_full"] = f"{BASE} SELECT {_SILVER_OUT}, '1.0' AS _silver_version FROM silver"
    q["silver_funnel"] = f"""{BASE}
        SELECT CAST((SELECT COUNT(*) FROM typed) AS BIGINT) AS raw,
               CAST(0 AS BIGINT) AS foreign_period,
               CAST((SELECT COUNT(*) FROM typed WHERE NOT coalesce({VALID_COND}, FALSE)) AS BIGINT) AS invalid,
               CAST((SELECT COUNT(*) FROM valid) - (SELECT COUNT(*) FROM complete) AS BIGINT) AS nulls,
               CAST((SELECT COUNT(*) FROM complete) - (SELECT COUNT(*) FROM silver) AS BIGINT) AS duplicates,
               CAST((SELECT COUNT(*) FROM silver) AS BIGINT) AS kept"""
    q["gold_por_uf_mes"] = f"{BASE} SELECT * FROM gold_uf_mes"
    q["gold_top_municipios"] = f"{BASE} SELECT * FROM gold_mun"
    q["gold_serie_temporal"] = f"{BASE} SELECT * FROM gold_serie"
    q["gold_typed_contract"] = f"""{BASE}
        SELECT ano, nome_municipio AS municipio, uf, codigo_municipio AS codigo_ibge,
               total_beneficios, CAST(total_valor_brl AS DECIMAL(18,2)) AS total_valor_brl,
               ranking_nacional
        FROM gold_mun"""
    q["gold_typed_uf_mes"] = f"""{BASE}
        SELECT ano, mes, uf, total_beneficios,
               CAST(total_valor_brl AS DECIMAL(18,2)) AS total_valor_brl,
               CAST(media_valor_brl AS DECIMAL(12,2)) AS media_valor_brl
        FROM gold_uf_mes"""
    q["gold_typed_serie"] = f"""{BASE}
        SELECT ano_mes, total_beneficios, CAST(total_valor_brl AS DECIMAL(18,2)) AS total_valor_brl,
               CAST(variacao_pct AS DECIMAL(8,4)) AS variacao_pct
        FROM gold_serie"""
    q["gold_contract_check"] = f"""{BASE}
        SELECT CAST(COUNT(*) FILTER (WHERE ano_mes IS NULL OR total_beneficios IS NULL
                                     OR total_valor_brl IS NULL) AS BIGINT) AS null_violations,
               CAST(COUNT(*) - COUNT(DISTINCT ano_mes) AS BIGINT) AS unique_violations
        FROM gold_serie"""
    for k, text in REPORTS.items():
        q[k] = BASE + text
    q["nb_top_ufs"] = (
        f"{BASE} SELECT uf, total_beneficios, total_valor_brl, media_valor_brl FROM gold_uf_mes "
        "ORDER BY total_valor_brl DESC, ano, mes, uf LIMIT 10"
    )
    q["nb_top_municipios"] = (
        f"{BASE} SELECT ano, ranking_nacional, nome_municipio, uf, total_beneficios, total_valor_brl "
        "FROM gold_mun WHERE ranking_nacional <= 20"
    )
    q["nb_serie"] = f"{BASE} SELECT ano_mes, total_beneficios, total_valor_brl, variacao_pct FROM gold_serie"
    gold_rows = " UNION ALL ".join(
        f"SELECT 'gold.{t}_rows' AS \"check\", CAST(COUNT(*) AS DOUBLE) AS value, COUNT(*) > 0 AS passed "
        f"FROM {c}"
        for t, c in zip(GOLD_TABLES, ["gold_uf_mes", "gold_mun", "gold_serie"])
    )
    q["dq_report"] = f"""{BASE},
        counts AS (SELECT CAST((SELECT COUNT(*) FROM feed) AS DOUBLE) AS b,
                          CAST((SELECT COUNT(*) FROM silver) AS DOUBLE) AS s)
        SELECT 'bronze_rows' AS "check", b AS value, b > 0 AS passed FROM counts
        UNION ALL
        SELECT 'silver_retention', s / b, s / b >= CAST({RETENTION_THRESHOLD} AS DOUBLE) FROM counts WHERE b > 0
        UNION ALL {gold_rows}"""
    q["bronze_csv_roundtrip"] = f"{RAW_BASE} SELECT {RAW_COLS} FROM feed"
    broken = RAW_COLS.replace(
        "NOME_FAVORECIDO",
        "CASE WHEN VALOR_PARCELA LIKE '%7' THEN replace(NOME_FAVORECIDO, '#', ';\"' || chr(10)) ELSE NOME_FAVORECIDO END AS NOME_FAVORECIDO",
    )
    q["bronze_quoted_newlines"] = f"{RAW_BASE} SELECT {broken}, {_FEED_PERIOD} FROM feed"
    q["bronze_audit"] = (
        f"{RAW_BASE} SELECT {RAW_COLS}, {_FEED_PERIOD}, TRUE AS has_file_hash, TRUE AS has_source, "
        "TRUE AS has_file_name FROM feed"
    )
    q["bronze_tree_digest"] = f"{RAW_BASE} SELECT {RAW_COLS}, {_FEED_PERIOD}, TRUE AS has_tree FROM feed"
    lot = "CASE WHEN CAST(MES_COMPETENCIA AS INTEGER) % 2 = 1 THEN 'lote ' || MES_COMPETENCIA END AS LOTE"
    q["bronze_mixed_layouts"] = f"{RAW_BASE} SELECT {RAW_COLS}, {lot}, {_FEED_PERIOD} FROM feed"
    lot = f"CASE WHEN MES_COMPETENCIA >= '{EVOLVED_SINCE}' THEN MES_COMPETENCIA END AS LOTE"
    q["bronze_schema_evolution"] = f"{RAW_BASE} SELECT {RAW_COLS}, {lot}, {_FEED_PERIOD} FROM feed"
    odd_value = """CASE WHEN o_orderkey % 5 = 0 THEN 0.004 WHEN o_orderkey % 7 = 0 THEN 10000000000.126
        WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN NULL
        ELSE TRY_CAST(replace(replace(VALOR_PARCELA, '.', ''), ',', '.') AS DECIMAL(28,8)) END"""
    exact = TYPED.replace(
        "TRY_CAST(replace(replace(VALOR_PARCELA, '.', ''), ',', '.') AS DOUBLE)", f"CAST({odd_value} AS DECIMAL(28,8))"
    )
    # the mean in whole thousandths: a decimal sum does not turn into a double exactly in DuckDB
    mean = (
        "CAST((2 * SUM(CAST(valor_parcela * 1000 AS HUGEINT)) + 10 * COUNT(nis_favorecido)) "
        "// (20 * COUNT(nis_favorecido)) AS DOUBLE) / 100"
    )
    whole = GOLD.replace(rnd(MEAN_EXPR, 2), mean)
    q["gold_exact_sums"] = f"{with_ctes(FEED, exact, SILVER, whole)} SELECT * FROM gold_uf_mes"
    q["scan_period"] = (
        f"{RAW_BASE} SELECT {RAW_COLS}, {_FEED_PERIOD} FROM feed "
        f"WHERE MES_COMPETENCIA = '{SCAN_YEAR}{SCAN_MONTH:02d}'"
    )
    q["scan_year"] = f"{BASE} SELECT {_SILVER_OUT}, '1.0' AS _silver_version FROM silver WHERE ano = {SCAN_YEAR}"
    again = ", ".join(f"'{y * 100 + m}'" for y, m in REPLACED_PERIODS)
    marked = RAW_COLS.replace(
        "NOME_FAVORECIDO", f"CASE WHEN MES_COMPETENCIA IN ({again}) THEN '{MARK}' ELSE '' END || NOME_FAVORECIDO AS NOME_FAVORECIDO"
    )
    q["bronze_partition_replace"] = (
        f"{RAW_BASE} SELECT {marked}, {_FEED_PERIOD}, MES_COMPETENCIA NOT IN ({again}) AS first_run FROM feed"
    )
    q["bronze_content_skip"] = q["bronze_partition_replace"]
    q["bronze_partial_landing"] = q["bronze_partition_replace"]
    q["bronze_idempotent"] = f"{RAW_BASE} SELECT {RAW_COLS}, {_FEED_PERIOD}, TRUE AS first_run FROM feed"
    y, m = REPLACED_PERIODS[0]
    silver_name = f"CASE WHEN ano = {y} AND mes = {m} THEN upper('{MARK}') ELSE '' END || nome_favorecido AS nome_favorecido"
    q["silver_partition_replace"] = f"{BASE} SELECT {_SILVER_OUT.replace('nome_favorecido', silver_name)} FROM silver"
    q["gold_mixed_scopes"] = f"{BASE} SELECT * FROM gold_serie"
    q["gold_table_roundtrip"] = f"{BASE} SELECT * FROM gold_mun"
    q["pipeline_multi_month"] = f"{BASE} SELECT * FROM gold_uf_mes"
    q["report_sql_q4"] = q["report_q4"]
    q["silver_funnel_observed"] = q["silver_funnel"]
    q["streaming_incremental"] = q["gold_serie_temporal"]
    return q
