"""DuckDB SQL for the registered queries, written from the driver's views."""

from __future__ import annotations

import re

# Tables of the domain and intermediate results, in dependency order.
TABLES = {
    "fx_raw": """
  SELECT o_orderkey + 1 AS row_id, o_orderdate AS ingested_at,
    'h' || CAST(CASE WHEN o_orderkey % 15 = 14 THEN o_orderkey - 1 ELSE o_orderkey END AS VARCHAR) AS hash,
    '{"CodEmpreendimento":"GD.' || CAST(o_orderkey AS VARCHAR)
    || '","SigUF":"' || CASE WHEN o_orderkey % 53 = 0 THEN '' ELSE n_name END
    || '","DscFonteGeracao":"' || CASE o_orderkey % 7 WHEN 0 THEN 'Radiação solar'
         WHEN 1 THEN 'Cinética do vento (eólica)' WHEN 2 THEN 'Potencial hidráulico' WHEN 3 THEN 'Biogás'
         WHEN 4 THEN 'Gás natural' WHEN 5 THEN 'Geotérmica' ELSE '' END
    || '","SigModalidadeEmpreendimento":"' || CASE o_orderkey % 6 WHEN 0 THEN 'Geração na própria UC'
         WHEN 1 THEN 'Autoconsumo remoto' WHEN 2 THEN 'Geração compartilhada'
         WHEN 3 THEN 'Empreendimento com Múltiplas Unidades Consumidoras'
         WHEN 4 THEN 'Múltiplas unidades consumidoras' ELSE 'Outra' END
    || '","DatConexao":"' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
    || '","NomMunicipio":"' || c_name || '","SigAgente":"AG' || CAST(c_nationkey AS VARCHAR) || '"'
    || CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE ',"MdaPotenciaInstaladaKW":"'
         || CAST(CAST(FLOOR(o_totalprice / CASE o_orderkey % 5 WHEN 0 THEN 100000.0 WHEN 1 THEN 10000.0
              WHEN 2 THEN 1000.0 WHEN 3 THEN 100.0 ELSE 5.0 END) AS BIGINT) AS VARCHAR)
         || ',' || LPAD(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') || '"' END
    || '}' AS raw_json
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "fx_plants": """
  SELECT 'CEG' || CAST(s_suppkey AS VARCHAR) AS cod_ceg, s_name AS nome_empreendimento, n_name AS uf,
    CASE s_suppkey % 4 WHEN 0 THEN 'UHE' WHEN 1 THEN 'UTE' WHEN 2 THEN 'EOL' ELSE 'UFV' END AS tipo_geracao,
    s_acctbal * 100 AS potencia_outorgada_kw,
    CAST(CASE WHEN s_suppkey % 10 = 0 THEN 0 ELSE -30 + s_suppkey % 30 END AS DOUBLE) AS lat,
    CAST(CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE -70 + s_suppkey % 35 END AS DOUBLE) AS lon,
    CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE CAST(DATE '1993-01-01' + CAST(s_suppkey * 13 % 4000 AS INTEGER) AS VARCHAR)
      END AS data_entrada_operacao
  FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "fx_load": """
  SELECT event_id AS id, 'verificada' AS tipo,
    CASE user_id % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'NE' WHEN 2 THEN 'N' ELSE 'SIN' END AS area,
    DATE_TRUNC('second', ts) AS rts, CAST(FLOOR(value * 10) AS DOUBLE) AS carga, ts AS created_at
  FROM events""",
    "fx_official": """
  SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'NE' WHEN 2 THEN 'N' ELSE 'SIN' END AS area,
    DATE_TRUNC('second', ts) AS ts,
    CAST(FLOOR(value * 10) * CASE WHEN event_id % 25 = 0 THEN 1.1 WHEN event_id % 10 = 0 THEN 1.01
      ELSE 1.0 END AS DOUBLE) AS val
  FROM events""",
    "fx_dispatch": """
  SELECT CAST(l_shipdate AS DATE) AS dia, l_linenumber AS patamar,
    CASE l_suppkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'NE' WHEN 2 THEN 'N' ELSE 'SE' END AS sub,
    l_extendedprice AS demanda, l_quantity * 10 AS hidraulica, l_quantity AS pch, l_quantity * 3 AS termica,
    l_quantity * 0.5 AS pct, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity * 4 END AS eolica,
    l_quantity * 2 AS solar, l_quantity * 0.25 AS mmgd
  FROM lineitem""",
    "fx_iot": """
  SELECT event_id, user_id AS cliente_id, ts, value AS geracao_kw,
    CAST(REPLACE(REPLACE(props, '{"k": ', ''), '}', '') AS DOUBLE) / 4 AS consumo_kw,
    CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 7 AS DOUBLE) - 3 ELSE NULL END AS bateria_potencia_kw,
    CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 101 AS DOUBLE) END AS bateria_soc,
    event_type AS dispositivo
  FROM events""",
    "iot_once": """
  SELECT DISTINCT * EXCLUDE (event_id) FROM
    (SELECT * FROM fx_iot UNION ALL SELECT * FROM fx_iot WHERE event_id % 20 = 3)""",
    "iot_extra": """
  SELECT *, GREATEST(0.0, geracao_kw - consumo_kw
    + CASE WHEN bateria_potencia_kw < 0 THEN ABS(bateria_potencia_kw) ELSE 0.0 END) AS excedente_kwh
  FROM fx_iot""",
    "fx_credits": """
  SELECT o_orderkey AS id, o_custkey AS cliente_id, CAST(FLOOR(o_totalprice / 1000) AS DOUBLE) AS saldo_kwh,
    CAST(0.8 AS DOUBLE) AS valor_unitario_rs,
    CAST(CAST(o_orderdate AS DATE) + INTERVAL 1825 DAY AS DATE) AS data_vencimento
  FROM orders""",
    "first_credit": """
  SELECT * FROM fx_credits WHERE data_vencimento > DATE '2003-01-01'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY cliente_id ORDER BY data_vencimento, id) = 1""",
    "fx_sales": """
  SELECT l_orderkey + CASE WHEN l_partkey % 50 = 0 THEN 100000000 ELSE 0 END AS credito_id, l_linenumber AS seq,
    l_partkey AS tie, l_suppkey AS tie2, l_quantity AS quantidade_kwh, l_extendedprice AS valor_rs,
    l_shipdate AS data_transacao
  FROM lineitem""",
    "requests": """
  SELECT *, ROW_NUMBER() OVER (PARTITION BY credito_id ORDER BY data_transacao, seq, tie, tie2) AS n
  FROM fx_sales""",
    "walk": """
  SELECT id AS credito_id, CAST(0 AS BIGINT) AS n, saldo_kwh AS saldo, FALSE AS ok FROM fx_credits
  UNION ALL
  SELECT r.credito_id, r.n, CASE WHEN w.saldo >= r.quantidade_kwh THEN w.saldo - r.quantidade_kwh ELSE w.saldo END,
    w.saldo >= r.quantidade_kwh
  FROM walk w JOIN requests r ON r.credito_id = w.credito_id AND r.n = w.n + 1""",
    "settled": """
  SELECT r.*, ROUND(r.valor_rs * 0.25, 4) AS valor_token,
    CASE WHEN w.credito_id IS NULL THEN 'credito_inexistente' WHEN w.ok THEN 'venda_realizada'
      ELSE 'saldo_insuficiente' END AS status
  FROM requests r LEFT JOIN walk w ON w.credito_id = r.credito_id AND w.n = r.n""",
    "fx_hot_credits": """
  SELECT id % 30 AS credito_id, FLOOR(SUM(saldo_kwh) / 4) AS saldo_kwh FROM fx_credits GROUP BY 1""",
    "hot_requests": """
  SELECT l_partkey % 30 AS credito_id, l_linenumber AS seq, l_orderkey AS tie, l_partkey AS tie2,
    l_quantity AS quantidade_kwh, l_extendedprice AS valor_rs,
    l_shipdate AS data_transacao,
    ROW_NUMBER() OVER (PARTITION BY l_partkey % 30 ORDER BY l_shipdate, l_linenumber, l_orderkey, l_partkey) AS n
  FROM lineitem""",
    "hot_walk": """
  SELECT credito_id, CAST(0 AS BIGINT) AS n, saldo_kwh AS saldo, FALSE AS ok FROM fx_hot_credits
  UNION ALL
  SELECT r.credito_id, r.n, CASE WHEN w.saldo >= r.quantidade_kwh THEN w.saldo - r.quantidade_kwh ELSE w.saldo END,
    w.saldo >= r.quantidade_kwh
  FROM hot_walk w JOIN hot_requests r ON r.credito_id = w.credito_id AND r.n = w.n + 1""",
    "refund_requests": """
  SELECT l_partkey % 30 AS credito_id, l_linenumber AS seq, l_orderkey AS tie, l_partkey AS tie2,
    CASE WHEN l_suppkey % 5 = 0 THEN -l_quantity ELSE l_quantity END AS quantidade_kwh, l_extendedprice AS valor_rs,
    l_shipdate AS data_transacao,
    ROW_NUMBER() OVER (PARTITION BY l_partkey % 30 ORDER BY l_shipdate, l_linenumber, l_orderkey, l_partkey) AS n
  FROM lineitem""",
    "refund_walk": """
  SELECT credito_id, CAST(0 AS BIGINT) AS n, saldo_kwh AS saldo, FALSE AS ok FROM fx_hot_credits
  UNION ALL
  SELECT r.credito_id, r.n, CASE WHEN w.saldo >= r.quantidade_kwh THEN w.saldo - r.quantidade_kwh ELSE w.saldo END,
    w.saldo >= r.quantidade_kwh
  FROM refund_walk w JOIN refund_requests r ON r.credito_id = w.credito_id AND r.n = w.n + 1""",
    "lean": """
  SELECT row_id AS id, json_extract_string(raw_json, '$.CodEmpreendimento') AS cod_empreendimento,
    json_extract_string(raw_json, '$.SigUF') AS siguf,
    LOWER(json_extract_string(raw_json, '$.DscFonteGeracao')) AS dscfontegeracao,
    CAST(REPLACE(COALESCE(json_extract_string(raw_json, '$.MdaPotenciaInstaladaKW'), '0'), ',', '.') AS DOUBLE)
      AS potencia_instalada_kw,
    LOWER(json_extract_string(raw_json, '$.SigModalidadeEmpreendimento')) AS modalidade,
    CASE WHEN potencia_instalada_kw <= 75 THEN 'microgeracao' WHEN potencia_instalada_kw <= 5000
      THEN 'minigeracao' ELSE 'geracao' END AS faixa_regulatoria,
    hash
  FROM fx_raw""",
    "fact": """
  SELECT * FROM lean QUALIFY ROW_NUMBER() OVER (PARTITION BY hash ORDER BY id) = 1""",
    "wide": """
  SELECT fact.*, json_extract_string(raw_json, '$.NomMunicipio') AS municipio,
    json_extract_string(raw_json, '$.SigAgente') AS distribuidora,
    json_extract_string(raw_json, '$.DatConexao') AS data_conexao, '' AS nome_titular, '' AS classe_producao,
    '' AS subgrupo, '' AS tipo_unidade_produtora, CAST(0 AS INTEGER) AS qtd_uc_recebe_credito,
    TRY_CAST(json_extract_string(raw_json, '$.DatConexao') AS DATE) AS dia_conexao
  FROM fact JOIN fx_raw ON row_id = id""",
    "text_rules": """
  SELECT id, lean.hash, siguf AS uf, dscfontegeracao AS f, modalidade AS m, json_extract_string(raw_json, '$.DscFonteGeracao') AS fonte_bruta,
    json_extract_string(raw_json, '$.SigModalidadeEmpreendimento') AS modalidade_bruta,
    json_extract_string(raw_json, '$.NomMunicipio') AS municipio,
    json_extract_string(raw_json, '$.DatConexao') AS data_conexao,
    TRY_CAST(REPLACE(json_extract_string(raw_json, '$.MdaPotenciaInstaladaKW'), ',', '.') AS DOUBLE) AS potencia_kw,
    CASE WHEN regexp_matches(f, 'fotovolta|solar|ufv') THEN 'UFV' WHEN regexp_matches(f, 'eólic|eol') THEN 'EOL'
      WHEN regexp_matches(f, 'hidr|cgh|pch') THEN 'CGH'
      WHEN regexp_matches(f, 'term|biog[áa]s|biomassa|g[áa]s natural|ute') THEN 'UTE' ELSE 'OUTRA' END AS fonte_norm,
    CASE WHEN m LIKE '%remot%' THEN 'AUTOCONSUMO_REMOTO'
      WHEN regexp_matches(m, 'compartilhad|cooperativ|cons[óo]rcio') THEN 'GERACAO_COMPARTILHADA'
      WHEN regexp_matches(m, 'm[úu]ltiplas|muc') THEN CASE WHEN m LIKE '%empreend%' THEN 'EMUC' ELSE 'MUC' END
      WHEN regexp_matches(m, 'pr[óo]pria|local') THEN 'GERACAO_PROPRIA' ELSE 'INDEFINIDA' END AS modalidade_norm
  FROM lean JOIN fx_raw ON row_id = id""",
    "classified": """
  SELECT id, hash, uf, municipio, CAST(NULL AS VARCHAR) AS cod_ibge, CAST(NULL AS VARCHAR) AS distribuidora,
    fonte_bruta, fonte_norm, potencia_kw, data_conexao, modalidade_bruta, modalidade_norm,
    CAST(NULL AS VARCHAR) AS classe_consumo,
    CASE WHEN COALESCE(potencia_kw, 0) <= 0 THEN 'INDEFINIDA' WHEN potencia_kw <= 75 THEN 'MICROGERACAO'
      WHEN potencia_kw <= CASE WHEN fonte_norm = 'CGH' THEN 3000 ELSE 5000 END THEN 'MINIGERACAO'
      ELSE 'INDEFINIDA' END AS faixa_regulatoria,
    CASE WHEN COALESCE(potencia_kw, 0) <= 0 THEN 'INDEFINIDA' WHEN potencia_kw <= 15 THEN 'RESIDENCIAL'
      WHEN potencia_kw <= 75 THEN 'COMERCIAL_PEQUENO' WHEN potencia_kw <= 1000 THEN 'MINIGERACAO_ALVO'
      WHEN potencia_kw <= 5000 THEN 'INDUSTRIAL_ALVO' ELSE 'GRANDE_CARGA' END AS faixa_potencia,
    CAST(CASE WHEN COALESCE(potencia_kw, 0) <= 0 OR potencia_kw > 50000 OR faixa_regulatoria = 'INDEFINIDA'
      THEN 1 ELSE 0 END AS INTEGER) AS is_outlier
  FROM text_rules""",
    "audited": """
  SELECT uf, fonte_norm, CAST(potencia_kw AS DECIMAL(18, 6)) AS kw FROM classified WHERE is_outlier = 0""",
    "stored_points": """
  SELECT area, rts AS ts, carga AS val, created_at, id FROM fx_load WHERE id % 40 <> 7 AND carga <> 0""",
    "recent_points": """
  SELECT * FROM
    (SELECT * FROM fx_load WHERE id % 40 <> 7
     QUALIFY ROW_NUMBER() OVER (PARTITION BY area ORDER BY created_at DESC, id DESC) <= 500)""",
    "recent_stored": """
  SELECT area, rts AS ts, carga AS val, created_at, id FROM recent_points WHERE carga <> 0""",
    "monthly": """
  SELECT siguf, SUBSTR(data_conexao, 1, 7) AS mes, SUM(potencia_instalada_kw) AS kw FROM wide
  WHERE data_conexao BETWEEN '1995-01-01' AND '2001-12-31' GROUP BY 1, 2""",
    "month_end": """
  SELECT LAST_DAY(CAST(data_conexao AS DATE)) AS data, COUNT(*) AS n, SUM(potencia_instalada_kw) AS kw
  FROM wide GROUP BY 1""",
    "running": """
  SELECT data, CAST(SUM(n) OVER (ORDER BY data) AS BIGINT) AS mmgd_ativos,
    SUM(kw) OVER (ORDER BY data) AS mmgd_potencia_kw FROM month_end""",
    "plant_text": """
  SELECT s_suppkey AS k, 'CEG' || CAST(s_suppkey AS VARCHAR) AS cod_ceg, s_name, n_name,
    CASE s_suppkey % 4 WHEN 0 THEN 'UHE' WHEN 1 THEN 'UTE' WHEN 2 THEN 'EOL' ELSE 'UFV' END AS tipo,
    CASE WHEN s_suppkey % 13 = 0 THEN '' WHEN s_suppkey % 17 = 0 THEN '1.' ELSE '' END
    || CASE WHEN s_suppkey % 13 = 0 THEN ''
       ELSE REPLACE(CAST(CAST(s_acctbal AS DECIMAL(18, 2)) AS VARCHAR), '.', ',') END AS power_text
  FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "plant_rows": """
  SELECT cod_ceg, s_name AS nome_empreendimento, n_name AS uf, tipo AS tipo_geracao,
    CASE WHEN power_text = '' THEN 0.0 ELSE TRY_CAST(REPLACE(power_text, ',', '.') AS DOUBLE) END
      AS potencia_outorgada_kw,
    CAST(CAST(k % 30 - 30 AS VARCHAR) || '.5' AS DOUBLE) AS lat
  FROM plant_text""",
    "plant_news": """
  SELECT 'CEG' || CAST(s_suppkey * (v + 1) AS VARCHAR) AS cod_ceg, s_name AS nome_empreendimento, 'XX' AS uf,
    'UFV' AS tipo_geracao, s_suppkey + v / 10.0 AS potencia_outorgada_kw, 0.0 AS lat, v
  FROM supplier CROSS JOIN (VALUES (1), (2)) AS rounds(v)""",
}

_PLANT_REST = """'' AS fase_usina, '' AS fonte_combustivel, '' AS data_entrada_operacao, '' AS proprietario,
  '' AS municipios, CAST(0 AS DOUBLE) AS potencia_fiscalizada_kw, CAST(0 AS DOUBLE) AS garantia_fisica_kw,
  CAST(0 AS DOUBLE) AS lon, cod_ceg AS hash"""

_DRIFT = """
SELECT CASE WHEN l.val IS NULL THEN 'ausente_localmente' ELSE 'revisao_retroativa_nao_capturada' END AS tipo,
  o.area || ':' || STRFTIME(o.ts, '%Y-%m-%d %H:%M:%S') AS chave, l.val AS valor_local, o.val AS valor_oficial,
  ROUND(ABS(l.val - o.val) / o.val * 100, 3) AS delta_pct,
  CASE WHEN ABS(l.val - o.val) / o.val * 100 > 5 THEN 'critico' ELSE 'atencao' END AS severidade
FROM fx_official o
LEFT JOIN (SELECT * FROM {points} QUALIFY ROW_NUMBER() OVER (PARTITION BY area, ts ORDER BY created_at, id) = 1) l
  ON l.area = o.area AND l.ts = o.ts
WHERE o.val <> 0 AND (l.val IS NULL OR ABS(l.val - o.val) / o.val * 100 > 0.5)"""
TABLES["drift"] = _DRIFT.format(points="stored_points")
TABLES["no_area"] = """
  SELECT 'fetch_vazio' AS tipo, w.area || ':' || w.hora AS chave, 'atencao' AS severidade
  FROM (SELECT DISTINCT a.area, STRFTIME(ts, '%Y-%m-%d %H') AS hora FROM fx_official
        CROSS JOIN (VALUES ('S'), ('N'), ('NE'), ('SIN')) AS a(area)) w
  ANTI JOIN (SELECT area, STRFTIME(ts, '%Y-%m-%d %H') AS hora FROM fx_official) s
    ON s.area = w.area AND s.hora = w.hora"""
TABLES["stale"] = """
  SELECT 'mmgd_desatualizado' AS tipo, 'relacao-de-empreendimentos-de-geracao-distribuida' AS chave,
    MAX(ingested_at) AS valor_local, TIMESTAMP '2001-12-31 12:00:00' AS valor_oficial,
    CAST(FLOOR((EPOCH(TIMESTAMP '2001-12-31 12:00:00') - EPOCH(MAX(ingested_at))) / 86400) AS BIGINT) AS dias,
    CASE WHEN FLOOR((EPOCH(TIMESTAMP '2001-12-31 12:00:00') - EPOCH(MAX(ingested_at))) / 86400) > 30
      THEN 'critico' ELSE 'atencao' END AS severidade
  FROM fx_raw HAVING FLOOR((EPOCH(TIMESTAMP '2001-12-31 12:00:00') - EPOCH(MAX(ingested_at))) / 86400) > 0"""
TABLES["incomplete"] = """
  SELECT 'etl_raw_para_fato_incompleto' AS tipo, 'mmgd_raw->mmgd_fato' AS chave, f AS valor_local,
    r AS valor_oficial, ROUND(100 - f / r * 100, 2) AS delta_pct,
    CASE WHEN f / r * 100 < 50 THEN 'critico' ELSE 'atencao' END AS severidade
  FROM (SELECT (SELECT COUNT(*) FROM fact) AS f, (SELECT COUNT(*) FROM fx_raw) AS r)
  WHERE r > 0 AND f / r * 100 < 95"""
TABLES["gaps"] = """
  SELECT 'campo_ausente_no_schema' AS tipo, 'mmgd_fato.' || campo AS chave, 'ausente' AS valor_local,
    'presente na fonte ANEEL' AS valor_oficial, (SELECT COUNT(*) FROM fact) AS linhas_afetadas,
    'atencao' AS severidade
  FROM (SELECT UNNEST(['distribuidora', 'cod_empreendimento', 'nome_titular', 'classe_producao', 'subgrupo',
    'qtd_uc_recebe_credito', 'data_conexao', 'tipo_unidade_produtora', 'fonte', 'potencia_instalada_kw',
    'municipio', 'uf']) AS campo)
  WHERE campo NOT IN (SELECT DISTINCT CASE k WHEN 'siguf' THEN 'uf' WHEN 'dscfontegeracao' THEN 'fonte' ELSE k END
    FROM (SELECT UNNEST(json_keys(to_json(f))) AS k FROM fact f))"""
TABLES["absent_area"] = """
  SELECT 'fetch_vazio' AS tipo, area AS chave, 'atencao' AS severidade
  FROM (SELECT UNNEST(['S', 'N', 'NE', 'SIN']) AS area)
  WHERE area NOT IN (SELECT area FROM fx_official WHERE area <> 'N')"""
TABLES["findings"] = """
  SELECT tipo, chave, severidade, CAST(valor_local AS DOUBLE) AS valor_local,
    CAST(valor_oficial AS DOUBLE) AS valor_oficial, CAST(delta_pct AS DOUBLE) AS delta_pct FROM drift
  UNION ALL SELECT tipo, chave, severidade, NULL, NULL, NULL FROM absent_area
  UNION ALL SELECT tipo, chave, severidade, NULL, NULL, NULL FROM stale
  UNION ALL SELECT tipo, chave, severidade, CAST(valor_local AS DOUBLE), CAST(valor_oficial AS DOUBLE),
    CAST(delta_pct AS DOUBLE) FROM incomplete
  UNION ALL SELECT tipo, chave, severidade, NULL, NULL, NULL FROM gaps"""
TABLES["growth_days"] = """
  SELECT d.data, (SELECT COUNT(*) FROM wide WHERE TRY_CAST(data_conexao AS DATE) <= d.data) AS mmgd_ativos,
    (SELECT COALESCE(SUM(potencia_instalada_kw), 0) FROM wide WHERE TRY_CAST(data_conexao AS DATE) <= d.data)
      AS mmgd_potencia_kw,
    (SELECT COUNT(*) FROM fx_plants WHERE COALESCE(TRY_CAST(data_entrada_operacao AS DATE), DATE '0001-01-01') <= d.data)
      AS siga_ativos,
    (SELECT COALESCE(SUM(potencia_outorgada_kw), 0) FROM fx_plants
      WHERE COALESCE(TRY_CAST(data_entrada_operacao AS DATE), DATE '0001-01-01') <= d.data) AS siga_potencia_kw,
    (SELECT AVG(carga) FROM fx_load WHERE CAST(rts AS DATE) <= d.data) AS ons_carga_media_mw,
    (SELECT COUNT(*) FROM fx_load WHERE CAST(rts AS DATE) <= d.data) AS linhas_carga
  FROM (SELECT UNNEST([DATE '1992-12-31', DATE '1993-12-31', DATE '1994-12-31', DATE '1995-12-31', DATE '1996-12-31',
    DATE '1997-12-31', DATE '1998-12-31', DATE '1999-12-31', DATE '2000-12-31', DATE '2001-12-31', DATE '2024-01-10',
    DATE '2024-01-20']) AS data) d"""
TABLES["growth_rows"] = """
  SELECT * EXCLUDE (linhas_carga), mmgd_ativos + siga_ativos + linhas_carga AS total_registros FROM growth_days"""

_WORD = re.compile(r"[a-z_]+")


def _with(body: str) -> str:
    """``body`` preceded by the tables it needs, directly or not."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        for word in set(_WORD.findall(todo.pop())):
            if word in TABLES and word not in needed:
                needed.add(word)
                todo.append(TABLES[word])
    parts = [f"{name} AS ({sql})" for name, sql in TABLES.items() if name in needed]
    return (f"WITH RECURSIVE {', '.join(parts)}\n" if parts else "") + body.strip()


_BODIES = {
    "registry_fact_lean": "SELECT * FROM lean",
    "registry_hashes": """
SELECT cod_empreendimento, sha256('{"cod_empreendimento":"' || cod_empreendimento || '","dscfontegeracao":"'
  || dscfontegeracao || '","modalidade":"' || modalidade || '","siguf":"' || siguf || '"}') AS hash FROM lean""",
    "registry_dedup_first": "SELECT * FROM fact",
    "registry_stream_fact": "SELECT * FROM fact",
    "registry_dedup_last": "SELECT MAX(row_id) AS row_id, hash FROM fx_raw GROUP BY hash",
    "registry_incremental": """
SELECT *, CAST(CASE WHEN id <= (SELECT MAX(o_orderkey) / 2 FROM orders) THEN 0 ELSE 1 END AS INTEGER) AS novo
FROM fact""",
    "registry_load_counts": """
SELECT (SELECT COUNT(*) FROM fx_raw) AS total_raw,
  COUNT(*) FILTER (id <= (SELECT MAX(o_orderkey) / 2 FROM orders)) AS fato_antes, COUNT(*) AS fato_depois,
  COUNT(*) FILTER (id > (SELECT MAX(o_orderkey) / 2 FROM orders)) AS novos
FROM fact""",
    "registry_valid_only": "SELECT * FROM fact WHERE hash <> '' AND siguf IS NOT NULL",
    "registry_enriched": "SELECT * FROM wide",
    "registry_wide": "SELECT * FROM wide",
    "registry_classified": "SELECT * FROM classified",
    "plants_normalised": f"SELECT *, {_PLANT_REST} FROM plant_rows",
    "plants_quarantine": """
SELECT cod_ceg AS "CodCEG", power_text AS "MdaPotenciaOutorgadaKw" FROM plant_text
WHERE power_text <> '' AND TRY_CAST(REPLACE(power_text, ',', '.') AS DOUBLE) IS NULL""",
    "plants_upsert": f"""
SELECT * EXCLUDE (v), {_PLANT_REST} FROM
  (SELECT *, 0 AS v FROM plant_rows UNION ALL SELECT * FROM plant_news)
QUALIFY ROW_NUMBER() OVER (PARTITION BY cod_ceg ORDER BY v DESC) = 1""",
    "table_stats": """
SELECT 'mmgd_raw' AS tabela, COUNT(*) AS linhas FROM fx_raw
UNION ALL SELECT 'mmgd_fato', COUNT(*) FROM fact
UNION ALL SELECT 'ons_carga', COUNT(*) FROM fx_load
UNION ALL SELECT 'dessem_detalhe', COUNT(*) FROM fx_dispatch
UNION ALL SELECT 'siga_fato', COUNT(*) FROM fx_plants""",
    "totals_uf": "SELECT siguf, COUNT(*) AS total FROM fact WHERE siguf <> '' GROUP BY siguf",
    "top_ufs": """
SELECT siguf, COUNT(*) AS total FROM fact WHERE siguf <> '' GROUP BY siguf ORDER BY total DESC, siguf LIMIT 10""",
    "totals_source": """
SELECT dscfontegeracao AS fonte, COUNT(*) AS empreendimentos, ROUND(SUM(potencia_instalada_kw), 2) AS potencia_total_kw
FROM fact WHERE dscfontegeracao <> '' GROUP BY 1""",
    "capacity_series": "SELECT siguf, mes, ROUND(kw, 2) AS potencia_kw FROM monthly",
    "capacity_series_uf": """
SELECT SUBSTR(data_conexao, 1, 7) AS mes, ROUND(SUM(potencia_instalada_kw), 2) AS potencia_kw FROM wide
WHERE siguf = 'NATION_3' AND data_conexao BETWEEN '1995-01-01' AND '2001-12-31'
  AND dscfontegeracao = 'radiação solar' GROUP BY 1""",
    "capacity_cells": """
SELECT siguf, dscfontegeracao, ROUND(SUM(potencia_instalada_kw), 2) AS potencia_total_kw,
  COUNT(*) AS empreendimentos FROM fact GROUP BY 1, 2""",
    "treemap_levels": """
SELECT 'fonte' AS nivel, NULL AS uf, dscfontegeracao AS fonte, ROUND(SUM(potencia_instalada_kw), 2) AS valor_kw,
  COUNT(*) AS empreendimentos FROM fact WHERE dscfontegeracao <> '' GROUP BY dscfontegeracao
UNION ALL SELECT 'uf', siguf, NULL, ROUND(SUM(potencia_instalada_kw), 2), COUNT(*)
  FROM fact WHERE siguf <> '' GROUP BY siguf
UNION ALL SELECT 'uf_fonte', siguf, dscfontegeracao, ROUND(SUM(potencia_instalada_kw), 2), COUNT(*)
  FROM fact WHERE siguf <> '' AND dscfontegeracao <> '' GROUP BY siguf, dscfontegeracao""",
    "treemap_tree": """
SELECT uf, ROUND(SUM(kw) OVER (PARTITION BY uf), 2) AS uf_kw,
  CAST(ROW_NUMBER() OVER (PARTITION BY uf ORDER BY kw DESC, fonte) - 1 AS INTEGER) AS posicao, fonte,
  ROUND(kw, 2) AS valor_kw, empreendimentos
FROM (SELECT siguf AS uf, dscfontegeracao AS fonte, SUM(potencia_instalada_kw) AS kw, COUNT(*) AS empreendimentos
  FROM fact WHERE siguf <> '' AND dscfontegeracao <> '' GROUP BY 1, 2)""",
    "capacity_combined": """
SELECT CASE WHEN GROUPING(uf) = 1 THEN 'fonte' WHEN GROUPING(fonte) = 1 THEN 'uf' ELSE 'uf_fonte' END AS nivel,
  uf, fonte, ROUND(SUM(kw) / 1000, 6) AS potencia_mw, COUNT(*) AS empreendimentos
FROM (SELECT siguf AS uf, dscfontegeracao AS fonte, potencia_instalada_kw AS kw FROM fact
      WHERE siguf <> '' AND dscfontegeracao <> ''
      UNION ALL SELECT uf, tipo_geracao, potencia_outorgada_kw FROM fx_plants)
GROUP BY GROUPING SETS ((uf), (fonte), (uf, fonte))""",
    "totals_views": """
SELECT CASE WHEN GROUPING(fonte_norm) = 1 THEN 'uf' WHEN GROUPING(uf) = 1 THEN 'fonte' ELSE 'uf_fonte' END AS visao,
  uf, fonte_norm, COUNT(*) AS qtd_empreendimentos, CAST(ROUND(SUM(kw) * 0.001, 3) AS DOUBLE) AS potencia_total_mw
FROM audited GROUP BY GROUPING SETS ((uf), (fonte_norm), (uf, fonte_norm))""",
    "totals_summary": """
SELECT 'total' AS nivel, CAST(NULL AS VARCHAR) AS chave, COUNT(*) AS qtd,
  COALESCE(CAST(ROUND(SUM(kw) * 0.001, 3) AS DOUBLE), 0.0) AS mw FROM audited
UNION ALL SELECT 'fonte', fonte_norm, COUNT(*), CAST(ROUND(SUM(kw) * 0.001, 3) AS DOUBLE) FROM audited GROUP BY 2
UNION ALL SELECT 'uf', uf, COUNT(*), CAST(ROUND(SUM(kw) * 0.001, 3) AS DOUBLE) FROM audited GROUP BY 2""",
    "export_tree": """
SELECT uf, CAST(ROUND(uf_kw * 0.001, 3) AS DOUBLE) AS uf_mw, CAST(uf_n AS BIGINT) AS uf_qtd,
  CAST(ROW_NUMBER() OVER (PARTITION BY uf ORDER BY ROUND(kw * 0.001, 3) DESC, fonte) - 1 AS INTEGER) AS posicao,
  fonte, CAST(ROUND(kw * 0.001, 3) AS DOUBLE) AS mw, n AS qtd
FROM (SELECT uf, fonte_norm AS fonte, SUM(kw) AS kw, COUNT(*) AS n,
    SUM(SUM(kw)) OVER (PARTITION BY uf) AS uf_kw, SUM(COUNT(*)) OVER (PARTITION BY uf) AS uf_n
  FROM audited WHERE uf <> '' GROUP BY 1, 2)
WHERE ROUND(kw * 0.001, 3) > 0""",
    "units_page": """
SELECT id, cod_empreendimento, siguf, dscfontegeracao, potencia_instalada_kw FROM fact
WHERE siguf = 'NATION_3' AND dscfontegeracao ILIKE '%gás%' ORDER BY id LIMIT 50 OFFSET 5""",
    "plants_page": """
SELECT cod_ceg, nome_empreendimento, uf, tipo_geracao, potencia_outorgada_kw FROM fx_plants
WHERE tipo_geracao = 'UFV' ORDER BY potencia_outorgada_kw DESC, cod_ceg LIMIT 20""",
    "units_keyset": """
SELECT id, cod_empreendimento, siguf, dscfontegeracao, potencia_instalada_kw FROM fact
WHERE siguf <> 'NATION_4' AND dscfontegeracao ILIKE '%gás%' ORDER BY id LIMIT 50 OFFSET 100""",
    "plants_keyset": """
SELECT cod_ceg, uf, potencia_outorgada_kw FROM fx_plants
ORDER BY potencia_outorgada_kw DESC NULLS LAST, cod_ceg LIMIT 20 OFFSET 40""",
    "load_keyset": """
SELECT id, area, tipo FROM fx_load WHERE area = 'NE' ORDER BY created_at DESC, id DESC LIMIT 100 OFFSET 200""",
    "plants_geo": """
SELECT * EXCLUDE (data_entrada_operacao), ROUND(GREATEST(3, LEAST(14, SQRT(GREATEST(potencia_outorgada_kw, 0) / 5000))), 6) AS raio FROM fx_plants
WHERE lat <> 0 AND lon <> 0 ORDER BY potencia_outorgada_kw DESC, cod_ceg""",
    "treemap_uf_plants": """
SELECT uf, nome_empreendimento AS name, potencia_outorgada_kw AS value, tipo_geracao AS fonte FROM fx_plants
WHERE uf = 'NATION_3' ORDER BY value DESC, name LIMIT 100""",
    "treemap_uf_top": """
SELECT siguf AS uf, cod_empreendimento AS name, potencia_instalada_kw AS value, dscfontegeracao AS fonte,
  CAST(ROW_NUMBER() OVER (PARTITION BY siguf ORDER BY potencia_instalada_kw DESC, cod_empreendimento) AS INTEGER)
    AS rank
FROM fact WHERE siguf <> '' QUALIFY rank <= 100""",
    "unit_labels": """
SELECT id, CASE WHEN potencia_instalada_kw >= 1000000 THEN printf('%.1f GW', ROUND(potencia_instalada_kw / 1000000, 1))
  WHEN potencia_instalada_kw >= 1000 THEN printf('%.1f MW', ROUND(potencia_instalada_kw / 1000, 1))
  ELSE printf('%.0f kW', ROUND(potencia_instalada_kw)) END AS rotulo FROM fact""",
    "dispatch_by_source": """
SELECT fonte, ROUND(total, 2) AS geracao_mw FROM
 (SELECT 'Hidráulica' AS fonte, SUM(hidraulica) AS total FROM fx_dispatch WHERE dia BETWEEN '1995-01-01' AND '2001-12-31'
  UNION ALL SELECT 'Eólica', SUM(eolica) FROM fx_dispatch WHERE dia BETWEEN '1995-01-01' AND '2001-12-31'
  UNION ALL SELECT 'Solar', SUM(solar) FROM fx_dispatch WHERE dia BETWEEN '1995-01-01' AND '2001-12-31'
  UNION ALL SELECT 'Térmica', SUM(termica) FROM fx_dispatch WHERE dia BETWEEN '1995-01-01' AND '2001-12-31'
  UNION ALL SELECT 'PCH', SUM(pch) FROM fx_dispatch WHERE dia BETWEEN '1995-01-01' AND '2001-12-31'
  UNION ALL SELECT 'PCT', SUM(pct) FROM fx_dispatch WHERE dia BETWEEN '1995-01-01' AND '2001-12-31'
  UNION ALL SELECT 'MMGD', SUM(mmgd) FROM fx_dispatch WHERE dia BETWEEN '1995-01-01' AND '2001-12-31')
WHERE total IS NOT NULL""",
    "dispatch_series": """
SELECT dia AS data, ROUND(SUM(eolica), 2) AS geracao_mw FROM fx_dispatch
WHERE dia BETWEEN '1995-01-01' AND '2001-12-31' GROUP BY dia HAVING SUM(eolica) IS NOT NULL""",
    "dispatch_now": """
SELECT dia AS data, hidraulica AS "Hidráulica", eolica AS "Eólica", solar AS "Solar", termica AS "Térmica",
  pch AS "PCH", pct AS "PCT", mmgd AS "MMGD"
FROM fx_dispatch ORDER BY dia DESC, patamar DESC, sub, demanda DESC LIMIT 1""",
    "load_history": """
SELECT dia AS din_programacaodia, patamar AS num_patamar, ROUND(SUM(demanda), 2) AS demanda_mw FROM fx_dispatch
WHERE dia BETWEEN DATE '1998-06-30' - 120 AND DATE '1998-06-30' GROUP BY 1, 2""",
    "load_daily": """
SELECT CAST(rts AS DATE) AS dat_referencia, SUM(carga) AS carga_total FROM fx_load
WHERE CAST(rts AS DATE) BETWEEN DATE '2024-01-20' - 90 AND DATE '2024-01-20' GROUP BY 1""",
    "load_coverage": """
SELECT area, MIN(lo) AS inicio, MAX(hi) AS fim, CAST(SUM(n) AS BIGINT) AS registros, COUNT(*) AS pontos,
  MAX(slot) - MIN(slot) + 1 AS pontos_esperados, COUNT(*) FILTER (nxt > slot + 1) AS lacunas,
  COALESCE(MAX(nxt - slot - 1) FILTER (nxt > slot + 1), 0) AS maior_lacuna
FROM (SELECT *, LEAD(slot) OVER (PARTITION BY area ORDER BY slot) AS nxt FROM
  (SELECT area, CAST(FLOOR(EPOCH(rts) / 1800) AS BIGINT) AS slot, COUNT(*) AS n, MIN(rts) AS lo, MAX(rts) AS hi
   FROM fx_load GROUP BY 1, 2))
GROUP BY area""",
    "load_page": """
SELECT id, area, tipo FROM fx_load WHERE area = 'NE' ORDER BY created_at DESC, id DESC LIMIT 100 OFFSET 10""",
    "load_series": """
SELECT id, rts AS data, carga FROM fx_load
WHERE area = 'S' AND rts >= TIMESTAMP '2024-01-01' AND rts < TIMESTAMP '2024-02-01'""",
    "load_drift": "SELECT * FROM drift",
    "load_drift_recent": _DRIFT.format(points="recent_stored"),
    "missing_areas": "SELECT * FROM absent_area",
    "missing_area_hours": "SELECT * FROM no_area",
    "staleness": "SELECT * FROM stale",
    "completeness": "SELECT * FROM incomplete",
    "schema_gap": "SELECT * FROM gaps",
    "quality_report": """
SELECT CAST(CASE severidade WHEN 'critico' THEN 0 WHEN 'atencao' THEN 1 ELSE 2 END AS INTEGER) AS ordem,
  tipo, chave, severidade, ROUND(valor_local, 3) AS valor_local, ROUND(valor_oficial, 3) AS valor_oficial,
  ROUND(delta_pct, 3) AS delta_pct FROM findings""",
    "quality_breakdown": """
SELECT CAST(CASE severidade WHEN 'critico' THEN 0 WHEN 'atencao' THEN 1 ELSE 2 END AS INTEGER) AS ordem,
  severidade, tipo, COUNT(*) AS total FROM findings GROUP BY 1, 2, 3""",
    "quality_summary": """
SELECT COUNT(*) AS total_divergencias, COUNT(*) FILTER (severidade = 'critico') AS criticos,
  COUNT(*) FILTER (severidade = 'atencao') AS atencoes,
  CAST(CASE WHEN COUNT(*) FILTER (severidade = 'critico') > 0 THEN 1 ELSE 0 END AS INTEGER) AS falhou,
  (SELECT COUNT(*) FROM fx_raw) AS registros_mmgd_raw, (SELECT COUNT(*) FROM fact) AS registros_mmgd_fato,
  (SELECT COUNT(*) FROM fx_load) AS registros_ons_carga, (SELECT COUNT(*) FROM fx_dispatch) AS registros_dessem_detalhe,
  (SELECT COUNT(*) FROM fx_plants) AS registros_siga_fato
FROM findings""",
    "iot_adapted": """
SELECT user_id AS cliente_id, ts, value AS geracao_kw,
  CAST(CASE WHEN event_id % 3 = 0 THEN 2.5 ELSE 0 END AS DOUBLE) AS consumo_kw,
  CASE WHEN event_id % 4 <> 0 THEN event_type ELSE 'inversor' END AS dispositivo FROM events
UNION ALL
SELECT user_id, ts, value, CAST(CASE WHEN event_id % 2 = 0 THEN 1.5 ELSE 0 END AS DOUBLE), 'goodwe' FROM events""",
    "iot_surplus": """
SELECT * EXCLUDE (event_id, excedente_kwh), ROUND(excedente_kwh, 6) AS excedente_kwh FROM iot_extra""",
    "iot_dedup": "SELECT * FROM iot_once",
    "iot_windows": """
SELECT cliente_id, time_bucket(INTERVAL 1 HOUR, ts) AS inicio, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS fim,
  COUNT(*) AS medicoes, ROUND(SUM(geracao_kw), 4) AS geracao, ROUND(SUM(consumo_kw), 4) AS consumo,
  ROUND(SUM(excedente_kwh), 4) AS excedente
FROM iot_extra GROUP BY 1, 2, 3""",
    "iot_windows_late": """
, marked AS (SELECT *, MINUTE(ts) % 3 = 0 AS late, time_bucket(INTERVAL 1 HOUR, ts) AS inicio,
  MAX(ts) FILTER (MINUTE(ts) % 3 <> 0) OVER () AS marca FROM iot_extra)
SELECT cliente_id, inicio, inicio + INTERVAL 1 HOUR AS fim, COUNT(*) AS medicoes, ROUND(SUM(geracao_kw), 4) AS geracao,
  ROUND(SUM(consumo_kw), 4) AS consumo, ROUND(SUM(excedente_kwh), 4) AS excedente,
  COUNT(*) FILTER (late AND inicio + INTERVAL 2 HOUR <= marca) AS tardias,
  CAST(MAX(CASE WHEN late THEN 1 ELSE 0 END) AS BIGINT) AS versao
FROM marked GROUP BY cliente_id, inicio""",
    "iot_running_balance": """
SELECT cliente_id, ROUND(SUM(excedente_kwh), 4) AS excedente_kwh, COUNT(*) AS medicoes FROM iot_extra GROUP BY 1""",
    "iot_crediting": """
, earned AS (SELECT cliente_id, SUM(excedente_kwh) AS kwh FROM iot_extra GROUP BY 1 HAVING SUM(excedente_kwh) > 0)
SELECT c.id, c.cliente_id, ROUND(c.saldo_kwh + COALESCE(e.kwh, 0), 4) AS saldo_kwh, c.valor_unitario_rs,
  c.data_vencimento
FROM fx_credits c LEFT JOIN (SELECT f.id, earned.kwh FROM first_credit f JOIN earned USING (cliente_id)) e
  ON e.id = c.id
UNION ALL
SELECT (SELECT MAX(id) FROM fx_credits) + ROW_NUMBER() OVER (ORDER BY cliente_id), cliente_id, ROUND(kwh, 4), 0.8,
  CAST(DATE '2003-01-01' + INTERVAL 1825 DAY AS DATE)
FROM earned ANTI JOIN first_credit USING (cliente_id)""",
    "iot_balance": """
SELECT COALESCE(c.cliente_id, m.cliente_id) AS cliente_id, COALESCE(c.saldo_kwh, 0) AS saldo_kwh,
  c.valor_unitario_rs, c.data_vencimento, m.ts AS ultima_medicao, m.geracao_kw, m.consumo_kw, m.bateria_soc
FROM first_credit c FULL JOIN
  (SELECT * FROM fx_iot QUALIFY ROW_NUMBER() OVER (PARTITION BY cliente_id ORDER BY ts DESC) = 1) m
  ON m.cliente_id = c.cliente_id""",
    "clients": """
SELECT c_custkey AS id, sha256(c_name) AS cpf_cnpj_hash, CASE WHEN c_custkey % 2 = 0 THEN 'PF' ELSE 'PJ' END AS tipo
FROM customer""",
    "credit_issue": """
SELECT ROW_NUMBER() OVER (ORDER BY f.id) AS id, f.id AS mmgd_fato_id, o_custkey AS cliente_id,
  ROUND(f.potencia_instalada_kw * 24 * 30 * CAST(0.15 AS DOUBLE), 4) AS saldo_kwh,
  CAST(0.8 AS DOUBLE) AS valor_unitario_rs, CAST(0.2 AS DOUBLE) AS valor_unitario_token,
  CAST(DATE '2003-01-01' + INTERVAL 1825 DAY AS DATE) AS data_vencimento,
  SUBSTR(sha256('unidade:' || f.id || ':' || ROW_NUMBER() OVER (ORDER BY f.id) || ':2003-01-01'), 1, 16) AS token_id
FROM fact f JOIN orders ON o_orderkey + 1 = f.id""",
    "credit_settlement": """
SELECT * EXCLUDE (n), 'venda' AS tipo, CAST(CASE WHEN quantidade_kwh <= 0 THEN 1 ELSE 0 END AS INTEGER)
  AS sinal_suspeito FROM settled""",
    "credit_settlement_hot": """
SELECT r.* EXCLUDE (n), ROUND(r.valor_rs * 0.25, 4) AS valor_token, 'venda' AS tipo,
  CASE WHEN w.credito_id IS NULL THEN 'credito_inexistente' WHEN w.ok THEN 'venda_realizada'
    ELSE 'saldo_insuficiente' END AS status,
  CAST(CASE WHEN quantidade_kwh <= 0 THEN 1 ELSE 0 END AS INTEGER) AS sinal_suspeito
FROM hot_requests r LEFT JOIN hot_walk w ON w.credito_id = r.credito_id AND w.n = r.n""",
    "credit_settlement_refunds": """
SELECT r.* EXCLUDE (n), ROUND(r.valor_rs * 0.25, 4) AS valor_token, 'venda' AS tipo,
  CASE WHEN w.credito_id IS NULL THEN 'credito_inexistente' WHEN w.ok THEN 'venda_realizada'
    ELSE 'saldo_insuficiente' END AS status,
  CAST(CASE WHEN quantidade_kwh <= 0 THEN 1 ELSE 0 END AS INTEGER) AS sinal_suspeito
FROM refund_requests r LEFT JOIN refund_walk w ON w.credito_id = r.credito_id AND w.n = r.n""",
    "credit_balances": """
SELECT c.id, c.cliente_id, w.saldo AS saldo_kwh, c.valor_unitario_rs, c.data_vencimento
FROM fx_credits c JOIN (SELECT credito_id, MIN(saldo) AS saldo FROM walk GROUP BY 1) w ON w.credito_id = c.id""",
    "credit_statement": """
SELECT s.* EXCLUDE (n, status), 'venda' AS tipo, c.cliente_id FROM settled s JOIN fx_credits c ON c.id = s.credito_id
WHERE status = 'venda_realizada'""",
    "credits_available": """
SELECT * FROM fx_credits WHERE saldo_kwh > 0 AND data_vencimento > DATE '2003-01-01'""",
    "growth_snapshot": """
SELECT data, mmgd_ativos, ROUND(mmgd_potencia_kw, 2) AS mmgd_potencia_kw, siga_ativos,
  ROUND(siga_potencia_kw, 2) AS siga_potencia_kw, ROUND(ons_carga_media_mw, 2) AS ons_carga_media_mw, total_registros
FROM growth_rows WHERE data = DATE '2001-12-31'""",
    "growth_delta": """
SELECT data, mmgd_ativos, ROUND(mmgd_potencia_kw, 2) AS mmgd_potencia_kw, siga_ativos,
  ROUND(siga_potencia_kw, 2) AS siga_potencia_kw, ROUND(ons_carga_media_mw, 2) AS ons_carga_media_mw, total_registros,
  mmgd_ativos - LAG(mmgd_ativos) OVER w AS delta_mmgd_ativos,
  ROUND(mmgd_potencia_kw - LAG(mmgd_potencia_kw) OVER w, 2) AS delta_mmgd_potencia_kw,
  siga_ativos - LAG(siga_ativos) OVER w AS delta_siga_ativos,
  ROUND(siga_potencia_kw - LAG(siga_potencia_kw) OVER w, 2) AS delta_siga_potencia_kw,
  ROUND(ons_carga_media_mw - LAG(ons_carga_media_mw) OVER w, 2) AS delta_ons_carga_media_mw
FROM growth_rows WINDOW w AS (ORDER BY data)""",
    "growth_log": """
SELECT data, mmgd_ativos, ROUND(mmgd_potencia_kw, 2) AS mmgd_potencia_kw, siga_ativos,
  ROUND(siga_potencia_kw, 2) AS siga_potencia_kw, ROUND(ons_carga_media_mw, 2) AS ons_carga_media_mw, total_registros
FROM growth_rows ORDER BY data DESC LIMIT 30""",
    "growth_history": """
SELECT data, mmgd_ativos, ROUND(mmgd_potencia_kw, 2) AS mmgd_potencia_kw,
  mmgd_ativos - LAG(mmgd_ativos) OVER (ORDER BY data) AS delta_mmgd_ativos,
  ROUND(mmgd_potencia_kw - LAG(mmgd_potencia_kw) OVER (ORDER BY data), 2) AS delta_mmgd_potencia_kw
FROM running""",
    "source_registry_csv": """
SELECT cod_empreendimento AS "CodEmpreendimento", NULLIF(siguf, '') AS "SigUF",
  NULLIF(dscfontegeracao, '') AS "DscFonteGeracao" FROM fact""",
    "source_load_records": """
SELECT area AS _area, 'verificada' AS _fonte, val FROM fx_official
WHERE area IN ('S', 'NE') AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
    "source_planned_load": """
SELECT area AS _area, 'programada' AS _fonte, val FROM fx_official
WHERE area = 'SIN' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
    "source_load_checked": """
SELECT area AS _area, CAST(o.ts AS VARCHAR) AS ts, CAST(CAST(FLOOR(e.value * 10) AS DOUBLE) AS VARCHAR) AS val
FROM fx_official o JOIN events e USING (event_id) WHERE event_id % 50 > 2""",
    "source_dispatch_checked": """
SELECT dia AS din_programacaodia, patamar AS num_patamar, sub AS cod_subsistema, demanda AS val_demanda
FROM fx_dispatch WHERE patamar < 6""",
    "source_pages_checked": """
SELECT 'CEG' || s_suppkey AS "CodCEG" FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey > 1""",
    "source_registry_checked": """
SELECT cod_empreendimento AS "CodEmpreendimento", id FROM fact WHERE id % 10 <> 0""",
    "source_rejects": """
SELECT 'carga' AS fonte, CASE event_id % 50 WHEN 0 THEN 'malformado' WHEN 1 THEN 'sem_campos' ELSE 'sem_data' END AS motivo,
  COUNT(*) AS registros FROM events WHERE event_id % 50 < 3 GROUP BY ALL
UNION ALL SELECT 'dessem', 'malformado', COUNT(*) FROM fx_dispatch WHERE patamar >= 6
UNION ALL SELECT 'siga', CASE n_regionkey WHEN 0 THEN 'malformado' ELSE 'sem_registros' END, 1
FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE n_regionkey < 2 GROUP BY n_regionkey
UNION ALL SELECT 'mmgd', 'malformado', COUNT(*) FROM fact WHERE id % 10 = 0""",
    "source_field_list": """
SELECT UNNEST(['CodEmpreendimento', 'SigUF', 'DscFonteGeracao']) AS id, 'text' AS type""",
    "source_catalogue": """
SELECT 'zip_por_nome' AS escolha, 'u' || MIN(n_nationkey) AS url FROM nation WHERE n_nationkey % 4 = 2
UNION ALL SELECT 'zip_por_formato', 'u' || MIN(n_nationkey) FROM nation WHERE n_nationkey % 4 = 1 AND n_nationkey <> 1
UNION ALL SELECT 'csv', 'u' || n_nationkey FROM nation WHERE n_nationkey % 4 = 0""",
    "source_recent_load": """
SELECT area AS _area, COUNT(*) AS n FROM fx_official
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-20' GROUP BY 1""",
    "source_dispatch_files": """
SELECT dia AS din_programacaodia, patamar AS num_patamar, sub AS cod_subsistema, demanda AS val_demanda,
  hidraulica AS val_ger_hidraulica, pch AS val_ger_pch, termica AS val_ger_termica,
  CASE WHEN patamar <= 3 THEN pct END AS val_ger_pct, eolica AS val_ger_eolica, solar AS val_ger_fotovoltaica,
  mmgd AS val_ger_mmgd, CAST(NULL AS DOUBLE) AS val_cons_elevatoria FROM fx_dispatch""",
    "sink_dispatch": """
SELECT dia, patamar AS num_patamar, sub AS cod_subsistema, demanda AS val_demanda,
  CASE WHEN patamar <= 3 THEN pct END AS val_ger_pct FROM (SELECT DISTINCT * FROM fx_dispatch)""",
    "sink_registry": """
SELECT DISTINCT json_extract_string(raw_json, '$.SigUF') AS "SigUF", TIMESTAMP '2026-01-01' AS ingested_at
FROM fx_raw""",
    "sink_load": """
SELECT CASE WHEN area = 'N' THEN '' ELSE area END AS area, 'verificada' AS tipo, ts, NULLIF(val, 0) AS val, val AS carga_global,
  CAST(ts AS DATE) AS dia FROM fx_official""",
    "cells_maintained": """
SELECT siguf, CASE WHEN id % 7 = 0 THEN 'outra' ELSE dscfontegeracao END AS dscfontegeracao,
  ROUND(SUM(CASE WHEN id % 7 = 0 THEN 2 ELSE 1 END * potencia_instalada_kw), 2) AS potencia_total_kw,
  COUNT(*) AS empreendimentos
FROM fact GROUP BY 1, 2""",
    "sink_fact": "SELECT * FROM fact",
    "sink_geojson": """
SELECT lon, lat, nome_empreendimento, uf, tipo_geracao, potencia_outorgada_kw FROM fx_plants
WHERE lat <> 0 AND lon <> 0""",
    "sink_report": """
SELECT tipo, chave, severidade, ROUND(valor_local, 3) AS valor_local, ROUND(valor_oficial, 3) AS valor_oficial,
  ROUND(delta_pct, 3) AS delta_pct, COUNT(*) OVER () AS total_divergencias,
  COUNT(*) FILTER (severidade = 'critico') OVER () AS criticos,
  COUNT(*) FILTER (severidade = 'atencao') OVER () AS atencoes,
  CAST(CASE WHEN COUNT(*) FILTER (severidade = 'critico') OVER () > 0 THEN 1 ELSE 0 END AS INTEGER) AS falhou,
  (SELECT COUNT(*) FROM fx_raw) AS registros_mmgd_raw, (SELECT COUNT(*) FROM fact) AS registros_mmgd_fato,
  (SELECT COUNT(*) FROM fx_load) AS registros_ons_carga, (SELECT COUNT(*) FROM fx_dispatch) AS registros_dessem_detalhe,
  (SELECT COUNT(*) FROM fx_plants) AS registros_siga_fato
FROM findings""",
    "forecast_load": """
, seasonal AS (SELECT area, ISODOW(rts) - 1 AS wd, HOUR(rts) * 2 + MINUTE(rts) // 30 AS slot, AVG(carga) AS media
  FROM fx_load WHERE CAST(rts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-30' GROUP BY 1, 2, 3)
SELECT g.area, g.data, ROUND(s.media, 6) AS carga_prevista
FROM (SELECT area, data FROM (SELECT DISTINCT area FROM seasonal),
  generate_series(TIMESTAMP '2024-01-31 00:00:00', TIMESTAMP '2024-02-06 23:30:00', INTERVAL 30 MINUTE) AS t(data)) g
LEFT JOIN seasonal s ON s.area = g.area AND s.wd = ISODOW(g.data) - 1
  AND s.slot = HOUR(g.data) * 2 + MINUTE(g.data) // 30""",
    "forecast_capacity": """
, indexed AS (SELECT siguf, (CAST(SUBSTR(mes, 1, 4) AS INTEGER) - 1970) * 12 + CAST(SUBSTR(mes, 6, 2) AS INTEGER) - 1
    AS x, kw FROM monthly),
line AS (SELECT siguf, REGR_SLOPE(kw, x) AS a, REGR_INTERCEPT(kw, x) AS b, MAX(x) AS last FROM indexed GROUP BY 1)
SELECT siguf, printf('%04d-%02d', 1970 + (last + k) // 12, (last + k) % 12 + 1) AS mes,
  CASE WHEN a IS NOT NULL THEN ROUND(GREATEST(0, b + a * (last + k)), 2) END AS potencia_kw
FROM line, (SELECT UNNEST(generate_series(1, 12)) AS k)""",
}

_BODIES["sink_plants"] = _BODIES["plants_upsert"]
_BODIES["sink_treemap"] = f"""
SELECT 'Brasil' AS root, 'MW' AS unit, uf, fonte, mw, qtd FROM ({_BODIES["export_tree"]})"""
_BODIES["source_plant_pages"] = """
SELECT CASE WHEN TRUE THEN 'CEG' || CAST(s_suppkey AS VARCHAR) END AS "CodCEG", s_name AS "NomEmpreendimento",
  n_name AS "SigUFPrincipal",
  CASE s_suppkey % 4 WHEN 0 THEN 'UHE' WHEN 1 THEN 'UTE' WHEN 2 THEN 'EOL' ELSE 'UFV' END AS "SigTipoGeracao",
  CASE WHEN s_suppkey % 13 = 0 THEN '' WHEN s_suppkey % 17 = 0 THEN '1.' || num ELSE num END AS "MdaPotenciaOutorgadaKw",
  CAST(s_suppkey % 30 - 30 AS VARCHAR) || ',5' AS "NumCoordNEmpreendimento"
FROM (SELECT *, REPLACE(CAST(CAST(s_acctbal AS DECIMAL(18, 2)) AS VARCHAR), '.', ',') AS num FROM supplier)
JOIN nation ON s_nationkey = n_nationkey"""

_MIX = """
SELECT '{name}' AS subsistema, dia AS din_programacaodia, patamar AS num_patamar, ROUND(d, 2) AS demanda_mw,
  h AS hidraulica_mw, t AS termica_mw, e AS eolica_mw, s AS solar_mw, m AS mmgd_mw,
  ROUND(h * 100 / w, 1) AS hidraulica_pct, ROUND(t * 100 / w, 1) AS termica_pct, ROUND(e * 100 / w, 1) AS eolica_pct,
  ROUND(s * 100 / w, 1) AS solar_pct
FROM (SELECT *, CASE WHEN h + t + e + s = 0 THEN 1 ELSE h + t + e + s END AS w FROM
  (SELECT dia, patamar, SUM(demanda) AS d, COALESCE(SUM(hidraulica), 0) + COALESCE(SUM(pch), 0) AS h,
     COALESCE(SUM(termica), 0) + COALESCE(SUM(pct), 0) AS t, COALESCE(SUM(eolica), 0) AS e,
     COALESCE(SUM(solar), 0) AS s, COALESCE(SUM(mmgd), 0) AS m
   FROM fx_dispatch {where} GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC LIMIT 1))"""
_BODIES["load_mix_now"] = _MIX.format(name="SIN", where="")
_BODIES["load_mix_now_subsystem"] = _MIX.format(name="NE", where="WHERE sub = 'NE'")


def _oracle(body: str) -> str:
    body = body.strip()
    sql = _with(body)
    # a body that starts with a comma adds tables of its own to the list
    return sql.replace(f"\n{body}", body) if body.startswith(",") else sql


ORACLES = {name: _oracle(body) for name, body in _BODIES.items()}
