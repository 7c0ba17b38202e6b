"""SQL twins of ``checks.tables`` and of every registered query."""

from __future__ import annotations

import re


def _ymd(column: str) -> str:
    return f"CAST(year({column}) * 10000 + month({column}) * 100 + day({column}) AS BIGINT)"


def _clean(column: str, default: str = "") -> str:
    return (
        f"CASE WHEN {column} IS NULL OR upper(trim({column})) IN ('NONE', 'NULL', '') THEN '{default}' "
        f"ELSE trim({column}) END"
    )


TABLES = {
    "simples": """
        SELECT c_custkey AS cnpj_basico,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'S'
                    WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE 'N' END AS opcao_pelo_mei
        FROM customer""",
    "empresas": """
        SELECT c_custkey AS cnpj_basico,
               CASE WHEN c_nationkey = 7 THEN 'null' WHEN c_nationkey = 8 THEN ' ' ELSE c_name END AS razao_social,
               c_nationkey AS natureza_juridica,
               CAST(c_nationkey + 10 AS SMALLINT) AS qualificacao_responsavel,
               CAST(CASE c_custkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 5 ELSE 9 END
                    AS SMALLINT) AS porte_empresa,
               CASE WHEN c_nationkey = 3 THEN '1.' ELSE '' END
                    || replace(CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR), '.', ',') AS capital_social
        FROM customer""",
    "estabelecimentos": f"""
        SELECT o_custkey AS cnpj_basico,
               l_linenumber AS cnpj_ordem,
               CAST(l_quantity AS SMALLINT) AS cnpj_dv,
               CAST(CASE WHEN l_linenumber = 1 THEN 1 WHEN l_linenumber < 7 THEN 2 END AS SMALLINT)
                   AS identificador_matriz_filial,
               CASE l_linenumber WHEN 3 THEN ' none ' WHEN 5 THEN '' WHEN 6 THEN NULL
                    ELSE ' ' || s_name || ' ' || o_orderpriority END AS nome_fantasia,
               CAST(CASE WHEN l_returnflag = 'N' THEN 2 WHEN l_returnflag = 'R' THEN 8
                         WHEN l_quantity >= 49 THEN 9 ELSE 4 END AS SMALLINT) AS situacao_cadastral,
               {_ymd('l_shipdate')} AS data_situacao_cadastral,
               CAST(round(l_discount * 100) AS SMALLINT) AS motivo_situacao_cadastral,
               CAST(NULL AS VARCHAR) AS nome_cidade_exterior,
               n_regionkey AS pais,
               {_ymd('o_orderdate')} AS data_inicio_atividade,
               l_partkey * 500 AS cnae_fiscal_principal,
               CASE l_linenumber
                    WHEN 2 THEN ' ' || (l_partkey * 500) || ' , ,' || (l_suppkey * 500)
                    WHEN 4 THEN (l_partkey * 500) || ',x'
                    WHEN 6 THEN NULL
                    WHEN 7 THEN ''
                    ELSE (l_partkey * 500) || ',' || (l_suppkey * 500) END AS cnae_fiscal_secundaria,
               CASE WHEN l_linestatus = 'O' THEN 'RUA' END AS tipo_logradouro,
               o_orderpriority AS logradouro,
               CASE WHEN l_linenumber <> 2 THEN CAST(l_orderkey AS VARCHAR) END AS numero,
               CASE WHEN l_returnflag = 'N' THEN 'SALA ' || l_linenumber WHEN l_returnflag = 'R' THEN '' END
                   AS complemento,
               n_name AS bairro,
               CASE WHEN l_linenumber <> 5 THEN l_orderkey + 1000000 END AS cep,
               n_name AS uf,
               l_suppkey AS municipio,
               n_nationkey AS ddd_1,
               CAST(o_orderkey + 30000000 AS VARCHAR) AS telefone_1,
               CASE WHEN l_linenumber <= 2 THEN 11 END AS ddd_2,
               CASE l_linenumber WHEN 1 THEN '40004000' WHEN 2 THEN '' END AS telefone_2,
               CAST(NULL AS INTEGER) AS ddd_fax,
               CAST(NULL AS VARCHAR) AS fax,
               CASE WHEN l_linenumber <> 4 THEN lower(replace(s_name, '#', '')) || '@example.com' END
                   AS correio_eletronico,
               CAST(NULL AS VARCHAR) AS situacao_especial,
               CAST(NULL AS BIGINT) AS data_situacao_especial
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey""",
    "socios": """
        SELECT chave AS cnpj_basico,
               CAST(tipo AS SMALLINT) AS identificador_socio,
               CASE s_nationkey WHEN 4 THEN 'NULL' WHEN 5 THEN '  ' ELSE ' ' || s_name || sufixo END
                   AS nome_socio_razao_social,
               CASE WHEN s_nationkey <> 6 THEN '***' || s_suppkey || '**' END AS cnpj_cpf_socio,
               CAST(s_nationkey AS SMALLINT) AS qualificacao_socio,
               CAST(s_nationkey + 20100101 AS BIGINT) AS data_entrada_sociedade
        FROM (SELECT *, s_suppkey AS chave, s_suppkey % 4 AS tipo, ' ' AS sufixo FROM supplier
              UNION ALL
              SELECT *, (s_suppkey + 1) // 2, (s_suppkey + 1) % 4, ' II ' FROM supplier)""",
    "cnaes": """
        SELECT p_partkey * 500 AS codigo,
               array_to_string(list_transform(string_split(p_name, ' '),
                   lambda w: upper(w[1]) || lower(w[2:])), ' ')
               || ' – comércio de ' || lower(p_type) || ' ' || lower(p_brand) AS descricao
        FROM part WHERE p_size > 5""",
    "municipios": "SELECT s_suppkey AS codigo, s_name AS descricao FROM supplier WHERE s_acctbal > 0",
    "naturezas": "SELECT CAST(n_nationkey AS BIGINT) AS codigo, n_name AS descricao FROM nation WHERE n_regionkey <> 2",
    "mei": "SELECT DISTINCT cnpj_basico FROM simples WHERE opcao_pelo_mei = 'S'",
    "empresas_mei": """
        SELECT cnpj_basico, razao_social, natureza_juridica, qualificacao_responsavel, porte_empresa,
               coalesce(try_cast(replace(capital_social, ',', '.') AS DOUBLE), 0.0) AS capital_social
        FROM empresas WHERE cnpj_basico IN (SELECT cnpj_basico FROM mei)""",
    "fato": """
        SELECT e.*, c.natureza_juridica, c.qualificacao_responsavel, c.porte_empresa, c.capital_social,
               s.identificador_socio, s.nome_socio_razao_social, s.cnpj_cpf_socio, s.qualificacao_socio,
               s.data_entrada_sociedade, c.razao_social
        FROM estabelecimentos e
        JOIN empresas_mei c USING (cnpj_basico)
        LEFT JOIN socios s USING (cnpj_basico)""",
    "janela": """
        SELECT *, CAST(data_inicio_atividade // 10000 AS INTEGER) AS ano_abertura,
               CAST(data_inicio_atividade % 10000 // 100 AS INTEGER) AS mes_abertura
        FROM fato WHERE data_inicio_atividade >= 19960000 AND data_inicio_atividade < 20010000""",
    "fechados": """
        SELECT CAST(data_situacao_cadastral // 10000 AS INTEGER) AS ano,
               CAST(data_situacao_cadastral % 10000 // 100 AS INTEGER) AS mes
        FROM janela
        WHERE situacao_cadastral = 8 AND data_situacao_cadastral > 0
          AND data_situacao_cadastral // 10000 BETWEEN 1996 AND 2001""",
    "anual": """
        SELECT coalesce(a.ano, f.ano) AS ano, coalesce(aberturas, 0) AS aberturas,
               coalesce(fechamentos, 0) AS fechamentos
        FROM (SELECT ano_abertura AS ano, count(*) AS aberturas FROM janela GROUP BY 1) a
        FULL JOIN (SELECT ano, count(*) AS fechamentos FROM fechados GROUP BY 1) f ON a.ano = f.ano""",
    "por_uf": """
        SELECT uf, count(*) AS total, CAST(count_if(situacao_cadastral = 2) AS BIGINT) AS ativos,
               avg(capital_social) AS media_capital
        FROM janela GROUP BY uf""",
    "por_cnae": """
        SELECT cnae_fiscal_principal, count(*) AS total,
               CAST(count_if(situacao_cadastral = 2) AS BIGINT) AS ativos, avg(capital_social) AS media_capital
        FROM janela GROUP BY 1""",
    # Documents: one row per distinct fact row, then per establishment and per partner.
    "distintas": "SELECT DISTINCT * FROM fato",
    "cabecalhos": f"""
        SELECT DISTINCT cnpj_basico AS _id, {_clean('razao_social')} AS razao_social, natureza_juridica,
               capital_social, porte_empresa
        FROM distintas""",
    "unidades": f"""
        SELECT cnpj_basico AS _id, cnpj_ordem, cnpj_dv,
               coalesce(identificador_matriz_filial, 1) AS identificador_matriz_filial,
               {_clean('nome_fantasia')} AS nome_fantasia, situacao_cadastral, data_situacao_cadastral,
               data_inicio_atividade, cnae_fiscal_principal,
               CASE WHEN len([t FOR t IN tokens IF try_cast(t AS BIGINT) IS NULL]) > 0 THEN []
                    ELSE [CAST(t AS BIGINT) FOR t IN tokens] END AS secundarias,
               tipo_logradouro, logradouro, numero, complemento, bairro, cep, uf, municipio,
               ddd_1, telefone_1, ddd_2, telefone_2, correio_eletronico
        FROM (SELECT *, [trim(t) FOR t IN string_split(coalesce(cnae_fiscal_secundaria, ''), ',')
                         IF trim(t) <> ''] AS tokens FROM distintas)""",
    "socios_doc": f"""
        SELECT DISTINCT cnpj_basico AS _id, identificador_socio, {_clean('nome_socio_razao_social')} AS nome,
               coalesce(cnpj_cpf_socio, '') AS cpf, qualificacao_socio, data_entrada_sociedade
        FROM distintas WHERE {_clean('nome_socio_razao_social')} <> ''""",
}
_ORDER = list(TABLES)


def _with(query: str) -> str:
    """Prefix the tables a query needs, found by name, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _ORDER:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(TABLES[name])

    visit(query)
    if not needed:
        return query.strip()
    parts = ", ".join(f"{name} AS ({TABLES[name].strip()})" for name in _ORDER if name in needed)
    return f"WITH {parts} {query.strip()}"


STATUS = """CASE situacao_cadastral WHEN 1 THEN 'Nula' WHEN 2 THEN 'Ativa' WHEN 3 THEN 'Suspensa'
            WHEN 4 THEN 'Inapta' WHEN 8 THEN 'Baixada' ELSE 'Desconhecido' END"""
SIZE = """CASE porte_empresa WHEN 0 THEN 'Não Informado' WHEN 1 THEN 'Micro Empresa'
          WHEN 3 THEN 'Empresa de Pequeno Porte' WHEN 5 THEN 'Demais' ELSE 'Desconhecido' END"""
PCT_ACTIVE = "round(ativos / total * 100, 1) AS pct_ativos"


def _top(table: str, key: str, n: int) -> str:
    return f"(SELECT * FROM {table} ORDER BY total DESC, {key} LIMIT {n})"


def _coded(table: str, code: str, dim: str, default: str, columns: str) -> str:
    return (
        f"SELECT {columns}, coalesce(d.descricao, '{default}') AS descricao "
        f"FROM {table} t LEFT JOIN {dim} d ON t.{code} = d.codigo"
    )


def _text(*columns: str) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)


UNIT_TEXT = _text(
    "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia", "situacao_cadastral",
    "data_situacao_cadastral", "data_inicio_atividade", "cnae_fiscal_principal",
    "array_to_string(secundarias, ',')", "tipo_logradouro", "logradouro", "numero", "complemento", "bairro",
    "cep", "uf", "municipio", "ddd_1", "telefone_1", "ddd_2", "telefone_2", "correio_eletronico",
)
PARTNER_TEXT = _text("identificador_socio", "nome", "cpf", "qualificacao_socio", "data_entrada_sociedade")


def _documents(condition: str = "TRUE") -> str:
    """Documents as text, one row per company."""
    return f"""
        SELECT h._id, h.razao_social, h.natureza_juridica, h.capital_social, h.porte_empresa,
               'S' AS opcao_pelo_simples, 'S' AS opcao_pelo_mei,
               coalesce(s.n, 0) AS n_socios, coalesce(s.textos, '') AS socios,
               u.n AS n_estabelecimentos, u.textos AS estabelecimentos
        FROM cabecalhos h
        JOIN (SELECT _id, count(*) AS n, string_agg({UNIT_TEXT}, ';' ORDER BY {UNIT_TEXT}) AS textos
              FROM unidades GROUP BY _id) u ON u._id = h._id
        LEFT JOIN (SELECT _id, count(*) AS n, string_agg({PARTNER_TEXT}, ';' ORDER BY {PARTNER_TEXT}) AS textos
                   FROM socios_doc GROUP BY _id) s ON s._id = h._id
        WHERE {condition}"""


def _resolved(code: str, text: str) -> str:
    return (
        f"CASE WHEN {code} IS NULL THEN 'Não informado' WHEN {text} IS NOT NULL THEN {text} "
        f"ELSE 'Código ' || {code} END"
    )


_FACT_COLUMNS = "* EXCLUDE (razao_social)"
_PT = "translate(format('{:,.%df}', %s), ',.', '.,')"


def _pt(value: str, decimals: int) -> str:
    return _PT % (decimals, value)


def _date_text(column: str) -> str:
    t = f"CAST({column} AS VARCHAR)"
    return (
        f"CASE WHEN {column} IS NULL OR {column} = 0 THEN '—' WHEN length({t}) = 8 "
        f"THEN substr({t}, 7, 2) || '/' || substr({t}, 5, 2) || '/' || substr({t}, 1, 4) ELSE {t} END"
    )


def _zfill(value: str, width: int) -> str:
    t = f"CAST({value} AS VARCHAR)"
    return f"lpad({t}, CAST(greatest(length({t}), {width}) AS INTEGER), '0')"


def _company_id(base: str, order: str, check: str) -> str:
    b = _zfill(base, 8)
    return (
        f"CASE WHEN {order} IS NULL OR {check} IS NULL THEN {b} ELSE substr({b}, 1, 2) || '.' || substr({b}, 3, 3) "
        f"|| '.' || substr({b}, 6) || '/' || {_zfill(order, 4)} || '-' || {_zfill(check, 2)} END"
    )


def _postal(code: str) -> str:
    return (
        f"CASE WHEN {code} IS NULL OR {code} = 0 THEN '—-' "
        f"ELSE substr({_zfill(code, 8)}, 1, 5) || '-' || substr({_zfill(code, 8)}, 6) END"
    )


def _ellipsis(text: str, limit: int, keep: int) -> str:
    return f"CASE WHEN length({text}) > {limit} THEN substr({text}, 1, {keep}) || '...' ELSE {text} END"


# Typed values behind the raw lines of ``checks.catalog.raw_lines``.
RAW_TYPED = """
    SELECT c_custkey AS cnpj_basico,
           c_name || '; "x" \\' AS razao_social,
           CASE WHEN c_nationkey = 5 THEN NULL WHEN c_nationkey = 6 THEN 65535 WHEN c_nationkey = 7 THEN NULL
                ELSE c_nationkey END AS natureza_juridica,
           CAST(CASE WHEN c_nationkey > 20 THEN NULL ELSE 235 + c_nationkey END AS SMALLINT)
               AS qualificacao_responsavel,
           replace(CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR), '.', ',') AS capital_social,
           CAST(CASE WHEN c_nationkey < 10 THEN NULL WHEN c_nationkey < 15 THEN NULL ELSE 5 END AS SMALLINT)
               AS porte_empresa,
           CAST(NULL AS VARCHAR) AS ente_federativo_responsavel
    FROM customer"""


# The same with a line break in the names that end in 1.
BROKEN_TYPED = RAW_TYPED.replace(
    "c_name ||",
    "CASE WHEN ends_with(c_name, '1') THEN replace(c_name, 'Customer#', 'Customer#' || chr(10)) ELSE c_name END ||",
)

TEXTS = """nome_fantasia nome_cidade_exterior cnae_fiscal_secundaria tipo_logradouro logradouro numero complemento bairro uf
telefone_1 telefone_2 fax correio_eletronico situacao_especial nome_socio_razao_social cnpj_cpf_socio""".split()


def _loaded(source: str) -> str:
    """The fact after a way through raw files: texts are trimmed, missing ones empty."""
    texts = ", ".join(f"coalesce(trim({c}), '') AS {c}" for c in TEXTS)
    return f"SELECT * EXCLUDE (razao_social) REPLACE ({texts}) FROM {source}"


WHOLE_ACTIVITIES = TABLES["cnaes"].replace("FROM part WHERE p_size > 5", "FROM part")
DIMENSIONS = f"""
    SELECT 'naturezas' AS dominio, CAST(n_nationkey AS BIGINT) AS codigo, n_name AS descricao FROM nation
    UNION ALL SELECT 'qualificacoes', CAST(r_regionkey + 100 AS BIGINT), r_name FROM region
    UNION ALL SELECT 'motivos', CAST(n_nationkey + 50 AS BIGINT), n_name FROM nation
    UNION ALL SELECT 'municipios', s_suppkey, s_name FROM supplier
    UNION ALL SELECT 'paises', CAST(r_regionkey AS BIGINT), r_name FROM region
    UNION ALL SELECT 'cnaes', codigo, descricao FROM ({WHOLE_ACTIVITIES})"""


HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
LINKS = " UNION ALL ".join(
    f"SELECT page_id, url, unnest(regexp_extract_all("
    f"regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>', '', 'g'), '{HREF}', {group})) AS href FROM pages"
    for group in (1, 2, 3)
)
HARVEST = f"SELECT page_id, url, replace(href, '&amp;', '&') AS href FROM ({LINKS}) WHERE href <> ''"

SHEET = f"""
    SELECT u._id, {_clean('h.razao_social', 'Sem nome (Razão Social não cadastrada)')} AS razao_social,
           {_zfill('u._id', 8)} AS cnpj_basico,
           'R$ ' || {_pt('h.capital_social', 2)} AS capital_social,
           {_resolved('h.natureza_juridica', 'n.descricao')} AS natureza,
           CASE h.porte_empresa WHEN 0 THEN 'Não Informado' WHEN 1 THEN 'Micro Empresa'
                WHEN 3 THEN 'Empresa de Pequeno Porte' WHEN 5 THEN 'Demais' ELSE 'Não informado' END AS porte,
           'S' AS simples, 'S' AS mei,
           coalesce(s.textos, '') AS socios,
           count(*) OVER (PARTITION BY u._id) AS n_estabelecimentos,
           CASE identificador_matriz_filial WHEN 1 THEN 'Matriz' WHEN 2 THEN 'Filial' ELSE '—' END AS tipo,
           {_company_id('u._id', 'cnpj_ordem', 'cnpj_dv')} AS cnpj,
           {STATUS} AS situacao,
           CASE WHEN nome_fantasia = '' THEN 'Sem nome fantasia' ELSE nome_fantasia END AS nome_fantasia,
           {_resolved('cnae_fiscal_principal', 'a.descricao')} AS cnae_principal,
           {_date_text('data_inicio_atividade')} AS abertura,
           trim(coalesce(tipo_logradouro, '') || ' ' || coalesce(logradouro, '') || ', ' || coalesce(numero, 'S/N')
               || ' ' || CASE WHEN coalesce(complemento, '') <> '' THEN '- ' || complemento ELSE '' END
               || ' — ' || coalesce(bairro, '') || ' — ' || {_resolved('municipio', 'm.descricao')} || '/'
               || coalesce(uf, '') || ' — CEP ' || {_postal('cep')}) AS endereco,
           CASE WHEN fone = '' THEN '—' ELSE fone END AS telefones,
           coalesce(correio_eletronico, '—') AS email,
           coalesce((SELECT string_agg({_resolved('c.codigo', 'x.descricao')}, ' • ' ORDER BY c.ordem)
                     FROM (SELECT unnest(secundarias[1:5]) AS codigo,
                                  unnest(range(1, len(secundarias[1:5]) + 1)) AS ordem) c
                     LEFT JOIN cnaes x ON x.codigo = c.codigo), '') AS cnaes_secundarios
    FROM (SELECT *, concat_ws(' | ',
                 CASE WHEN ddd_1 <> 0 AND telefone_1 <> '' THEN '(' || ddd_1 || ') ' || telefone_1 END,
                 CASE WHEN ddd_2 <> 0 AND telefone_2 <> '' THEN '(' || ddd_2 || ') ' || telefone_2 END) AS fone
          FROM unidades) u
    JOIN cabecalhos h ON h._id = u._id
    LEFT JOIN naturezas n ON n.codigo = h.natureza_juridica
    LEFT JOIN cnaes a ON a.codigo = cnae_fiscal_principal
    LEFT JOIN municipios m ON m.codigo = municipio
    LEFT JOIN (SELECT _id, string_agg(t, '; ' ORDER BY identificador_socio, nome, cpf, qualificacao_socio) AS textos
               FROM (SELECT *, nome || ' (' || CASE identificador_socio WHEN 1 THEN 'Pessoa Jurídica'
                       WHEN 2 THEN 'Pessoa Física' WHEN 3 THEN 'Estrangeiro' ELSE 'Não informado' END || ')' AS t
                     FROM socios_doc)
               GROUP BY _id) s ON s._id = u._id"""

FLOW_MONTHLY = """
    SELECT coalesce(a.ano, f.ano) AS ano, coalesce(a.mes, f.mes) AS mes, coalesce(aberturas, 0) AS aberturas,
           coalesce(fechamentos, 0) AS fechamentos,
           make_date(coalesce(a.ano, f.ano), coalesce(a.mes, f.mes), 1) AS data_mes
    FROM (SELECT ano_abertura AS ano, mes_abertura AS mes, count(*) AS aberturas FROM janela GROUP BY 1, 2) a
    FULL JOIN (SELECT ano, mes, count(*) AS fechamentos FROM fechados GROUP BY 1, 2) f
      ON a.ano = f.ano AND a.mes = f.mes"""

DIVISIONS = _coded(
    "(SELECT cnae_fiscal_principal, total FROM por_cnae)", "cnae_fiscal_principal", "cnaes", "Sem descrição",
    "t.*, CAST(cnae_fiscal_principal // 100000 AS INTEGER) AS divisao_cnae",
)
TOWNS_BY_STATE = _coded(
    """(SELECT uf, municipio, total FROM (
            SELECT uf, municipio, count(*) AS total,
                   row_number() OVER (PARTITION BY uf ORDER BY count(*) DESC, municipio) AS posicao
            FROM janela GROUP BY uf, municipio) WHERE posicao <= 5)""",
    "municipio", "municipios", "Não informado", "t.*",
)
DETAIL = _coded(
    _top("por_cnae", "cnae_fiscal_principal", 20), "cnae_fiscal_principal", "cnaes", "Sem descrição",
    f"cnae_fiscal_principal, total, ativos, round(media_capital, 4) AS media_capital, {PCT_ACTIVE}",
)

LOOKUP = f"""
        SELECT event_id, pedido, q._id, CASE WHEN q._id IS NULL THEN 'invalido' WHEN h._id IS NULL THEN 'ausente'
               ELSE 'encontrado' END AS status, h.razao_social, h.unidades
        FROM (SELECT event_id, pedido, try_cast(trim(pedido) AS BIGINT) AS _id
              FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN event_type
                                          ELSE '  ' || user_id || ' ' END AS pedido FROM events)) q
        LEFT JOIN (SELECT h._id, h.razao_social, count(*) AS unidades
                   FROM cabecalhos h JOIN unidades u ON u._id = h._id GROUP BY 1, 2) h ON h._id = q._id"""

QUERIES = {
    # Load stages
    "mei_keys": "SELECT cnpj_basico FROM mei",
    "semi_companies": """SELECT cnpj_basico, natureza_juridica, qualificacao_responsavel, porte_empresa, capital_social
                         FROM empresas_mei""",
    "semi_partners": "SELECT * FROM socios WHERE cnpj_basico IN (SELECT cnpj_basico FROM mei)",
    "semi_establishments": "SELECT * FROM estabelecimentos WHERE cnpj_basico IN (SELECT cnpj_basico FROM mei)",
    "inner_establishments_companies": """
        SELECT e.cnpj_basico, cnpj_ordem, cnpj_dv, natureza_juridica, porte_empresa, capital_social
        FROM estabelecimentos e JOIN empresas_mei USING (cnpj_basico)""",
    "left_partners": """
        SELECT cnpj_basico, porte_empresa, identificador_socio, nome_socio_razao_social
        FROM empresas_mei LEFT JOIN socios USING (cnpj_basico)""",
    "fact_gold": f"SELECT {_FACT_COLUMNS} FROM fato",
    "stage_counts": """
        SELECT 'mei' AS etapa, count(*) AS linhas FROM mei
        UNION ALL SELECT 'empresas', count(*) FROM empresas_mei
        UNION ALL SELECT 'socios', count(*) FROM socios WHERE cnpj_basico IN (SELECT cnpj_basico FROM mei)
        UNION ALL SELECT 'fato', count(*) FROM fato""",
    "fanout_report": "SELECT cnpj_basico, count(*) AS linhas FROM socios GROUP BY 1 HAVING count(*) > 1",
    "distinct_rows": f"SELECT {_FACT_COLUMNS} FROM distintas",
    "csv_typed_cast": RAW_TYPED,
    "csv_file_read": RAW_TYPED,
    "stream_ingest": RAW_TYPED,
    "csv_line_breaks": BROKEN_TYPED,
    "stream_line_breaks": BROKEN_TYPED,
    "csv_quarantine": """
        SELECT CASE c_nationkey % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'short' ELSE 'long' END AS reason, count(*) AS linhas
        FROM customer GROUP BY 1 UNION ALL SELECT 'unclosed', 1""",
    "csv_quarantined_lines": """
        SELECT CASE c_nationkey % 3 WHEN 1 THEN 'short' ELSE 'long' END AS reason,
               c_custkey || ';"' || c_name || '; ' || repeat('"', 2) || 'x' || repeat('"', 3) || ';' || c_nationkey || ';49;"1,00";05'
               || CASE c_nationkey % 3 WHEN 1 THEN '' ELSE ';;more;fields' END AS line
        FROM customer WHERE c_nationkey % 3 <> 0
        UNION ALL SELECT 'unclosed', '7;"' || r_name FROM region WHERE r_regionkey = 0""",
    "csv_fitting_rows": """
        SELECT c_custkey AS cnpj_basico, c_name || '; "x"' AS razao_social, c_nationkey AS natureza_juridica,
               CAST(5 AS SMALLINT) AS porte_empresa
        FROM customer WHERE c_nationkey % 3 = 0""",
    "snapshot_rewrites_unfinished": "SELECT uf, count(*) AS linhas FROM fato GROUP BY uf",
    "job_fact": _loaded("fato"),
    "job_fact_bucketed": _loaded("fato"),
    "table_columns": """
        SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS posicao, column_name AS coluna,
               CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS tipo
        FROM (DESCRIBE customer)""",
    "source_files": """
        SELECT tabela, count(*) > 0 AS tem_arquivos
        FROM (SELECT unnest(['Empresas', 'Estabelecimentos', 'Simples', 'Socios']) AS tabela, n_nationkey FROM nation)
        GROUP BY tabela""",
    "job_fact_without_partners": _loaded(
        """(SELECT e.*, c.natureza_juridica, c.qualificacao_responsavel, c.porte_empresa, c.capital_social,
                   CAST(NULL AS SMALLINT) AS identificador_socio, CAST(NULL AS VARCHAR) AS nome_socio_razao_social,
                   CAST(NULL AS VARCHAR) AS cnpj_cpf_socio, CAST(NULL AS SMALLINT) AS qualificacao_socio,
                   CAST(NULL AS BIGINT) AS data_entrada_sociedade, c.razao_social
            FROM estabelecimentos e JOIN empresas_mei c USING (cnpj_basico))"""
    ),
    "job_stage_counts": """
        SELECT 'empresas' AS etapa, count(*) AS linhas FROM empresas_mei UNION ALL SELECT 'fato', count(*) FROM fato""",
    "job_dimensions": DIMENSIONS.replace("–", "-"),
    "job_rewrites_unfinished": "SELECT cnpj_basico, natureza_juridica, porte_empresa FROM empresas",
    "job_documents": """
        SELECT h._id, h.razao_social, h.natureza_juridica, h.capital_social, h.porte_empresa, u.n AS unidades
        FROM cabecalhos h JOIN (SELECT _id, count(*) AS n FROM unidades GROUP BY _id) u ON u._id = h._id""",
    "cast_loss_report": """
        SELECT 'cnpj_basico' AS coluna, count(*) AS preenchidos, CAST(0 AS BIGINT) AS perdidos FROM customer
        UNION ALL SELECT 'natureza_juridica', CAST(count_if(c_nationkey <> 5) AS BIGINT),
                         CAST(count_if(c_nationkey = 7) AS BIGINT) FROM customer
        UNION ALL SELECT 'qualificacao_responsavel', count(*), CAST(count_if(c_nationkey > 20) AS BIGINT) FROM customer
        UNION ALL SELECT 'porte_empresa', count(*), CAST(count_if(c_nationkey < 15) AS BIGINT) FROM customer""",
    "snapshot_latest": "SELECT uf, count(*) AS linhas FROM fato GROUP BY uf",
    "snapshot_all": """
        SELECT snapshot, count(*) AS linhas FROM (
            SELECT '20240101' AS snapshot FROM fato WHERE data_inicio_atividade < 19980000
            UNION ALL SELECT '20250101' FROM fato) GROUP BY snapshot""",
    # Overview
    "kpis": """
        SELECT count(*) AS total, CAST(count_if(situacao_cadastral = 2) AS BIGINT) AS ativos,
               round(avg(capital_social), 4) AS media_capital, round(median(capital_social), 4) AS mediana_capital,
               count(DISTINCT uf) + coalesce(max(CASE WHEN uf IS NULL THEN 1 ELSE 0 END), 0) AS total_ufs,
               round(count_if(situacao_cadastral = 2) / count(*) * 100, 4) AS taxa_atividade
        FROM janela""",
    "kpis_sketched": """
        SELECT uf, count(*) AS total, CAST(count_if(situacao_cadastral = 2) AS BIGINT) AS ativos, TRUE AS mediana_ok,
               TRUE AS empresas_ok
        FROM janela WHERE uf IS NOT NULL GROUP BY uf""",
    "dist_situacao": f"""SELECT situacao_cadastral, count(*) AS total, {STATUS} AS situacao_desc
                         FROM janela GROUP BY situacao_cadastral""",
    "dist_porte": f"SELECT porte_empresa, count(*) AS total, {SIZE} AS porte_desc FROM janela GROUP BY porte_empresa",
    "top_cnaes": _coded(_top("por_cnae", "cnae_fiscal_principal", 10), "cnae_fiscal_principal", "cnaes",
                        "Sem descrição", "cnae_fiscal_principal, total"),
    "top_cnaes_short": f"""SELECT cnae_fiscal_principal, total, {_ellipsis('descricao', 50, 47)} AS descricao_curta
        FROM ({_coded(_top("por_cnae", "cnae_fiscal_principal", 10), "cnae_fiscal_principal", "cnaes",
                      "Sem descrição", "cnae_fiscal_principal, total")})""",
    # Time series
    "annual_series": "SELECT * FROM anual",
    "monthly_series": FLOW_MONTHLY,
    "openings_year": "SELECT ano_abertura, count(*) AS total FROM janela GROUP BY 1",
    "openings_month": "SELECT ano_abertura, mes_abertura, count(*) AS total FROM janela GROUP BY 1, 2",
    "openings_year_porte": f"""SELECT ano_abertura, porte_empresa, count(*) AS total, {SIZE} AS porte_desc
                               FROM janela GROUP BY 1, 2""",
    "avg_capital_year": "SELECT ano_abertura, round(avg(capital_social), 4) AS media_capital FROM janela GROUP BY 1",
    "period_kpis": """
        SELECT CAST(sum(aberturas) AS BIGINT) AS total_aberturas, CAST(sum(fechamentos) AS BIGINT) AS total_fechamentos,
               CAST(sum(aberturas) - sum(fechamentos) AS BIGINT) AS saldo
        FROM anual WHERE ano BETWEEN 1997 AND 1999""",
    "annual_long": """
        SELECT ano, 'Aberturas' AS tipo, aberturas AS quantidade FROM anual WHERE ano BETWEEN 1997 AND 2001
        UNION ALL SELECT ano, 'Fechamentos', fechamentos FROM anual WHERE ano BETWEEN 1997 AND 2001""",
    "pivot_mean": "SELECT mes_abertura, " + ", ".join(
        f'coalesce(avg(CASE WHEN ano_abertura = {y} THEN total END), 0) AS "{y}"' for y in range(1996, 2001)
    ) + " FROM (SELECT ano_abertura, mes_abertura, count(*) AS total FROM janela GROUP BY 1, 2) GROUP BY mes_abertura",
    # Geography
    "by_uf": f"""SELECT uf, total, ativos, round(media_capital, 4) AS media_capital, {PCT_ACTIVE} FROM por_uf""",
    "top_municipios": f"""SELECT municipio, total, descricao, {_ellipsis('descricao', 35, 32)} AS municipio_nome FROM (
        {_coded(_top("(SELECT municipio, count(*) AS total FROM janela GROUP BY 1)", "municipio", 15),
                "municipio", "municipios", "Não informado", "municipio, total")})""",
    "top_municipios_per_uf": TOWNS_BY_STATE,
    "rollup_municipios": f"""
        SELECT uf, descricao, CAST(sum(total) AS BIGINT) AS total,
               CAST(bit_count(grouping(uf, descricao)) AS INTEGER) AS nivel
        FROM ({TOWNS_BY_STATE}) GROUP BY ROLLUP (uf, descricao)""",
    "uf_share": "SELECT uf, total, round(total / sum(total) OVER () * 100, 4) AS pct_total FROM por_uf",
    "geo_leader": f"""
        SELECT uf, total, round(total / (SELECT sum(total) FROM por_uf) * 100, 4) AS pct,
               (SELECT count(*) FROM por_uf) AS n_ufs
        FROM {_top('por_uf', 'uf', 1)}""",
    # Activities
    "top_cnaes_detail": DETAIL,
    "cnae_by_situacao": f"""
        SELECT cnae_fiscal_principal, situacao_cadastral, total, coalesce(d.descricao, 'Sem descrição') AS descricao,
               {STATUS} AS situacao_desc
        FROM (SELECT cnae_fiscal_principal, situacao_cadastral, count(*) AS total FROM janela
              WHERE cnae_fiscal_principal IN
                    (SELECT cnae_fiscal_principal FROM {_top('por_cnae', 'cnae_fiscal_principal', 10)})
              GROUP BY 1, 2) t
        LEFT JOIN cnaes d ON d.codigo = cnae_fiscal_principal""",
    "cnae_division": DIVISIONS,
    "rollup_division": f"""
        SELECT divisao_cnae, descricao, CAST(sum(total) AS BIGINT) AS total,
               CAST(bit_count(grouping(divisao_cnae, descricao)) AS INTEGER) AS nivel
        FROM ({DIVISIONS}) GROUP BY ROLLUP (divisao_cnae, descricao)""",
    "top_cnae_evolution": f"""
        SELECT ano_abertura, cnae_fiscal_principal, total, coalesce(d.descricao, 'Sem descrição') AS descricao,
               {_ellipsis("coalesce(d.descricao, 'Sem descrição')", 30, 27)} AS cnae_desc
        FROM (SELECT ano_abertura, cnae_fiscal_principal, count(*) AS total FROM janela
              WHERE cnae_fiscal_principal IN
                    (SELECT cnae_fiscal_principal FROM {_top('por_cnae', 'cnae_fiscal_principal', 5)})
              GROUP BY 1, 2) t
        LEFT JOIN cnaes d ON d.codigo = cnae_fiscal_principal""",
    "cnae_leader": f"""
        SELECT cnae_fiscal_principal, {_ellipsis('descricao', 40, 40)} AS descricao, total, pct
        FROM (SELECT *, round(total / sum(total) OVER () * 100, 4) AS pct FROM ({DETAIL}))
        ORDER BY total DESC, cnae_fiscal_principal LIMIT 1""",
    "top_cnaes_ascending": f"""
        SELECT row_number() OVER (ORDER BY total, cnae_fiscal_principal) - 1 AS posicao, cnae_fiscal_principal, total
        FROM {_top('por_cnae', 'cnae_fiscal_principal', 10)}""",
    "cnae_picker": f"SELECT codigo, codigo || ' - ' || descricao AS opcao FROM ({WHOLE_ACTIVITIES})",
    # Filters and code resolution
    "filters_all": """
        SELECT uf, situacao_cadastral, porte_empresa, count(*) AS total FROM fato
        WHERE uf IN ('NATION_3', 'NATION_9', 'NATION_11') AND situacao_cadastral IN (2, 8)
          AND porte_empresa IN (1, 5) AND data_inicio_atividade >= 19970000 AND data_inicio_atividade < 20000000
        GROUP BY 1, 2, 3""",
    "filters_clustered": """
        SELECT uf, situacao_cadastral, cnae_fiscal_principal, count(*) AS total FROM fato
        WHERE uf = 'NATION_9' AND data_inicio_atividade >= 19970000 AND data_inicio_atividade < 20000000
        GROUP BY 1, 2, 3""",
    "filters_activity": "SELECT uf, count(*) AS total FROM fato WHERE cnae_fiscal_principal = 25000 GROUP BY uf",
    "resolve_codes": f"""
        SELECT t.identificador_socio AS codigo, t.total, {_resolved('t.identificador_socio', 'd.r_name')} AS descricao
        FROM (SELECT identificador_socio, count(*) AS total FROM fato GROUP BY 1) t
        LEFT JOIN region d ON d.r_regionkey = t.identificador_socio""",
    "dimensions_all": DIMENSIONS,
    "format_fields": f"""
        SELECT o_orderkey, {_pt('o_totalprice', 0)} AS inteiro, {_pt('o_totalprice', 2)} AS decimal,
               'R$ ' || {_pt('o_totalprice', 2)} AS moeda,
               translate(format('{{:.1f}}', o_totalprice / 1000), '.', ',') || '%' AS percentual,
               {_date_text(_ymd('o_orderdate'))} AS data,
               {_company_id('o_custkey', 'o_orderkey', 'o_custkey % 100')} AS cnpj,
               {_postal('o_custkey')} AS cep
        FROM orders""",
    "secondary_codes": """
        SELECT cnpj_ordem, array_to_string(secundarias, ',') AS codigos, count(*) AS linhas
        FROM unidades GROUP BY 1, 2""",
    "link_harvest": HARVEST,
    "link_harvest_suffix": f"SELECT * FROM ({HARVEST}) WHERE ends_with(lower(href), 'en')",
    "file_category": r"""
        SELECT regexp_replace(regexp_replace(nome, '(.)\.[^.]*$', '\1'), '\d+$', '') AS categoria, count(*) AS arquivos
        FROM (SELECT c_mktsegment || c_custkey || '.ZIP' AS nome FROM customer
              UNION ALL SELECT regexp_extract(url, '[^/]*$') FROM pages)
        GROUP BY 1""",
    # Documents
    "documents_flat": _documents(),
    "doc_merge": _documents(),
    "doc_store_merge": _documents(),
    "doc_stream_upsert": _documents(),
    "doc_by_key": _documents("h._id = 11"),
    "doc_by_key_stored": _documents("h._id = 11"),
    "doc_by_uf_whole": _documents(
        "h._id IN (SELECT _id FROM unidades GROUP BY _id HAVING bool_or(uf = 'NATION_9') ORDER BY _id LIMIT 50)"
    ),
    "doc_by_secondary_cnae_whole": _documents(
        "h._id IN (SELECT _id FROM unidades WHERE list_contains(secundarias, 25000))"
    ),
    "doc_by_index_stored": _documents(
        """h._id IN (SELECT _id FROM unidades WHERE uf = 'NATION_9'
                     AND (cnae_fiscal_principal = 25000 OR list_contains(secundarias, 25000)))"""
    ),
    "doc_lookup": LOOKUP,
    "doc_lookup_stored": LOOKUP,
    "doc_requested": _documents("h._id IN (SELECT user_id FROM events WHERE event_type <> 'error')"),
    "doc_by_uf_cnae": """
        SELECT _id FROM unidades GROUP BY _id
        HAVING bool_or(uf = 'NATION_9') AND bool_or(cnae_fiscal_principal = 25000) ORDER BY _id LIMIT 50""",
    "doc_by_uf": """
        SELECT _id FROM unidades GROUP BY _id HAVING bool_or(uf = 'NATION_9') ORDER BY _id LIMIT 50""",
    "doc_by_uf_cnae_same_unit": """
        SELECT DISTINCT _id FROM unidades WHERE uf = 'NATION_9' AND cnae_fiscal_principal = 25000
        ORDER BY _id LIMIT 50""",
    "doc_count_by_uf": "SELECT uf, count(*) AS total FROM unidades GROUP BY uf",
    "doc_stats": """SELECT count(DISTINCT _id) AS total_documentos, 'documentos' AS nome, 'cadastro' AS banco
                    FROM cabecalhos""",
    "doc_by_secondary_cnae": "SELECT DISTINCT _id FROM unidades WHERE list_contains(secundarias, 25000)",
    "doc_by_index": """
        SELECT DISTINCT _id FROM unidades
        WHERE uf = 'NATION_9' AND (cnae_fiscal_principal = 25000 OR list_contains(secundarias, 25000))""",
    "doc_activity_index": """
        SELECT DISTINCT uf, cnae_fiscal_principal AS cnae, TRUE AS principal, _id FROM unidades
        UNION ALL SELECT DISTINCT uf, cnae, FALSE, _id FROM (SELECT uf, unnest(secundarias) AS cnae, _id FROM unidades)""",
    "doc_by_index_merged": _documents(
        """h._id IN (SELECT _id FROM unidades WHERE uf = 'NATION_9'
                     AND (cnae_fiscal_principal = 25000 OR list_contains(secundarias, 25000)))"""
    ),
    "doc_store_generations": """
        SELECT 0 AS generation, _id, count(*) AS unidades FROM unidades WHERE data_inicio_atividade < 19980000 GROUP BY _id
        UNION ALL SELECT 1, _id, count(*) FROM unidades GROUP BY _id""",
    "doc_index_merged": """
        SELECT DISTINCT uf, cnae_fiscal_principal AS cnae, TRUE AS principal, _id FROM unidades
        UNION ALL SELECT DISTINCT uf, cnae, FALSE, _id FROM (SELECT uf, unnest(secundarias) AS cnae, _id FROM unidades)""",
    "name_search_indexed": """
        SELECT u._id, razao_social, cnpj_ordem, cnpj_dv, nome_fantasia FROM unidades u
        JOIN cabecalhos h ON h._id = u._id
        WHERE contains(upper(razao_social), 'R#00000004') OR contains(upper(nome_fantasia), 'R#00000004')""",
    "name_search_short": """
        SELECT u._id, razao_social, cnpj_ordem, cnpj_dv, nome_fantasia FROM unidades u
        JOIN cabecalhos h ON h._id = u._id
        WHERE contains(upper(razao_social), '5-') OR contains(upper(nome_fantasia), '5-')""",
    "doc_branches_by_uf": "SELECT _id, uf, count(*) AS filiais FROM unidades GROUP BY 1, 2",
    "company_sheet": SHEET,
    "name_search": """
        SELECT u._id, razao_social, cnpj_ordem, cnpj_dv, nome_fantasia FROM unidades u
        JOIN cabecalhos h ON h._id = u._id
        WHERE contains(upper(razao_social), '00042') OR contains(upper(nome_fantasia), '00042')""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(query) for name, query in QUERIES.items()}
