"""Declared schemas and code labels of the registry."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

U8, U16, U32, TEXT = ShortType(), IntegerType(), LongType(), StringType()

# Largest value each unsigned width of the registry layout may hold.
UNSIGNED_MAX: dict[DataType, int] = {U8: 255, U16: 65_535, U32: 4_294_967_295}


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


# Column names, order and widths of the published registry files.
COMPANIES = _schema(
    cnpj_basico=U32,
    razao_social=TEXT,
    natureza_juridica=U16,
    qualificacao_responsavel=U8,
    capital_social=TEXT,
    porte_empresa=U8,
    ente_federativo_responsavel=TEXT,
)
ESTABLISHMENTS = _schema(
    cnpj_basico=U32,
    cnpj_ordem=U16,
    cnpj_dv=U8,
    identificador_matriz_filial=U8,
    nome_fantasia=TEXT,
    situacao_cadastral=U8,
    data_situacao_cadastral=U32,
    motivo_situacao_cadastral=U8,
    nome_cidade_exterior=TEXT,
    pais=U16,
    data_inicio_atividade=U32,
    cnae_fiscal_principal=U32,
    cnae_fiscal_secundaria=TEXT,
    tipo_logradouro=TEXT,
    logradouro=TEXT,
    numero=TEXT,
    complemento=TEXT,
    bairro=TEXT,
    cep=U32,
    uf=TEXT,
    municipio=U32,
    ddd_1=U16,
    telefone_1=TEXT,
    ddd_2=U16,
    telefone_2=TEXT,
    ddd_fax=U16,
    fax=TEXT,
    correio_eletronico=TEXT,
    situacao_especial=TEXT,
    data_situacao_especial=U32,
)
TAX_REGIME = _schema(
    cnpj_basico=U32,
    opcao_pelo_simples=TEXT,
    data_opcao_simples=U32,
    data_exclusao_simples=U32,
    opcao_pelo_mei=TEXT,
    data_opcao_mei=U32,
    data_exclusao_mei=U32,
)
PARTNERS = _schema(
    cnpj_basico=U32,
    identificador_socio=U8,
    nome_socio_razao_social=TEXT,
    cnpj_cpf_socio=TEXT,
    qualificacao_socio=U8,
    data_entrada_sociedade=U32,
    pais=U16,
    representante_legal=TEXT,
    nome_representante=TEXT,
    qualificacao_representante_legal=U8,
    faixa_etaria=U8,
)
DOMAIN = _schema(codigo=U32, descricao=TEXT)

# Source folder -> (silver table, schema).
SILVER_TABLES = {
    "Empresas": ("empresas", COMPANIES),
    "Estabelecimentos": ("estabelecimentos", ESTABLISHMENTS),
    "Simples": ("simples", TAX_REGIME),
    "Socios": ("socios", PARTNERS),
}
# Source folder -> dimension table.
DOMAIN_TABLES = {
    "Naturezas": "dim_naturezas_juridicas",
    "Qualificacoes": "dim_qualificacoes_socios",
    "Motivos": "dim_motivos_situacao",
    "Municipios": "dim_municipios",
    "Paises": "dim_paises",
    "Cnaes": "dim_cnaes",
}

# The company and partner columns the fact table carries.
COMPANY_COLUMNS = ["natureza_juridica", "qualificacao_responsavel", "porte_empresa", "capital_social"]
PARTNER_COLUMNS = [
    "identificador_socio",
    "nome_socio_razao_social",
    "cnpj_cpf_socio",
    "qualificacao_socio",
    "data_entrada_sociedade",
]
FACT = StructType(
    list(ESTABLISHMENTS.fields)
    + [StructField(n, DoubleType() if n == "capital_social" else COMPANIES[n].dataType) for n in COMPANY_COLUMNS]
    + [PARTNERS[n] for n in PARTNER_COLUMNS]
)

# Code labels that have no dimension table, and the fallback texts.
STATUS_LABELS = {1: "Nula", 2: "Ativa", 3: "Suspensa", 4: "Inapta", 8: "Baixada"}
SIZE_LABELS = {0: "Não Informado", 1: "Micro Empresa", 3: "Empresa de Pequeno Porte", 5: "Demais"}
UNIT_LABELS = {1: "Matriz", 2: "Filial"}
PARTNER_LABELS = {1: "Pessoa Jurídica", 2: "Pessoa Física", 3: "Estrangeiro"}
UNKNOWN = "Desconhecido"
NO_DESCRIPTION = "Sem descrição"
NOT_INFORMED = "Não informado"
STATUS_ACTIVE, STATUS_CLOSED = 2, 8
FIRST_YEAR, LAST_YEAR = 2009, 2025
