"""Explicit schemas of the landed files and tables."""

from __future__ import annotations


def ddl(**fields: str) -> str:
    """DDL text of a schema; usable before a session exists."""
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


# Folder of rows without a UF: a partition column cannot hold the empty text.
NO_UF = "-"
# Fields read from one registry record.
REGISTRY_JSON = ddl(
    CodEmpreendimento="string",
    SigUF="string",
    DscFonteGeracao="string",
    MdaPotenciaInstaladaKW="string",
    SigModalidadeEmpreendimento="string",
)
REGISTRY_DETAIL_JSON = ddl(
    NomMunicipio="string",
    SigAgente="string",
    DatConexao="string",
    NomTitularEmpreendimento="string",
    DscClasseProducao="string",
    DscSubGrupo="string",
    QtdUcRecebeCredito="string",
    DscTipoUnidadeProdutora="string",
)
RAW = ddl(
    row_id="bigint",
    source_resource_id="string",
    ingested_at="timestamp_ntz",
    raw_json="string",
    hash="string",
)
# Log of the loads of a table.
LOADS = ddl(
    carga="string",
    recurso="string",
    ingested_at="timestamp_ntz",
    tentados="bigint",
    inseridos="bigint",
    ultimo_id="bigint",
)
PLANT_RECORD = ddl(
    CodCEG="string",
    NomEmpreendimento="string",
    SigUFPrincipal="string",
    SigTipoGeracao="string",
    DscFaseUsina="string",
    DscFonteCombustivel="string",
    MdaPotenciaOutorgadaKw="string",
    MdaPotenciaFiscalizadaKw="string",
    MdaGarantiaFisicaKw="string",
    NumCoordNEmpreendimento="string",
    NumCoordEEmpreendimento="string",
    DatEntradaOperacao="string",
    DscPropriRegimePariticipacao="string",
    DscMuninicpios="string",
)
LOAD_RECORD = ddl(
    cod_areacarga="string",
    din_referenciautc="string",
    din_referencia="string",
    dat_referencia="string",
    val_cargaglobal="string",
    val_cargammgd="string",
    val_carga="string",
    valor="string",
)
DISPATCH_FILE = ddl(
    din_programacaodia="date",
    num_patamar="int",
    cod_subsistema="string",
    val_demanda="double",
    val_ger_hidraulica="double",
    val_ger_pch="double",
    val_ger_termica="double",
    val_ger_pct="double",
    val_ger_eolica="double",
    val_ger_fotovoltaica="double",
    val_ger_mmgd="double",
    val_cons_elevatoria="double",
)
CATALOGUE = ddl(
    success="boolean",
    result="struct<metadata_modified:string,"
    "resources:array<struct<id:string,name:string,format:string,url:string>>>",
)
STORED_LOAD = ddl(
    id="bigint",
    tipo="string",
    area="string",
    created_at="timestamp_ntz",
    data_json="string",
    ts="timestamp_ntz",
    carga_global="double",
    val="double",
    dia="date",
)
# Dispatch lies in folders by month: a day has a few rows.
STORED_DISPATCH = DISPATCH_FILE + ", " + ddl(hash="string", fonte_arquivo="string", mes="string")
GROWTH_LOG = ddl(
    mmgd_ativos="bigint",
    mmgd_potencia_kw="double",
    siga_ativos="bigint",
    siga_potencia_kw="double",
    ons_carga_media_mw="double",
    total_registros="bigint",
    data="date",
)
FINDING = ddl(
    tipo="string",
    chave="string",
    valor_local="string",
    valor_oficial="string",
    delta_pct="double",
    severidade="string",
)
SUMMARY = ddl(
    total_divergencias="bigint",
    criticos="bigint",
    atencoes="bigint",
    falhou="int",
    registros_mmgd_raw="bigint",
    registros_mmgd_fato="bigint",
    registros_ons_carga="bigint",
    registros_dessem_detalhe="bigint",
    registros_siga_fato="bigint",
    timestamp="string",
)
MEASUREMENT_JSON = ddl(
    cliente_id="bigint",
    timestamp="string",
    data_hora="string",
    geracao_kw="double",
    power_kw="double",
    consumo_kw="double",
    load_kw="double",
    bateria_soc="double",
    bateria_potencia_kw="double",
    dispositivo="string",
    extra="string",
)
VENDOR_JSON = ddl(station_id="bigint", time="string", power="double", load_power="double")
SALE = ddl(
    credito_id="bigint",
    seq="int",
    tie="bigint",
    tie2="bigint",
    quantidade_kwh="double",
    valor_rs="double",
    valor_token="double",
    tx_blockchain="string",
    data_transacao="timestamp_ntz",
)
