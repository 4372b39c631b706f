"""Fixed values of the wind domain: column names, types, contract, codes and texts."""

from __future__ import annotations

from gustledger.operators.contract import Rule

# Registry of assets.
REGISTRY_SCHEMA = "projeto string, spe string, ceg string"

# Key of the registry inside the plant code.
PLANT_KEY = r"\d{6}-\d"

# Operating mode in which an asset is matched by the name of its group.
GROUP_MODE = "Tipo II-C"

WIND_RANGE = (0, 40)
INTERVAL_HOURS = 0.5

DETAIL_TYPES = {
    "id_subsistema": "string",
    "id_estado": "string",
    "nom_estado": "string",
    "nom_modalidadeoperacao": "string",
    "nom_conjuntousina": "string",
    "nom_usina": "string",
    "id_ons": "string",
    "ceg": "string",
    "din_instante": "timestamp_ntz",
    "val_ventoverificado": "double",
    "flg_dadoventoinvalido": "double",
    "val_geracaoestimada": "double",
    "val_geracaoverificada": "double",
}

GROUP_TYPES = {
    "id_subsistema": "string",
    "nom_subsistema": "string",
    "id_estado": "string",
    "nom_usina": "string",
    "id_ons": "string",
    "ceg": "string",
    "din_instante": "timestamp_ntz",
    "val_geracao": "double",
    "cod_razaorestricao": "string",
    "cod_origemrestricao": "string",
    "dsc_restricao": "string",
    "val_geracaolimitada": "double",
    "val_disponibilidade": "double",
    "val_geracaoreferencia": "double",
    "val_geracaoreferenciafinal": "double",
}

CONTRACT = [
    Rule("id_subsistema"),
    Rule("nom_subsistema"),
    Rule("id_estado"),
    Rule("nom_estado"),
    Rule("id_ons_spe"),
    Rule("id_ons_conjunto"),
    Rule("ceg"),
    Rule("din_instante"),
    Rule("val_geracao_conjunto", ge=0),
    Rule("val_ventoverificado", nullable=True, in_range=WIND_RANGE),
    Rule("flg_alerta_limitada", isin=(0, 1)),
    Rule("val_geracaolimitada_conjunto", nullable=True, ge=0),
    Rule("val_disponibilidade_conjunto", nullable=True, ge=0),
    Rule("val_geracaoreferencia_conjunto", nullable=True, ge=0),
    Rule("val_geracaoreferenciafinal_conjunto", nullable=True, ge=0),
    Rule("val_geracaoestimada", nullable=True, ge=0),
    Rule("val_geracaoverificada", nullable=True, ge=0),
    Rule("flg_dadoventoinvalido", nullable=True, isin=(0, 1)),
]

SILVER_KEY = ["nome_spe_cv", "din_instante"]

# Folder column of Silver and of the facts, ``YYYY_MM``.
MONTH = "mes_ref"

METRICS = [
    "val_ventoverificado",
    "val_geracaoestimada",
    "val_geracaoverificada",
    "val_geracao_conjunto",
    "val_geracaolimitada_conjunto",
    "val_geracaoreferencia_conjunto",
    "val_geracaoreferenciafinal_conjunto",
    "val_disponibilidade_conjunto",
]

REASON, STAGE = "motivo_rejeicao", "etapa_rejeicao"
CONFLICT_STAGE, CONTRACT_STAGE = "deduplicacao", "pandera_schema"
CONFLICT_REASON = "Duplicata conflitante: mesma chave (spe, din_instante) com valores divergentes"

WIND_NULLED = "Vento anulado (inválido, fora de 0–40 m/s ou flag de telemetria ativa)"
GENERATION_NULLED = "Geração do conjunto anulada (valor negativo)"
LIMIT_ABOVE = "Geração limitada excede a geração de referência"

# Restriction codes: reason, origin, description.
RESTRICTIONS_SCHEMA = "cod_razaorestricao string, cod_origemrestricao string, dsc_restricao_completa string"
RESTRICTIONS = [
    ("REL", "LOC", "Indisponibilidade externa elétrica local"),
    ("REL", "SIS", "Indisponibilidade externa elétrica sistêmica"),
    ("CNF", "LOC", "Atendimento a requisitos de confiabilidade local"),
    ("CNF", "SIS", "Atendimento a requisitos de confiabilidade sistêmica"),
    ("ENE", "LOC", "Razão energética local"),
    ("ENE", "SIS", "Razão energética sistêmica"),
    ("PAR", "LOC", "Restrição indicada no parecer de acesso local"),
    ("PAR", "SIS", "Restrição indicada no parecer de acesso sistêmica"),
]

# Gold tables and their keys; the code table has none.
GOLD_KEYS = {
    "dim_spe": ["spe"],
    "dim_conjunto": ["id_ons_conjunto"],
    "dim_restricao": [],
    "dim_tempo": ["din_instante"],
    "fato_geracao_spe": ["spe", "din_instante"],
    "fato_geracao_conjunto": ["id_ons_conjunto", "din_instante"],
}
