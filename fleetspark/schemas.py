"""Declared schemas of the feeds and star tables; nothing is inferred from data."""

from __future__ import annotations

from . import reference_data as ref

# Feeds arrive as text where cleaning has to see bad values.
PRICES_RAW = ", ".join(f"`{h}` string" for h in ref.PRICE_HEADERS)
INDICATORS_RAW = "indicador string, descricao string, periodo string, valor string, estado string"
FLEET_RAW = "ano int, estado string, tipo_veiculo string, combustivel string, quantidade string"
VEHICLES_RAW = (
    "veiculo_id string, tipo_veiculo string, marca string, ano_fabricacao int, estado string,"
    " combustivel string, consumo_medio_km_l string, km_atual string, status string,"
    " capacidade_carga_t decimal(18,1)"
)
OPERATIONS_RAW = (
    "veiculo_id string, tipo_veiculo string, estado string, ano int, mes int, km_rodado int,"
    " litros_consumidos decimal(18,2), preco_combustivel decimal(18,2), custo_combustivel string,"
    " custo_manutencao string, custo_seguro string, custo_ipva string, custo_depreciacao string,"
    " receita_estimada string, viagens_realizadas int, disponibilidade_pct decimal(18,1)"
)

# One element of the indicator service's answer; a file holds a list of them.
INDICATOR_PAYLOAD = (
    "resultados array<struct<classificacoes: array<string>, series: array<struct<"
    "localidade: struct<id: string, nome: string>, serie: map<string, string>>>>>"
)

STAR_MEASURES = {
    "km_rodado": "int",
    "litros_consumidos": "decimal(12,2)",
    "preco_combustivel": "decimal(6,2)",
    "custo_combustivel": "decimal(12,2)",
    "custo_manutencao": "decimal(12,2)",
    "custo_seguro": "decimal(10,2)",
    "custo_ipva": "decimal(10,2)",
    "custo_depreciacao": "decimal(10,2)",
    "custo_total": "decimal(12,2)",
    "receita_estimada": "decimal(12,2)",
    "viagens_realizadas": "int",
    "disponibilidade_pct": "decimal(5,1)",
    # wider than the published DDL, whose (8,4) and (5,4) overflow on valid input
    "custo_por_km": "decimal(12,4)",
    "margem_operacional": "decimal(9,4)",
    "km_por_litro_real": "decimal(6,2)",
    "idade_veiculo": "int",
}

DIM_VEICULO = {
    "id_veiculo": "string",
    "tipo_veiculo": "string",
    "marca": "string",
    "ano_fabricacao": "int",
    "combustivel": "string",
    "km_atual": "int",
    "status": "string",
    "consumo_medio_km_l": "decimal(6,2)",
    "capacidade_carga_t": "decimal(6,1)",
}

# Decimals of each measure (0 for whole numbers).
STAR_DIGITS = {
    c: int(t.removesuffix(")").split(",")[1]) if t.startswith("decimal") else 0
    for c, t in STAR_MEASURES.items()
}
