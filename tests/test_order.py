"""Ordered results: rows come in the order that the views and tables promise."""

import pytest

from fleetspark.catalog.queries import QUERIES

# query -> columns, a minus for descending; values are rounded, so later columns break ties of the first only
# where they are exact
ORDERS = {
    "vw_veiculos_alto_custo": ["-custo_medio_por_km"],
    "vw_eficiencia_idade": ["-custo_medio_por_km", "faixa_idade"],
    "vw_ranking_margem": ["margem_media", "id_veiculo", "sigla_estado"],
    "kpi_rentabilidade": ["-margem_pct", "tipo_veiculo"],
    "diag_ineficiencia": ["-custo_por_km"],
    "diag_causa_raiz": ["tipo_veiculo", "faixa_idade", "idade_veiculo"],
    "diag_idade_manutencao": ["idade_veiculo"],
    "diag_anomalia_consumo": ["-desvio_consumo_pct", "sigla_estado", "tipo_veiculo"],
    "dash_g3": ["custo_km", "regiao"],
}


class Down:
    """Turns the order of a value around."""

    def __init__(self, value):
        self.value = value

    def __lt__(self, other):
        return other.value < self.value

    def __eq__(self, other):
        return self.value == other.value


@pytest.mark.parametrize("name", ORDERS)
def test_rows_are_in_order(spark, sf, name):
    rows = QUERIES[name](spark, sf).collect()
    keys = [tuple(Down(r[c[1:]]) if c[0] == "-" else r[c] for c in ORDERS[name]) for r in rows]
    assert len(keys) > 1 and keys == sorted(keys)
    assert all(r[c.lstrip("-")] is not None for r in rows for c in ORDERS[name])
