"""Wall time per registered query at one scale factor; prints one JSON line.

Every query is written to the ``noop`` sink, so all rows and columns are computed and none are
collected. One untimed query warms the session up, and the raw feeds that the two pipelines start from
are written before their time is taken.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetspark.catalog.queries import QUERIES, prepare  # noqa: E402
from fleetspark.session import build_session  # noqa: E402

HEADLINE = [
    "vw_resumo_mensal", "vw_kpi_estado", "vw_kpi_tipo_veiculo", "vw_veiculos_alto_custo",
    "vw_impacto_combustivel", "vw_eficiencia_idade", "vw_ranking_margem",
    "kpi_custo_por_km", "kpi_consumo_medio", "kpi_utilizacao", "kpi_composicao_custos", "kpi_rentabilidade",
    "diag_impacto_preco", "diag_ineficiencia", "diag_causa_raiz", "diag_idade_manutencao",
    "diag_anomalia_consumo",
    "clean_anp", "clean_ibge", "clean_denatran", "clean_fleet", "clean_fleet_operacoes", "clean_dedup_key",
    "std_price_monthly", "std_price_pivot", "std_indicator_wide", "std_fleet_summary",
    "enrich_vehicle", "enrich_price", "enrich_indicators", "enrich_registered_fleet", "enrich_pipeline",
    "dim_tempo", "dim_estado", "dim_veiculo", "dim_veiculo_hash", "fact_key_lookup", "fact_surrogate_key", "fact_project_cast",
    "src_star_wide", "star_pipeline", "dq_constraints",
    "pred_monthly_series", "pred_linreg_fit", "pred_linreg_forecast", "pred_arima", "pred_moving_average",
    "pred_trend_by_type", "pred_series_forecast",
    "presc_vehicle_kpis", "presc_classify", "presc_alerts", "presc_decisions", "presc_resumo",
    "dash_cards", "dash_g1", "dash_g4", "dash_g13", "dash_g15",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    chosen = list(QUERIES) if chosen == ["all"] else chosen
    spark = build_session(
        f"local[{cpus}]", "bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("vw_kpi_estado")
    if {"enrich_pipeline", "star_pipeline"} & set(chosen):
        prepare(spark, sf)
    seconds = {name: round(run(name), 3) for name in chosen}
    print(json.dumps({
        "metric": "fleet_queries_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
