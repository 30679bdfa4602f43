import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetspark.operators import cleaning, standardize
from fleetspark.plans import pipelines
from fleetspark.plans.dashboard import dashboard
from fleetspark.schemas import DIM_VEICULO, STAR_MEASURES
from fleetspark.session import new_work_dir, shared_dir, stored, working_tables
from fleetspark.sources import readers, writers

from .conftest import rows

FLEET_CSV = "ano,estado,tipo_veiculo,combustivel,quantidade\n2024,SP,AUTOMOVEL,N/A,10\n2024,São,ÔNIBUS,Flex,x\n"


def test_csv_with_missing_marker(spark, tmp_path):
    (tmp_path / "denatran_frota_20240101.csv").write_text(FLEET_CSV, encoding="utf-8")
    got = readers.read_feed(spark, "registered_fleet", str(tmp_path)).collect()
    assert [(r.ano, r.estado, r.combustivel, r.quantidade) for r in got] == [(2024, "SP", None, "10"), (2024, "São", "Flex", "x")]


def test_csv_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("quantidade,extra,ano,tipo_veiculo\n5,x,2024.0,A\n6,y,bad,B\n", encoding="utf-8")
    got = readers.read_feed(spark, "registered_fleet", "", str(tmp_path / "a.csv"))
    assert got.columns == ["quantidade", "extra", "ano", "tipo_veiculo"]
    assert [tuple(r) for r in got.collect()] == [("5", "x", 2024, "A"), ("6", "y", None, "B")]


def test_part_files_with_another_header_fail(spark, tmp_path):
    folder = tmp_path / "denatran_frota_20240101"
    folder.mkdir()
    (folder / "part-0.csv").write_text("ano,estado,quantidade\n2024,SP,5\n")
    (folder / "part-1.csv").write_text("estado,quantidade,ano\nRJ,9,2023\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_feed(spark, "registered_fleet", str(tmp_path)).collect()


def test_numbers_are_kept_or_fail(spark, tmp_path):
    """Wide numbers stay, a whole number may come with a point, and what no type holds is an error."""
    line = "V1,Pickup,sp,2024,1,12000.0,20.5,10000.0,100000000000.00,50,20,,30,400,4,1234567.5\n"
    (tmp_path / "frota_operacoes_20240101.csv").write_text(OPERATIONS + line)
    clean = cleaning.clean_operations(readers.read_feed(spark, "operations", str(tmp_path))).first()
    assert (clean.km_rodado, clean.preco_combustivel, clean.custo_combustivel, clean.disponibilidade_pct) == (
        12000, Decimal("10000.00"), Decimal("100000000000.00"), Decimal("1234567.5"))
    for bad in (line.replace("12000.0", "12.7"), line.replace("100000000000.00", "1e30"), line.replace("12000.0", "3e9")):
        (tmp_path / "frota_operacoes_20240101.csv").write_text(OPERATIONS + bad)
        with pytest.raises(Exception, match="number does not fit"):
            cleaning.clean_operations(readers.read_feed(spark, "operations", str(tmp_path))).collect()


def test_latest_snapshot_of_files_and_folders(spark, tmp_path):
    for name in ["feed_20231231.csv", "feed_20240301.csv", "other_20260101.csv", "feed_notes.txt"]:
        (tmp_path / name).write_text("a\n1\n")
    assert readers.latest_snapshot(spark, str(tmp_path), "feed").endswith("feed_20240301.csv")
    spark.range(3).write.parquet(str(tmp_path / "feed_20240601"))
    assert readers.latest_snapshot(spark, str(tmp_path), "feed").endswith("feed_20240601")
    with pytest.raises(FileNotFoundError):
        readers.latest_snapshot(spark, str(tmp_path), "absent")
    with pytest.raises(FileNotFoundError):
        readers.latest_snapshot(spark, str(tmp_path / "nowhere"), "feed")


def test_results_before_the_first_run_are_empty(spark, tmp_path):
    assert readers.read_results(spark, str(tmp_path), "decisoes", "decisao string").count() == 0


def test_staging_needs_both_tables(spark, tmp_path):
    folder = str(tmp_path / "s")
    writers.write_staging({"veiculos_clean": spark.range(2)}, folder, "20240101")
    with pytest.raises(FileNotFoundError):
        readers.read_staging(spark, folder)


PAYLOAD = [{"resultados": [{"classificacoes": [], "series": [
    {"localidade": {"id": "35", "nome": "São Paulo"}, "serie": {"2022": "1.5", "2023": "..."}},
    {"localidade": {"id": "33", "nome": "Rio"}, "serie": {"2022": "abc"}},
]}, {"series": []}]}, {"resultados": []}]


def test_indicator_payload(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(PAYLOAD), encoding="utf-8")
    want = [("33", "Rio", "2022", None), ("35", "São Paulo", "2022", 1.5), ("35", "São Paulo", "2023", None)]
    from_file = readers.flatten_indicator(readers.read_indicator_json(spark, str(tmp_path / "p.json")))
    assert rows(from_file) == want
    text = spark.createDataFrame([(json.dumps(PAYLOAD),)], "t string").select(F.explode(readers.parse_payload("t")).alias("p"))
    by_state = readers.flatten_indicator(text.select("p.*"), by_state=True)
    named = readers.indicator_rows(text.select("p.*"), "pib")
    assert {(r.indicador, r.descricao) for r in named.collect()} == {("pib", "Produto Interno Bruto a precos correntes")}
    assert by_state.columns == ["periodo", "valor", "uf_id", "uf_nome"] and by_state.count() == 3


def test_indicator_lookup(spark):
    assert readers.indicator_config("ipca")["agregado"] == "7060"
    with pytest.raises(ValueError):
        readers.indicator_config("selic")
    df = spark.createDataFrame([("pib",), ("selic",)], "indicador string")
    catalog = readers.indicator_catalog(spark)
    kept = {r.indicador: r.agregado for r in readers.lookup_indicators(df, catalog, fail=False).collect()}
    assert kept == {"pib": "6784", "selic": None}
    with pytest.raises(Exception, match="unknown indicator: selic"):
        readers.lookup_indicators(df, catalog).collect()


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([("IPCA", 1)], "indicador string, valor int")
    b = spark.createDataFrame([("PIB", 2, "SP")], "indicador string, valor int, estado string")
    assert rows(readers.union_indicators([a, b, b.limit(0)])) == [("SP", "PIB", 2), (None, "IPCA", 1)]


def test_results_skip_empty_tables(spark, tmp_path):
    paths = writers.write_results({"a": spark.range(2), "b": spark.range(0)}, str(tmp_path), "20240101", csv=True)
    assert list(paths) == ["a"] and spark.read.csv(paths["a"], header=True).count() == 2


OPERATIONS = (
    "veiculo_id,tipo_veiculo,estado,ano,mes,km_rodado,litros_consumidos,preco_combustivel,custo_combustivel,"
    "custo_manutencao,custo_seguro,custo_ipva,custo_depreciacao,receita_estimada,viagens_realizadas,disponibilidade_pct\n"
)


def test_national_indicators_have_no_state(spark, tmp_path):
    (tmp_path / "ibge_indicadores_20250101.csv").write_text("indicador,descricao,periodo,valor\nipca,d,2024,4.62\n")
    rows_ = cleaning.clean_indicators(readers.read_feed(spark, "indicators", str(tmp_path)))
    wide = standardize.indicators_wide(rows_)
    assert wide.columns == ["periodo", "IPCA"] and wide.count() == 1


def test_whole_pipeline_from_files(spark, tmp_path):
    """Raw files to results: one row per operation, also for months 1 to 9 and years without prices."""
    raw = tmp_path / "raw"
    raw.mkdir()

    def put(prefix, text):
        (raw / f"{prefix}_20250101.csv").write_text(text, encoding="utf-8")

    header = "Regiao - Sigla,Estado - Sigla,Municipio,Produto,Data da Coleta,Valor de Venda,Valor de Compra,Bandeira,Unidade de Medida\n"
    put("anp_combustivel", header + "SUDESTE,SP,S,DIESEL,01/01/2024,6.00,5,B,R$/l\nSUDESTE,SP,S,DIESEL,09/01/2024,7.00,5,B,R$/l\n")
    put("ibge_indicadores", "indicador,descricao,periodo,valor,estado\nIPCA,d,2024,4.62,SP\n")
    put("denatran_frota", "ano,estado,tipo_veiculo,combustivel,quantidade\n2024,SP,CAMINHAO,Diesel,7\n2024,SP,MOTOCICLETA,N/A,3\n")
    put("frota_veiculos", "veiculo_id,tipo_veiculo,marca,ano_fabricacao,estado,combustivel,consumo_medio_km_l,km_atual,status,"
        "capacidade_carga_t\nV1,Caminhao, M ,2020,sp,Diesel,3.5,1000,Ativo,10\nV1,Caminhao,Z,2001,sp,Diesel,3.5,1,Ativo,10\n")
    lines = "".join(
        f"{v},Caminhao,sp,{a},{m},{100 + m},{20 + m}.5,6.0,100,50,20,,30,400,4,90\n"
        for v, a, ms in (("V1", 2024, range(1, 13)), ("V1", 2025, [1]), ("V9", 2024, [1])) for m in ms
    )
    put("frota_operacoes", OPERATIONS + lines + lines.splitlines()[0] + "\n")
    staging, warehouse, results = (str(tmp_path / x) for x in ("staging", "warehouse", "results"))
    paths = pipelines.run_etl(spark, str(raw), staging, "20250102")
    assert set(paths) == {"anp_mensal", "ibge_wide", "denatran_resumo", "veiculos_clean", "frota_enriquecida"}
    enriched = spark.read.parquet(paths["frota_enriquecida"])
    assert enriched.count() == 14  # the copy is gone, the unknown vehicle still here
    first = enriched.filter("ano = 2024 AND mes = 1 AND veiculo_id = 'V1'").first()
    assert (first.marca, float(first.preco_diesel), float(first.IPCA), float(first.frota_total), first.frota_operacional) == (
        "M", 6.5, 4.62, 10.0, 7)
    assert (float(first.custo_total), first.idade_veiculo) == (200.0, 4)
    assert enriched.filter("ano = 2025 AND preco_diesel IS NULL AND IPCA IS NULL").count() == 1

    loaded = pipelines.run_load(spark, staging, warehouse, blocks=4)
    fact = loaded["fato_frota"]
    assert [r.sk_fato_frota for r in fact.orderBy("sk_fato_frota").collect()] == list(range(1, 14))
    assert fact.filter("sk_tempo = 202401").count() == 1
    assert spark.table("vw_resumo_mensal").count() == 13
    assert spark.table("vw_kpi_estado").first().regiao == "SUDESTE"
    limits = spark.read.parquet(f"{warehouse}/ref_limites_kpi")
    assert limits.filter("kpi = 'custo_por_km' AND tipo_alerta = 'CRITICO'").first().valor_limite == Decimal("2.50")

    before = dashboard(spark, loaded, results)
    assert tuple(before["decision_counts"].first()) == (0, 0, 0) and before["tbl1"].count() == 0
    written = pipelines.run_analytics(loaded, results, "20250102")
    assert set(written) == {"forecast_regressao_custo_km", "forecast_media_movel", "forecast_tendencia_tipo",
                            "alertas", "decisoes", "resumo"}
    assert spark.read.parquet(written["forecast_media_movel"]).count() == 6  # a flat series has no ARIMA
    assert spark.read.parquet(written["decisoes"]).count() == 2
    tables = dashboard(spark, loaded, results)
    assert len(tables) == 20 and all(df.columns for df in tables.values())
    assert sum(tables["decision_counts"].first()) == 2 and tables["tbl1"].count() == 2
    assert tables["g15"].groupBy("serie").count().orderBy("serie").collect() == [("Historico", 13), ("Previsao", 6)]
    assert tables["g16"].first().tipo_veiculo == "Caminhao"
    assert "total_linhas=2" in spark.read.text(written["resumo"]).first()[0]


def test_working_tables_go_with_their_run(spark, tmp_path):
    with working_tables(spark) as folder:
        assert stored(spark.range(3), "x").count() == 3
        assert os.path.dirname(new_work_dir(spark, "y")) == folder and os.path.isdir(folder)
    assert not os.path.exists(folder) and os.path.dirname(new_work_dir(spark, "y")) != folder
    with pytest.raises(ZeroDivisionError), working_tables(spark) as folder:
        stored(spark.range(3), "x")
        1 / 0
    assert not os.path.exists(folder)


def test_hashed_vehicles_load_the_same_fact(spark, tmp_path):
    staging = str(tmp_path / "staging")
    ops = spark.createDataFrame([(f"V{i % 5}", "SP", 2024, 1 + i % 12, i) for i in range(40)] + [("V9", "SP", 2024, 1, 7)],
                                "veiculo_id string, estado string, ano int, mes int, km_rodado int")
    ops = ops.select("*", *(F.lit(1).cast(t).alias(c) for c, t in STAR_MEASURES.items() if c != "km_rodado"))
    vehicles = spark.createDataFrame([(f"V{i}",) for i in range(5)], "veiculo_id string")
    vehicles = vehicles.select("*", *(F.lit(1).cast(t).alias(c) for c, t in DIM_VEICULO.items() if c != "id_veiculo"))
    writers.write_staging({"frota_enriquecida": ops, "veiculos_clean": vehicles}, staging, "20250101")
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    facts = {}
    for hashed in (False, True):
        star_ = pipelines.run_load(spark, staging, str(tmp_path / f"w{hashed}"), 4, hashed_vehicles=hashed)
        facts[hashed] = rows(star_["fato_frota"].join(star_["dim_veiculo"], "sk_veiculo").select("id_veiculo", "sk_tempo", "km_rodado"))
    assert facts[True] == facts[False] and len(facts[True]) == 40
    assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) == before  # no working table is left


def test_work_dirs_are_fresh(spark):
    assert new_work_dir(spark, "x") != new_work_dir(spark, "x")
