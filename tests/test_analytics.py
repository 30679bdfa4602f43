"""Edge cases of views, KPIs, diagnostics and rules on hand-checked frames."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fleetspark.catalog import feeds
from fleetspark.operators import diagnostics, kpis, marts, prescriptive, reference_tables, views
from fleetspark.schemas import STAR_MEASURES

from .conftest import rows

SCHEMA = "sk_veiculo long, sk_estado int, sk_tempo int, " + ", ".join(f"{c} {t}" for c, t in STAR_MEASURES.items())
BASE = dict(
    sk_veiculo=1, sk_estado=1, sk_tempo=202401, km_rodado=100, litros_consumidos=D("20"), preco_combustivel=D("5"),
    custo_combustivel=D("100"), custo_manutencao=D("50"), custo_seguro=D("20"), custo_ipva=D("0"),
    custo_depreciacao=D("30"), custo_total=D("200"), receita_estimada=D("400"), viagens_realizadas=4,
    disponibilidade_pct=D("90"), custo_por_km=D("2"), margem_operacional=D("0.5"), km_por_litro_real=D("5"),
    idade_veiculo=3,
)


@pytest.fixture(scope="module")
def dims(spark):
    veiculo = spark.createDataFrame(
        [(1, "V1", "Pickup", "A", 2021, "Diesel", "Ativo", D("8.50")), (2, "V2", "Pickup", "B", 2010, "Flex", "Inativo", D("0")),
         (3, "V3", "Caminhao", "C", 2015, "Diesel", "Ativo", D("4.00"))],
        "sk_veiculo long, id_veiculo string, tipo_veiculo string, marca string, ano_fabricacao int,"
        " combustivel string, status string, consumo_medio_km_l decimal(6,2)",
    )
    estado = spark.createDataFrame([(1, "SP", "SUDESTE"), (2, "AC", "NORTE")], "sk_estado int, sigla_estado string, regiao string")
    return {"v": veiculo, "e": estado}


def fact(spark, *changes):
    names = ["sk_veiculo", "sk_estado", "sk_tempo", *STAR_MEASURES]
    return spark.createDataFrame([tuple({**BASE, **c}[n] for n in names) for c in changes], SCHEMA)


def test_mean_of_ratios_skips_zero_km(spark, dims):
    f = fact(spark, {}, {"km_rodado": 0}, {"km_rodado": 200})
    r = views.vw_kpi_tipo_veiculo(f, dims["v"]).first()
    assert (r.total_veiculos, r.total_km_rodado, r.custo_combustivel_por_km) == (1, 300, D("0.7500"))


def test_means_round_half_away_from_zero(spark, dims):
    f = fact(spark, {"custo_por_km": D("1.0000"), "margem_operacional": D("-0.0001")},
             {"custo_por_km": D("1.0001"), "margem_operacional": D("0.0000")})
    r = views.vw_kpi_estado(f, dims["e"]).first()
    assert (r.custo_medio_por_km, r.margem_media) == (D("1.0001"), D("-0.0001"))


def test_high_cost_is_strict_and_ordered(spark, dims):
    f = fact(spark, {"custo_por_km": D("1.5")}, {"sk_veiculo": 2, "custo_por_km": D("1.5001")},
             {"sk_veiculo": 3, "custo_por_km": D("9")})
    assert [r.id_veiculo for r in views.vw_veiculos_alto_custo(f, dims["v"], dims["e"]).collect()] == ["V3", "V2"]


def test_age_bands_with_missing_and_negative_age(spark):
    ages = [-1, 0, 3, 4, 6, 7, 9, 10, 14, 15, 99, 100, None]
    f = fact(spark, *({"idade_veiculo": a, "sk_veiculo": i} for i, a in enumerate(ages)))
    got = {r.faixa_idade: r.total_veiculos for r in views.vw_eficiencia_idade(f).collect()}
    assert got == {"Nova (0-3)": 3, "Jovem (4-6)": 2, "Madura (7-9)": 2, "Antiga (10-14)": 2, "Obsoleta (15+)": 4}


def test_age_advice_boundaries(spark):
    df = spark.createDataFrame([(a,) for a in [-1, 0, 3, 4, 6, 7, 9, 10, 14, 15, 99, 100, None]], "idade_veiculo int")
    first = [r[0].split(" ")[0] for r in df.select(prescriptive.age_advice()).collect()]
    assert first == ["Verificar", "Manutenção", "Manutenção", "Acompanhar", "Acompanhar", "Planejar", "Planejar",
                     "Avaliar", "Avaliar", "Substituir", "Substituir", "Verificar", "Verificar"]


@pytest.mark.parametrize("kpi, cases", [
    ("custo_por_km", {"1.8": "NORMAL", "1.8001": "ATENCAO", "2.5": "ATENCAO", "2.5001": "CRITICO"}),
    ("margem_operacional", {"0.2": "NORMAL", "0.1999": "ATENCAO", "0.1": "ATENCAO", "0.0999": "CRITICO"}),
    ("disponibilidade_pct", {"85": "NORMAL", "84.9": "ATENCAO", "75": "ATENCAO", "74.9": "CRITICO"}),
    ("km_por_litro_real", {"4.5": "NORMAL", "4.49": "ATENCAO", "3": "ATENCAO", "2.99": "CRITICO"}),
])
def test_limits_are_strict(spark, kpi, cases):
    df = spark.createDataFrame([(D(v),) for v in cases] + [(None,)], "x decimal(18,4)")
    got = [r[0] for r in df.select(prescriptive.kpi_class(kpi, F.col("x"))).collect()]
    assert got == [*cases.values(), "NORMAL"]


def test_unknown_kpi_is_undefined(spark):
    assert spark.range(1).select(prescriptive.kpi_class("outro", F.lit(1))).first()[0] == "INDEFINIDO"


def _kpis(spark, *values):
    data = [(v, "Pickup", "A", "SP", age, *map(D, numbers)) for v, age, numbers in values]
    return spark.createDataFrame(
        data, "id_veiculo string, tipo_veiculo string, marca string, sigla_estado string, idade_veiculo int, "
        + ", ".join(f"{k} decimal(12,4)" for k in prescriptive.KPIS))


def test_decisions_share_the_alerts_of_the_vehicle(spark):
    good, attention, bad = ("1", "0.5", "90", "8"), ("2", "0.5", "80", "8"), ("3", "0.05", "90", "8")
    kpis_ = _kpis(spark, ("V1", 1, good), ("V1", 2, bad), ("V2", 1, attention), ("V3", 1, good))
    got = [(r.veiculo_id, r.idade_veiculo, r.prioridade, r.num_alertas)
           for r in prescriptive.in_priority_order(prescriptive.decisions(kpis_)).collect()]
    assert got == [("V1", 1, 1, 2), ("V1", 2, 1, 2), ("V2", 1, 2, 2), ("V3", 1, 3, 0)]
    total = prescriptive.summary(kpis_).first().asDict()
    assert total == dict(total_linhas=4, total_veiculos=3, intervencao_imediata=2, monitorar_planejar=1,
                         operacao_normal=1, total_alertas=4, alertas_criticos=2, alertas_atencao=2)
    texts = {(r.kpi, r.classificacao): r.acao_recomendada for r in prescriptive.alerts(kpis_).collect()}
    assert texts[("margem_operacional", "CRITICO")].startswith("Rever rota")


def test_summary_of_nothing(spark):
    empty = _kpis(spark, ("V1", 1, ("1", "1", "90", "9"))).filter("false")
    assert set(prescriptive.summary(empty).first()) == {0}


def test_unlisted_class_gets_the_default_action(spark):
    text = spark.range(1).select(prescriptive.recommended_action(F.lit("custo_por_km"), F.lit("NORMAL"))).first()[0]
    assert text == "Manter monitoramento padrão"


def test_price_change_against_the_previous_row(spark, dims):
    f = fact(spark, {"sk_tempo": 202401, "preco_combustivel": D("5")}, {"sk_tempo": 202401, "sk_estado": 2, "preco_combustivel": D("0")},
             {"sk_tempo": 202402, "preco_combustivel": D("6")})
    got = [(r.sigla_estado, r.mes, r.preco_anterior and float(r.preco_anterior), r.variacao_preco_pct and float(r.variacao_preco_pct))
           for r in diagnostics.price_impact(f, dims["v"], dims["e"]).orderBy("mes", "sigla_estado").collect()]
    assert got[0] == ("AC", 1, None, None)
    assert got[1][:2] == ("SP", 1) and got[1][3] is None  # the previous price is 0
    assert got[2] == ("SP", 2, 5.0, 20.0)
    by_state = {(r.sigla_estado, r.mes): r.variacao_preco_pct for r in
                diagnostics.price_impact(f, dims["v"], dims["e"], by_state=True).collect()}
    assert float(by_state[("SP", 2)]) == 20.0 and by_state[("SP", 1)] is None


@pytest.mark.parametrize("costs, cause", [
    (("3", "2", "1"), "COMBUSTIVEL"), (("2", "2", "1"), "MANUTENCAO"), (("2", "1", "2"), "DEPRECIACAO"),
    (("1", "2", "2"), "DEPRECIACAO"), (("1", "3", "2"), "MANUTENCAO"),
])
def test_root_cause_ties(spark, dims, costs, cause):
    fuel, upkeep, wear = map(D, costs)
    f = fact(spark, {"custo_combustivel": fuel, "custo_manutencao": upkeep, "custo_depreciacao": wear})
    r = diagnostics.root_cause(f, dims["v"]).first()
    assert (r.principal_causa, r.faixa_idade, r.num_registros) == (cause, "0-3 anos", 1)


def test_consumption_status(spark, dims):
    real = ["2.79", "2.80", "3.39", "3.40"]
    got = []
    for value in real:
        f = fact(spark, {"sk_veiculo": 3, "km_por_litro_real": D(value)})
        got.append(diagnostics.consumption_anomalies(f, dims["v"], dims["e"]).first().status_consumo)
    assert got == ["ANOMALO", "SUBOTIMO", "SUBOTIMO", "NORMAL"]
    f = fact(spark, {"sk_veiculo": 2})  # expected consumption 0
    assert diagnostics.consumption_anomalies(f, dims["v"], dims["e"]).first().desvio_consumo_pct is None


def test_availability_band(spark, dims):
    f = fact(spark, {"disponibilidade_pct": D("75")}, {"sk_veiculo": 3, "disponibilidade_pct": D("74.9")})
    got = {r.tipo_veiculo: r.faixa for r in marts.availability_by_type(f, dims["v"]).collect()}
    assert got == {"Pickup": "ATENCAO", "Caminhao": "CRITICO"}


def test_revenue_per_vehicle(spark, dims):
    f = fact(spark, {}, {"receita_estimada": D("100")}, {"sk_veiculo": 2, "receita_estimada": D("0.01")})
    r = kpis.kpi_utilizacao(f, dims["e"]).first()
    assert (r.veiculos_ativos, float(r.receita_por_veiculo)) == (2, 250.01)


def test_upsert_replaces_by_both_columns(spark):
    rows_ = reference_tables.reference_rows(spark)
    assert {n: df.count() for n, df in rows_.items()} == {"ref_combustivel": 6, "ref_faixa_idade": 5, "ref_limites_kpi": 8}
    old = rows_["ref_limites_kpi"]
    new = old.filter("kpi = 'custo_por_km' AND tipo_alerta = 'CRITICO'").withColumn("acao_recomendada", F.lit(None).cast("string"))
    got = reference_tables.upsert(old, new, reference_tables.KEYS["ref_limites_kpi"])
    assert got.count() == 8
    assert [r.kpi for r in got.filter("acao_recomendada IS NULL").collect()] == ["custo_por_km"]


def test_totals_agree_over_groupings(spark, sf):
    s = feeds.load_star(spark, sf)
    f = s["fato_frota"]
    overall = f.agg(F.sum("custo_total")).first()[0]
    by_state = views.vw_kpi_estado(f, s["dim_estado"]).agg(F.sum("total_custo")).first()[0]
    by_type = views.vw_kpi_tipo_veiculo(f, s["dim_veiculo"]).agg(F.sum("total_custo")).first()[0]
    by_year = kpis.kpi_composicao_custos(f).agg(F.sum("total_geral")).first()[0]
    assert overall == by_state == by_type == by_year


def test_results_do_not_depend_on_partitions(spark, sf):
    s = feeds.load_star(spark, sf)

    def results(parts):
        f = s["fato_frota"].repartition(parts)
        k = prescriptive.vehicle_kpis(f, s["dim_veiculo"], s["dim_estado"])
        return [rows(df) for df in (views.vw_kpi_tipo_veiculo(f, s["dim_veiculo"]), diagnostics.root_cause(f, s["dim_veiculo"]),
                                    prescriptive.decisions(k), marts.cards(f))]

    one = results(1)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert results(11) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_vehicle_with_most_rows(spark, dims):
    """One vehicle holds nearly all rows: the brute-force answer over plain Python numbers."""
    n = 3000
    f = fact(spark, {}).crossJoin(spark.range(n)).withColumns(
        {"sk_veiculo": F.when(F.col("id") < 2900, 1).otherwise(F.col("id") % 3 + 1),
         "custo_por_km": (F.col("id") % 997 / 100).cast("decimal(12,4)")}
    ).drop("id")
    values = {v: [] for v in (1, 2, 3)}
    for i in range(n):
        values[1 if i < 2900 else i % 3 + 1].append(D(i % 997) / 100)
    got = {r.id_veiculo: r.custo_medio_por_km for r in views.vw_veiculos_alto_custo(f, dims["v"], dims["e"]).collect()}
    want = {f"V{v}": (sum(x) / len(x)).quantize(D("0.0001"), "ROUND_HALF_UP") for v, x in values.items()}
    assert got == {k: x for k, x in want.items() if x > D("1.5")}


def test_wide_sums_are_exact(spark):
    """Signed ratios against plain decimals, and units whose 64-bit sum would overflow."""
    import random

    from fleetspark.functions.columns import Measure, exact_mean, per

    rng = random.Random(3)
    pairs = [(D(rng.randint(-10**9, 10**9)) / 100, rng.choice([0, 1, 2, 5, 8, 1000])) for _ in range(500)]
    df = spark.createDataFrame(pairs, "a decimal(12,2), b int")
    got = df.agg(F.round(exact_mean(per("a", "b")), 6)).first()[0]
    kept = [a / b for a, b in pairs if b]
    assert got == (sum(kept) / len(kept)).quantize(D("0.000001"), "ROUND_HALF_UP")
    big = spark.range(5000).select(F.lit(9 * 10**15).alias("u"))
    assert big.agg(exact_mean(Measure(F.col("u"), 10, wide=True))).first()[0] == D(900000)


def test_sums_are_kept_without_the_overflow_check(spark):
    """With ANSI off a sum past 64 bits is right as a decimal, and fails where a whole number was promised; a cast that
    does not fit fails."""
    from fleetspark.functions import columns
    from fleetspark.operators import star

    big = spark.createDataFrame([(9 * 10**15,)] * 2000, "n long")
    money = columns.Measure(F.col("n"), 2)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert big.agg(columns.total(money).alias("s")).first().s == D(9 * 10**15 * 2000) / 100
        with pytest.raises(Exception, match="does not fit"):
            big.agg(columns.total(columns.Measure(F.col("n"), 0)).alias("s")).collect()
        fact = spark.createDataFrame([(1, 1, 202401, 2**40)], "sk_veiculo long, sk_estado int, sk_tempo int, km_rodado long")
        with pytest.raises(Exception, match="does not fit"):
            star.project_fact(fact).collect()
        narrow = spark.createDataFrame([(1,), (2,), (None,)], "km_rodado int")
        assert narrow.agg(columns.total("km_rodado").alias("s")).first().s == 3
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    with pytest.raises(Exception, match="OVERFLOW"):
        big.agg(columns.total(money).alias("s")).collect()
