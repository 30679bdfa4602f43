from decimal import Decimal

from fleetspark.operators import enrich, standardize

from .conftest import rows

PRICES = "estado string, ano int, mes int, produto string, valor_venda decimal(12,4)"


def test_monthly_price_rounds_half_to_even(spark):
    values = ["1.00", "1.01", "2.01", "2.02"]
    df = spark.createDataFrame(
        [("SP", 2024, 1, "GNV", Decimal(v)) for v in values[:2]]
        + [("SP", 2024, 2, "GNV", Decimal(v)) for v in values[2:]]
        + [(None, 2024, 1, "GNV", Decimal("9")), ("SP", None, 1, "GNV", Decimal("9"))],
        PRICES,
    )
    got = [(r.mes, float(r.preco_medio), r.num_registros) for r in standardize.monthly_prices(df).orderBy("mes").collect()]
    assert got == [(1, 1.0, 2), (2, 2.02, 2)]  # 1.005 -> 1.00, 2.015 -> 2.02


def test_price_columns(spark):
    df = spark.createDataFrame(
        [("SP", 2024, 1, "DIESEL S10", Decimal("6")), ("SP", 2024, 1, "GASOLINA ADITIVADA", Decimal("7"))], PRICES
    )
    wide = standardize.prices_wide(standardize.monthly_prices(df))
    assert set(wide.columns) == {"estado", "ano", "mes", "preco_diesel_s_s10", "preco_gasolina_aditivada"}
    assert wide.count() == 1


def test_indicators_national_and_by_state(spark):
    df = spark.createDataFrame(
        [("SP", "2023", "IPCA", 4.0), ("RJ", "2023", "IPCA", 6.0), (None, "2023", "IPCA", 9.0)],
        "estado string, periodo string, indicador string, valor double",
    ).withColumn("valor", __import__("pyspark").sql.functions.col("valor").cast("decimal(24,6)"))
    assert [(r.estado, r.ano, float(r.IPCA)) for r in standardize.indicators_wide(df).orderBy("estado").collect()] == [
        ("RJ", "2023", 6.0), ("SP", "2023", 4.0)]
    national = standardize.indicators_wide(df.drop("estado")).collect()
    assert [(r.periodo, round(float(r.IPCA), 6)) for r in national] == [("2023", 6.333333)]


def test_fleet_summary_without_operational_types(spark):
    df = spark.createDataFrame(
        [("SP", 2024, "CAMINHAO", Decimal(10)), ("SP", 2024, "MOTOCICLETA", Decimal(5)),
         ("AC", 2024, "MOTOCICLETA", Decimal(3))],
        "estado string, ano int, tipo_veiculo string, quantidade decimal(18,2)",
    )
    got = {r.estado: (float(r.frota_total), r.num_tipos, r.frota_operacional)
           for r in standardize.fleet_summary(df).collect()}
    assert got == {"SP": (15.0, 2, 10), "AC": (3.0, 1, 0)}


def test_derived_kpis_at_zero(spark):
    schema = (
        "ano int, ano_fabricacao int, km_rodado int, litros_consumidos decimal(12,2), custo_combustivel decimal(12,2),"
        " custo_manutencao decimal(12,2), custo_seguro decimal(12,2), custo_ipva decimal(12,2),"
        " custo_depreciacao decimal(12,2), receita_estimada decimal(12,2)"
    )
    d = Decimal
    df = spark.createDataFrame(
        [(2024, 2020, 100, d(20), d(50), d(30), d(10), d(5), d(5), d(200)),
         (2024, None, 0, d(0), d(1), d(0), d(0), d(0), d(0), d(0)),
         (2024, 2024, None, None, d(1), d(0), d(0), d(0), d(0), None)],
        schema,
    )
    got = enrich.derive_kpis(df).collect()
    assert [float(got[0][c]) for c in ("custo_total", "custo_por_km", "margem_operacional", "km_por_litro_real")] == [
        100.0, 1.0, 0.5, 5.0]
    for r in got[1:]:
        assert (float(r.custo_por_km), float(r.margem_operacional), float(r.km_por_litro_real)) == (0, 0, 0)
    assert [r.idade_veiculo for r in got] == [4, None, 0]


def test_monthly_periods_do_not_multiply_operations(spark):
    ops = spark.createDataFrame([("SP", 2020, 1), ("SP", 2021, 1)], "estado string, ano int, mes int")
    wide = spark.createDataFrame(
        [("SP", "202001", Decimal(2)), ("SP", "202002", Decimal(4))], "estado string, ano string, IPCA decimal(24,6)"
    )
    got = [(r.ano, None if r.IPCA is None else float(r.IPCA)) for r in enrich.add_indicators(ops, wide).orderBy("ano").collect()]
    assert got == [(2020, 3.0), (2021, None)]
    assert enrich.add_indicators(ops, wide.drop("estado")) is ops


def test_unknown_vehicle_stays(spark):
    ops = spark.createDataFrame([("V1", 1), ("V9", 2)], "veiculo_id string, x int")
    vehicles = spark.createDataFrame([("V1", "A")], "veiculo_id string, marca string")
    assert rows(enrich.add_vehicle(ops, vehicles)) == [("A", "V1", 1), (None, "V9", 2)]
