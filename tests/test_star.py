from decimal import Decimal

from pyspark.sql import functions as F

from fleetspark.functions.keys import dense_number
from fleetspark.operators import star
from fleetspark.sources import quality

from .conftest import rows


def test_dim_tempo_is_the_cross_product_of_years_and_months(spark):
    ops = spark.createDataFrame([(2024, 1), (2024, 12), (2025, 2)], "ano int, mes int")
    got = star.dim_tempo(ops).orderBy("sk_tempo").collect()
    assert [r.sk_tempo for r in got] == [202401, 202402, 202412, 202501, 202502, 202512]
    last = got[-1]
    assert (last.trimestre, last.semestre, last.nome_mes) == (4, 2, "Dez")
    wide = star.add_months(spark.createDataFrame([(225003,), (189912,)], "sk_tempo int"), "ano", "mes", "nome_mes")
    assert rows(wide) == [(1899, 12, "Dez", 189912), (2250, 3, "Mar", 225003)]


def test_dim_estado_regions(spark):
    ops = spark.createDataFrame([("SP",), ("AC",), ("SP",), ("XX",), (None,)], "estado string")
    got = [tuple(r) for r in star.dim_estado(ops).orderBy("sk_estado").collect()]
    assert got == [(1, "AC", "NORTE"), (2, "SP", "SUDESTE"), (3, "XX", "DESCONHECIDO")]


def _enriched(spark, months):
    data = [("V1", "SP", 2024, m, 10 * m) for m in months] + [("V9", "SP", 2024, 1, 1), (None, "SP", 2024, 1, 1)]
    return spark.createDataFrame(data, "veiculo_id string, estado string, ano int, mes int, km_rodado int")


def test_every_month_finds_its_key(spark):
    enriched = _enriched(spark, [1, 1, 9, 10, 12])
    veiculo = spark.createDataFrame([(7, "V1")], "sk_veiculo long, id_veiculo string")
    fact = star.fato_frota(enriched, star.dim_tempo(enriched), star.dim_estado(enriched), veiculo, blocks=4)
    got = fact.orderBy("sk_fato_frota").collect()
    assert [r.sk_fato_frota for r in got] == [1, 2, 3, 4, 5]
    assert [r.sk_tempo for r in got] == [202401, 202401, 202409, 202410, 202412]


def test_fact_types_hold_wide_margins(spark):
    df = spark.createDataFrame(
        [(1, 1, 202401, Decimal("-10.93456"), Decimal("1.00005"))],
        "sk_veiculo long, sk_estado int, sk_tempo int, margem_operacional decimal(18,10), custo_por_km decimal(18,10)",
    )
    r = star.project_fact(df).first()
    assert (r.margem_operacional, r.custo_por_km) == (Decimal("-10.9346"), Decimal("1.0001"))


def test_dense_numbers_with_a_hot_block_and_missing_values(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(None)).when(F.col("id") < 2500, 5).otherwise(F.col("id") % 7).cast("int").alias("b"),
        F.col("id").alias("x"),
    )
    numbered = dense_number(df, "n", ["x"], F.col("b"), blocks=8)
    got = numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n"), F.count("*")).first()
    assert tuple(got) == (1, 3000, 3000, 3000)
    again = dense_number(df.repartition(13), "n", ["x"], F.col("b"), blocks=8)
    assert rows(numbered) == rows(again)


def test_dim_veiculo_keeps_present_columns(spark):
    vehicles = spark.createDataFrame([("V2", "A"), ("V1", "B"), ("V3", "C")], "veiculo_id string, marca string")
    dim = star.dim_veiculo(vehicles, blocks=1)
    assert dim.columns == ["sk_veiculo", "id_veiculo", "marca"]
    assert rows(dim) == [("V1", "B", 1), ("V2", "A", 2), ("V3", "C", 3)]


def test_constraint_report(spark):
    tables = {
        "dim_estado": spark.createDataFrame(
            [(1, "SP", "SUDESTE"), (1, "RJ", None), (2, "AC", "NORTE")], "sk_estado int, sigla_estado string, regiao string"),
        "fato_frota": spark.createDataFrame(
            [(1, 5, 1, 202401, 3), (2, 5, 9, 202401, None), (2, 5, None, 202401, 1)],
            "sk_fato_frota long, sk_veiculo long, sk_estado int, sk_tempo int, km_rodado int"),
    }
    got = {(r.tabela, r.verificacao): r.violacoes for r in quality.constraint_report(tables).collect()}
    assert {k: v for k, v in got.items() if v} == {
        ("dim_estado", "pk sk_estado"): 1, ("dim_estado", "not null regiao"): 1,
        ("fato_frota", "pk sk_fato_frota"): 1, ("fato_frota", "not null km_rodado"): 1,
        ("fato_frota", "not null sk_estado"): 1, ("fato_frota", "fk sk_estado"): 1,
    }


def test_repeated_keys_are_counted_in_the_words_that_hold_them(spark):
    keys = [*range(-200, 5000), 0, -1, -1, -1, 63, 64, 64, 2**62, -(2**62), 2**62, None, None]
    fato = spark.createDataFrame([(k,) for k in keys], "sk_fato_frota long").repartition(7)
    got = {r.verificacao: r.violacoes for r in quality.repeated_dense_keys(fato, "fato_frota", "sk_fato_frota").collect()}
    assert got == {"pk sk_fato_frota": 5}
    unique = spark.range(-300, 9000).selectExpr("id AS sk_fato_frota").repartition(7)
    assert quality.repeated_dense_keys(unique, "fato_frota", "sk_fato_frota").first().violacoes == 0
    assert quality.repeated_dense_keys(unique.limit(0), "fato_frota", "sk_fato_frota").first().violacoes == 0


def test_hashed_vehicle_keys_and_their_collisions(spark):
    vehicles = spark.createDataFrame([("V2", "A"), ("V1", "B"), ("V1", "B"), (None, "C")], "veiculo_id string, marca string")
    dim = star.dim_veiculo(vehicles, hashed=True)
    assert dim.columns == ["sk_veiculo", "id_veiculo", "marca"]
    got = {r.id_veiculo: r.sk_veiculo for r in dim.collect()}
    assert got[None] is None and got["V1"] != got["V2"]
    assert got == {r.id_veiculo: r.sk_veiculo for r in star.dim_veiculo(vehicles.repartition(5), hashed=True).collect()}
    assert star.key_collisions(dim).collect() == []
    planted = dim.withColumn("sk_veiculo", F.when(F.col("sk_veiculo").isNotNull(), 7))
    assert [tuple(r) for r in star.key_collisions(planted).collect()] == [(7, 2, "V1", "V2")]
