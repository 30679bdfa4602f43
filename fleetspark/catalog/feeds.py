"""The test tables read as fleet feeds and as a star.

One operation per ``lineitem`` row, the vehicle is its supplier, its home state one of the 25
nations (from the vehicle number, as an operations record carries its own state). So a fact is a
plain scan: no join is needed to derive it, and column pruning reaches the Parquet file. Money is
computed in whole cents and becomes DECIMAL, so both engines see the same values. The first unit
of a quantity counts as standing still, which gives rows without distance, fuel and revenue.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import reference_data as ref
from ..operators import enrich, star

PRODUCTS = ["GASOLINA", "ETANOL", "DIESEL", "DIESEL S10", "GNV", "GASOLINA ADITIVADA"]
SEGMENTS_IN_USE = ["AUTOMOBILE", "MACHINERY", "HOUSEHOLD"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# Codes of states by state number, region after region; the last of the numbers is none.
UFS = [*[uf for states in ref.REGIONS.values() for uf in states][:24], "XX"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cents(c: Column) -> Column:
    return (c.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast("decimal(12,2)")


def half_up(num: Column, den: Column | int) -> Column:
    """Whole-number quotient of non-negative numbers, rounded half up."""
    den = F.lit(den).cast("long") if isinstance(den, int) else den.cast("long")
    return F.call_function("div", num.cast("long") * 2 + den, den * 2)


def hundredths(c: str) -> Column:
    return F.floor(F.col(c) * 100 + F.lit(0.5))


def state_number(vehicle: Column | str) -> Column:
    k = F.col(vehicle) if isinstance(vehicle, str) else vehicle
    return ((k + F.floor(k / 25)) % 25).cast("int")


def by_type(k: Column, truck, sedan, pickup) -> Column:
    return F.when(k % 5 == 3, F.lit(sedan)).when(k % 5 == 4, F.lit(pickup)).otherwise(F.lit(truck))


def build_year(k: Column) -> Column:
    return (F.lit(1995) - k % 15).cast("int")


# --- star -------------------------------------------------------------------------

def measures(spark: SparkSession, sf: str) -> DataFrame:
    """Operations with typed measures, keys and the vehicle's build year."""
    k = F.col("l_suppkey")
    age = F.col("ano") - F.col("ano_fabricacao")
    km, litres, upkeep = F.col("km"), F.col("l"), F.col("m")
    base = table(spark, sf, "lineitem").select(
        k.alias("sk_veiculo"),
        state_number(k).alias("sk_estado"),
        F.year("l_shipdate").alias("ano"),
        F.month("l_shipdate").alias("mes"),
        build_year(k).alias("ano_fabricacao"),
        ((F.floor("l_quantity") - 1) * 100).alias("km"),
        hundredths("l_discount").alias("d"),
        hundredths("l_tax").alias("t"),
        F.col("l_linenumber").alias("n"),
        k.alias("k"),
    )
    economy = by_type(F.col("k"), 35, 120, 85) * (1000 - 60 * (F.col("k") % 7) - 5 * F.col("t"))
    litres_cents = half_up(km * 1_000_000, economy)
    upkeep_cents = half_up(km * (15 + 3 * age) * by_type(F.col("k"), 10, 2, 15), 10)
    wear = km * (700 - 30 * age + 5 * F.col("d")) * by_type(F.col("k"), 10, 13, 10)
    priced = base.withColumns({"l": litres_cents, "m": upkeep_cents, "p": 520 + 19 * F.col("d")})
    return priced.select(
        "sk_veiculo", "sk_estado", star.month_key().cast("int").alias("sk_tempo"), "ano", "mes",
        "ano_fabricacao",
        km.cast("int").alias("km_rodado"),
        cents(litres).alias("litros_consumidos"),
        cents(F.col("p")).cast("decimal(6,2)").alias("preco_combustivel"),
        cents(half_up(litres * F.col("p"), 100)).alias("custo_combustivel"),
        cents(upkeep).alias("custo_manutencao"),
        cents(half_up(upkeep * 4, 10)).alias("custo_seguro"),
        cents(F.when(F.col("mes") == 1, km * 10).otherwise(0)).alias("custo_ipva"),
        cents(half_up(wear, 100)).alias("custo_depreciacao"),
        cents(km * (250 + 150 * (F.col("k") % 4) + 10 * F.col("t"))).alias("receita_estimada"),
        (F.col("n") * 8).alias("viagens_realizadas"),
        ((990 - 32 * (F.col("k") % 9) - 2 * F.col("t")).cast("decimal(8,0)") * F.lit(Decimal("0.1")))
        .cast("decimal(5,1)").alias("disponibilidade_pct"),
    )


def fato(spark: SparkSession, sf: str) -> DataFrame:
    """The fact with its derived KPIs in table types."""
    return measures(spark, sf).transform(enrich.derive_kpis).transform(star.project_fact)


def dim_veiculo(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    states = F.array(*(F.lit(s) for s in ["Ativo", "Em Manutencao", "Disponivel", "Inativo"]))
    return table(spark, sf, "supplier").select(
        k.alias("sk_veiculo"),
        F.concat(F.lit("V"), k.cast("string")).alias("id_veiculo"),
        by_type(k, "Caminhao", "Carro Sedan", "Pickup").alias("tipo_veiculo"),
        F.concat(F.lit("Marca "), (k % 6).cast("string")).alias("marca"),
        build_year(k).alias("ano_fabricacao"),
        by_type(k, "Diesel", "Flex", "Diesel").alias("combustivel"),
        ((k % 500) * 700).cast("int").alias("km_atual"),
        F.get(states, (k % 4).cast("int")).alias("status"),
        by_type(k, Decimal("3.50"), Decimal("12.00"), Decimal("8.50")).cast("decimal(6,2)")
        .alias("consumo_medio_km_l"),
        (k % 30).cast("decimal(6,1)").alias("capacidade_carga_t"),
    )


def dim_estado(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("sk_estado"),
        F.col("n_name").alias("sigla_estado"),
        F.col("r_name").alias("regiao"),
    )


def dim_tempo(spark: SparkSession, sf: str) -> DataFrame:
    """From the months of the fact: one narrow column is read."""
    months = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("ano"), F.month("l_shipdate").alias("mes"))
    return star.dim_tempo(months)


STAR = {
    "dim_tempo": dim_tempo, "dim_estado": dim_estado, "dim_veiculo": dim_veiculo, "fato_frota": fato,
}


def load_star(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    """The star, or only the tables named."""
    return {name: STAR[name](spark, sf) for name in names or STAR}


# --- raw feeds --------------------------------------------------------------------

def _state_names(spark: SparkSession, sf: str) -> DataFrame:
    """``_uf`` (number), ``nome`` and ``regiao`` of the states, a short list sent to all tasks: the planner
    takes the size of its join for large and would deal the feeds out by 25 states."""
    return F.broadcast(dim_estado(spark, sf).select(
        F.col("sk_estado").alias("_uf"), F.col("sigla_estado").alias("nome"), "regiao"
    ))


def raw_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Fuel-price feed with untidy text: padded lower-case names, prices and dates that do not
    parse."""
    price = cents(half_up(hundredths("l_extendedprice"), F.floor("l_quantity")))
    day = F.date_format("l_shipdate", "dd/MM/yyyy")
    bad_day = F.concat(F.lit("31/02/"), F.year("l_shipdate").cast("string"))
    names = F.array(*(F.lit(p.lower()) for p in PRODUCTS))
    return (
        table(spark, sf, "lineitem").withColumn("_uf", state_number("l_suppkey"))
        .join(_state_names(spark, sf), "_uf")
        .select(
            F.lower("regiao").alias("Regiao - Sigla"),
            F.concat(F.lit(" \t"), F.lower("nome"), F.lit("  ")).alias("Estado - Sigla"),
            F.concat(F.lit("Cidade "), (F.col("l_partkey") % 100).cast("string")).alias("Municipio"),
            F.concat(F.get(names, (F.col("l_partkey") % 6).cast("int")), F.lit(" ")).alias("Produto"),
            F.when(hundredths("l_discount") == 10, bad_day).otherwise(day).alias("Data da Coleta"),
            F.when(hundredths("l_tax") == 8, "abc").when(hundredths("l_tax") == 7, "nan")
            .otherwise(price.cast("string")).alias("Valor de Venda"),
            F.when(F.col("l_linenumber") > 5, "").otherwise(price.cast("string"))
            .alias("Valor de Compra"),
            F.lit("BRANCA").alias("Bandeira"),
            F.lit("R$/l").alias("Unidade de Medida"),
        )
    )


def raw_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Indicator feed, one value per order; partly filled orders carry ``...``."""
    return (
        table(spark, sf, "orders").withColumn("_uf", state_number("o_custkey"))
        .join(_state_names(spark, sf), "_uf")
        .select(
            F.concat(F.lower("o_orderpriority"), F.lit("\t")).alias("indicador"),
            F.col("o_orderstatus").alias("descricao"),
            F.year("o_orderdate").cast("string").alias("periodo"),
            F.when(F.col("o_orderstatus") == "P", "...")
            .otherwise(cents(hundredths("o_totalprice")).cast("string")).alias("valor"),
            F.concat(F.lit(" "), F.lower("nome")).alias("estado"),
        )
    )


def raw_fleet(spark: SparkSession, sf: str) -> DataFrame:
    """Registered-fleet feed, one row per customer: state from its nation, type from its segment."""
    k = F.col("c_custkey")
    return (
        table(spark, sf, "customer")
        .join(_state_names(spark, sf), F.col("c_nationkey") == F.col("_uf"))
        .select(
            (1995 + k % 7).cast("int").alias("ano"),
            F.concat(F.lower("nome"), F.lit(" ")).alias("estado"),
            F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("tipo_veiculo"),
            F.when(k % 3 == 0, "gasolina").when(k % 3 == 1, "flex").alias("combustivel"),
            F.when(F.col("c_acctbal") < 0, "n/d").otherwise(k.cast("string")).alias("quantidade"),
        )
    )


def raw_vehicles(spark: SparkSession, sf: str) -> DataFrame:
    """Vehicle registry with a later, different copy of every vehicle; ``_ordem`` is the order of
    arrival."""
    names = _state_names(spark, sf)
    rows = dim_veiculo(spark, sf).join(names, state_number("sk_veiculo") == F.col("_uf")).select(
        F.col("id_veiculo").alias("veiculo_id"),
        F.concat(F.col("tipo_veiculo"), F.lit("\t")).alias("tipo_veiculo"),
        F.concat(F.lit("  "), F.col("marca")).alias("marca"),
        "ano_fabricacao",
        F.concat(F.lower("nome"), F.lit(" ")).alias("estado"),
        F.concat(F.col("combustivel"), F.lit(" ")).alias("combustivel"),
        F.col("consumo_medio_km_l").cast("string").alias("consumo_medio_km_l"),
        F.when(F.col("km_atual") == 0, "zero").otherwise(F.col("km_atual").cast("string")).alias("km_atual"),
        "status", "capacidade_carga_t",
        F.col("sk_veiculo").alias("_ordem"),
    )
    later = rows.withColumns(
        {"marca": F.lit("Outra"), "km_atual": F.lit("1"), "_ordem": F.col("_ordem") + 10**12}
    )
    return later.unionByName(rows)


def with_orphans(rows: DataFrame, key: str, lost: Column) -> DataFrame:
    """``rows`` and, once more, those with seven times eight trips under a key that no vehicle has."""
    return rows.unionByName(rows.filter("viagens_realizadas = 56").withColumn(key, lost))


def raw_operations(spark: SparkSession, sf: str) -> DataFrame:
    """Operations feed: money as text, a cost left out now and then, state in lower case."""
    money = [
        "custo_combustivel", "custo_manutencao", "custo_seguro", "custo_ipva", "custo_depreciacao",
        "receita_estimada",
    ]
    k = F.col("sk_veiculo")
    kept = [
        "ano", "mes", "km_rodado", "litros_consumidos", "preco_combustivel", "viagens_realizadas",
        "disponibilidade_pct",
    ]
    return (
        measures(spark, sf)
        .join(_state_names(spark, sf), F.col("sk_estado") == F.col("_uf"))
        .select(
            F.concat(F.lit("V"), k.cast("string")).alias("veiculo_id"),
            by_type(k, "Caminhao", "Carro Sedan", "Pickup").alias("tipo_veiculo"),
            F.concat(F.lower("nome"), F.lit(" ")).alias("estado"),
            *kept[:5],
            *(F.when(F.col(c) == 0, F.lit("")).otherwise(F.col(c).cast("string")).alias(c) for c in money),
            *kept[5:],
        )
    )
