"""One query per operator over the test tables: ``QUERIES[name](spark, sf_dir) -> DataFrame``.

Results carry decimals as doubles, so clients without a decimal type read the same values.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import decimal_mean, decimals_as_double, round_floor, to_number
from ..operators import (
    cleaning, diagnostics, enrich, forecast, kpis, marts, prescriptive, reference_tables,
    standardize, star, views,
)
from ..plans import pipelines
from ..session import new_work_dir, stored
from ..sources import quality, readers, writers
from . import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

OLD, NEW = "20240131", "20240229"
SERIES = ["tipo_veiculo", "sk_estado"]


def query(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return decimals_as_double(build(spark, sf))

        QUERIES[name] = run
        return build

    return add


def count() -> Column:
    return F.count(F.lit(1)).alias("n")


def rounded(c: str, digits: int = 6) -> Column:
    return F.round(c, digits).alias(c)


# --- sources and sinks ------------------------------------------------------------

def write_raw_csv(df: DataFrame, path: str) -> str:
    """A feed as compressed part files, each of a size that one task can read."""
    df.write.options(header=True, nullValue=readers.MISSING, compression="lz4", maxRecordsPerFile=500_000).csv(path)
    return path


@query("src_csv_scan")
def src_csv_scan(spark, sf):
    path = write_raw_csv(feeds.raw_fleet(spark, sf), new_work_dir(spark, "csv"))
    rows = readers.read_feed(spark, "registered_fleet", "", path)
    return rows.groupBy("ano", F.coalesce("combustivel", F.lit("?")).alias("combustivel")).agg(
        count(), F.count("quantidade").alias("com_texto")
    )


@query("src_latest_snapshot")
def src_latest_snapshot(spark, sf):
    folder = new_work_dir(spark, "raw")
    fleet = feeds.raw_fleet(spark, sf)
    write_raw_csv(fleet.filter("ano < 1998"), os.path.join(folder, f"denatran_frota_{OLD}"))
    write_raw_csv(fleet, os.path.join(folder, f"denatran_frota_{NEW}"))
    return readers.read_feed(spark, "registered_fleet", folder).groupBy("ano").agg(count())


@query("src_staging_pick")
def src_staging_pick(spark, sf):
    folder = new_work_dir(spark, "staging")
    fleet, vehicles = feeds.measures(spark, sf), feeds.dim_veiculo(spark, sf)
    slim = fleet.select("sk_veiculo", "ano", "km_rodado")
    writers.write_staging(
        {"frota_enriquecida": slim.filter("ano < 1998"), "veiculos_clean": vehicles.limit(0)}, folder, OLD
    )
    writers.write_staging({"frota_enriquecida": slim, "veiculos_clean": vehicles}, folder, NEW)
    picked = readers.read_staging(spark, folder)
    sums = {"frota_enriquecida": F.sum("km_rodado"), "veiculos_clean": F.sum("km_atual")}
    totals = [df.agg(F.lit(name).alias("tabela"), count(), sums[name].alias("soma")) for name, df in picked.items()]
    return reduce(DataFrame.unionByName, totals)


def indicator_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Service answers built from orders: per indicator one JSON list with a series per state,
    each a map from year to the sum of values (``...`` for one year in five, another one by state)."""
    cleaned = cleaning.clean_indicators(feeds.raw_indicators(spark, sf))
    yearly = cleaned.groupBy("indicador", "estado", "periodo").agg(F.sum("valor").alias("v"))
    gap = F.col("periodo").cast("int") % 5 == F.length("estado") % 5
    text = F.when(gap, "...").otherwise(F.col("v").cast("decimal(20,2)").cast("string"))
    series = yearly.groupBy("indicador", "estado").agg(
        F.map_from_entries(F.collect_list(F.struct("periodo", text.alias("t")))).alias("serie")
    )
    entry = F.struct(
        F.struct(F.lower("estado").alias("id"), F.col("estado").alias("nome")).alias("localidade"), "serie"
    )
    result = series.groupBy("indicador").agg(F.collect_list(entry).alias("series"))
    return result.select(
        "indicador",
        F.to_json(F.array(F.struct(F.array(F.struct("series")).alias("resultados")))).alias("texto"),
    )


@query("src_json_indicator")
def src_json_indicator(spark, sf):
    parsed = indicator_payloads(spark, sf).select(
        "indicador", F.explode(readers.parse_payload("texto")).alias("p")
    )
    return readers.flatten_indicator(parsed.select("indicador", "p.*"), ["indicador"])


@query("src_json_indicator_uf")
def src_json_indicator_uf(spark, sf):
    path = new_work_dir(spark, "json")
    indicator_payloads(spark, sf).write.partitionBy("indicador").text(path)
    payload = readers.read_indicator_json(spark, path)
    return readers.flatten_indicator(payload, ["indicador"], by_state=True)


@query("src_json_props")
def src_json_props(spark, sf):
    events = feeds.table(spark, sf, "events")
    entries = events.select(
        "event_type", F.explode(F.from_json("props", "map<string,string>")).alias("chave", "texto")
    )
    return entries.select("event_type", "chave", to_number("texto", "double").alias("v")).groupBy(
        "event_type", "chave"
    ).agg(F.count("v").alias("n"), F.sum("v").alias("soma"))


@query("src_indicator_lookup")
def src_indicator_lookup(spark, sf):
    names = F.array(*(F.lit(x) for x in ["ipca", "Pib", "SALARIO", "populacao", "selic"]))
    rows = feeds.table(spark, sf, "orders").select(
        F.get(names, (F.col("o_custkey") % 5).cast("int")).alias("indicador"), "o_totalprice"
    )
    found = readers.lookup_indicators(rows, readers.indicator_catalog(spark), fail=False)
    return found.groupBy("indicador", "agregado", "descricao").agg(count())


@query("src_union_indicators")
def src_union_indicators(spark, sf):
    rows = stored(cleaning.clean_indicators(feeds.raw_indicators(spark, sf)), "indicadores")  # each branch reads it
    tables = [rows.filter(F.col("indicador") == p) for p in feeds.PRIORITIES[1:]]
    national = rows.filter(F.col("indicador") == feeds.PRIORITIES[0]).drop("estado")
    both = readers.union_indicators([national, *tables, rows.limit(0)])
    return both.groupBy("indicador", F.coalesce("estado", F.lit("BRASIL")).alias("estado")).agg(
        count(), F.sum("valor").alias("soma")
    )


@query("sink_staging")
def sink_staging(spark, sf):
    folder = new_work_dir(spark, "staging")
    prices = cleaning.clean_prices(feeds.raw_prices(spark, sf))
    indicators = cleaning.clean_indicators(feeds.raw_indicators(spark, sf))
    fleet = cleaning.clean_registered_fleet(feeds.raw_fleet(spark, sf))
    paths = writers.write_staging(
        {
            "anp_mensal": standardize.prices_wide(stored(standardize.monthly_prices(prices), "precos")),
            "ibge_wide": standardize.indicators_wide(stored(indicators, "indicadores")),
            "denatran_resumo": standardize.fleet_summary(fleet, feeds.SEGMENTS_IN_USE),
            "veiculos_clean": cleaning.clean_vehicles(feeds.raw_vehicles(spark, sf), "_ordem"),
            "frota_enriquecida": feeds.measures(spark, sf),
        },
        folder, NEW,
    )
    sums = {
        "anp_mensal": F.sum("preco_diesel"), "ibge_wide": F.sum(F.round("`1-URGENT`", 6)),
        "denatran_resumo": F.sum("frota_total"), "veiculos_clean": F.sum("km_atual"),
        "frota_enriquecida": F.sum("receita_estimada"),
    }
    totals = [
        spark.read.parquet(path).agg(
            F.lit(name).alias("tabela"), count(), F.round(sums[name].cast("double"), 2).alias("soma"))
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, totals)


@query("sink_star_full_refresh")
def sink_star_full_refresh(spark, sf):
    folder = new_work_dir(spark, "star")
    tables = feeds.load_star(spark, sf)
    writers.write_star(tables | {"fato_frota": tables["fato_frota"].limit(0)}, folder)
    writers.write_star(tables, folder)
    return views.vw_kpi_estado(*(writers.read_star(spark, folder)[t] for t in ("fato_frota", "dim_estado")))


@query("sink_results")
def sink_results(spark, sf):
    folder = new_work_dir(spark, "results")
    rules = pipelines.prescriptive_tables(feeds.load_star(spark, sf))
    tables = {"alertas": rules["alertas"], "vazio": rules["alertas"].limit(0)}
    paths = writers.write_results(tables, folder, NEW, csv=True)
    names = [(os.path.basename(path).rsplit("_", 1)[0],) for _, path in readers.list_snapshots(spark, folder, "")]
    found = spark.createDataFrame(names, "tabela string")
    back = spark.read.schema(rules["alertas"].schema).csv(paths["alertas"], header=True)
    totals = back.agg(F.lit("alertas").alias("tabela"), count(), F.sum("limite").alias("soma_limites"))
    return found.join(totals, "tabela", "left")


@query("sink_summary")
def sink_summary(spark, sf):
    rules = pipelines.prescriptive_tables(feeds.load_star(spark, sf))
    path = writers.write_summary(rules["resumo"], new_work_dir(spark, "results"), NEW)
    return spark.read.text(path).withColumnRenamed("value", "texto")


@query("src_star_wide")
def src_star_wide(spark, sf):
    return star.frota_wide(*feeds.load_star(spark, sf, "fato_frota", "dim_estado", "dim_veiculo").values())


@query("view_registry")
def view_registry(spark, sf):
    """The rows of each view and the sum of one of its columns, over a fact that is derived once."""
    s = feeds.load_star(spark, sf, "fato_frota", "dim_estado", "dim_veiculo")
    names = views.register_views(s | {"fato_frota": stored(s["fato_frota"], "fato")})
    sums = {
        "vw_resumo_mensal": "total_custo", "vw_kpi_estado": "total_custo", "vw_kpi_tipo_veiculo": "total_custo",
        "vw_veiculos_alto_custo": "custo_total_periodo", "vw_impacto_combustivel": "total_custo",
        "vw_eficiencia_idade": "total_veiculos", "vw_ranking_margem": "custo_total",
    }
    totals = [
        spark.table(v).agg(F.lit(v).alias("visao"), count(), F.sum(sums[v]).cast("double").alias("soma")) for v in names
    ]
    return reduce(DataFrame.unionByName, totals)


@query("ref_upsert")
def ref_upsert(spark, sf):
    """Mean order value by state and priority: rows of 1998 and later replace the earlier ones."""
    rows = cleaning.clean_indicators(feeds.raw_indicators(spark, sf))
    recent = F.col("periodo") >= "1998"

    def table(test):
        return rows.filter(test).groupBy("indicador", "estado").agg(
            F.round(decimal_mean("valor"), 2).alias("valor_limite"), count()
        )

    return reference_tables.upsert(table(~recent), table(recent), ["indicador", "estado"])


@query("ref_tables")
def ref_tables(spark, sf):
    """The reference tables read back from the warehouse, joined to the alerts and decisions of the star."""
    folder = new_work_dir(spark, "warehouse")
    ref = {
        name: spark.read.parquet(writers.write_dimension(df, folder, name))
        for name, df in reference_tables.reference_rows(spark).items()
    }
    kpi_rows = stored(_kpis(spark, sf), "kpis")
    limits = prescriptive.alerts(kpi_rows).select("kpi", F.col("classificacao").alias("tipo_alerta"), "limite").join(
        ref["ref_limites_kpi"], ["kpi", "tipo_alerta"])
    ages = kpi_rows.join(ref["ref_faixa_idade"], F.col("idade_veiculo").between(F.col("idade_min"), F.col("idade_max")))
    fuels = kpi_rows.join(ref["ref_combustivel"], F.col("combustivel") == F.col("tipo_combustivel"))
    value = lambda c: F.sum(c).cast("double").alias("soma")
    return (
        limits.groupBy(F.concat_ws("/", "kpi", "tipo_alerta", "acao_recomendada").alias("chave")).agg(count(), value("valor_limite"))
        .unionByName(ages.groupBy(F.concat_ws("/", "faixa", "recomendacao").alias("chave")).agg(count(), value("idade_max")))
        .unionByName(fuels.groupBy(F.col("tipo_combustivel").alias("chave")).agg(count(), value("emissoes_co2_g_km")))
    )


@query("dq_constraints")
def dq_constraints(spark, sf):
    """Checks on a star with planted defects: old vehicles missing, states of one region twice,
    no distance where a vehicle stood still, one fact number a month for all operations of 56 trips."""
    s = feeds.load_star(spark, sf)
    shared = F.when(F.col("viagens_realizadas") == 56, -F.col("sk_tempo")).otherwise(F.col("sk_fato_frota"))
    checked = s["fato_frota"].select(*star.FACT_KEYS, "km_rodado", "viagens_realizadas")
    fato = star.add_fact_number(checked, blocks=16).withColumns(
        {"sk_fato_frota": shared, "km_rodado": F.nullif("km_rodado", F.lit(0))})
    # a fact is a stored table; the checks read its columns one after the other
    fato = stored(fato.select("sk_fato_frota", *star.FACT_KEYS, "km_rodado"), "fato")
    estado = s["dim_estado"]
    damaged = {
        "dim_tempo": s["dim_tempo"],
        "dim_estado": estado.unionByName(estado.filter("regiao = 'ASIA'")),
        "dim_veiculo": s["dim_veiculo"].filter("ano_fabricacao >= 1983"),
        "fato_frota": fato,
    }
    return quality.constraint_report(damaged)


# --- cleaning ---------------------------------------------------------------------

@query("clean_rename")
def clean_rename(spark, sf):
    renamed = cleaning.rename_headers(feeds.raw_prices(spark, sf))
    return renamed.select("estado", "produto", "data_coleta", "valor_venda", "bandeira", "unidade_medida")


@query("clean_dedup_full")
def clean_dedup_full(spark, sf):
    raw = cleaning.rename_headers(feeds.raw_prices(spark, sf))
    return cleaning.drop_duplicate_rows(raw.unionByName(raw)).select(
        "regiao", "estado", "municipio", "produto", "data_coleta", "valor_venda", "valor_compra"
    )


@query("clean_dedup_key")
def clean_dedup_key(spark, sf):
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    rows = feeds.table(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", order.alias("_ordem")
    )
    return cleaning.keep_first_by_key(rows, ["l_suppkey"], "_ordem").drop("_ordem")


@query("clean_to_numeric")
def clean_to_numeric(spark, sf):
    rows = cleaning.rename_headers(feeds.raw_prices(spark, sf))
    parsed = cleaning.parse_numbers(rows, {"valor_venda": cleaning.PRICE, "valor_compra": cleaning.PRICE})
    return parsed.groupBy("produto").agg(
        count(), F.count("valor_venda").alias("n_venda"), F.sum("valor_venda").alias("soma_venda"),
        F.count("valor_compra").alias("n_compra"), F.sum("valor_compra").alias("soma_compra"),
    )


@query("clean_dropna")
def clean_dropna(spark, sf):
    rows = cleaning.rename_headers(feeds.raw_prices(spark, sf))
    parsed = cleaning.parse_numbers(rows, {"valor_venda": cleaning.PRICE})
    return cleaning.require(parsed, ["valor_venda"]).groupBy("estado").agg(count())


@query("clean_upper_strip")
def clean_upper_strip(spark, sf):
    rows = cleaning.rename_headers(feeds.raw_prices(spark, sf))
    return cleaning.upper_text(rows, ["regiao", "estado", "produto"]).groupBy(
        "regiao", "estado", "produto"
    ).agg(count())


@query("clean_strip")
def clean_strip(spark, sf):
    rows = cleaning.strip_text(feeds.raw_vehicles(spark, sf), ["tipo_veiculo", "marca", "combustivel"])
    return rows.select("veiculo_id", "tipo_veiculo", "marca", "combustivel")


@query("clean_parse_date")
def clean_parse_date(spark, sf):
    rows = cleaning.rename_headers(feeds.raw_prices(spark, sf)).withColumn("texto", F.col("data_coleta"))
    parsed = cleaning.parse_dates(rows, "data_coleta")
    return parsed.groupBy("texto", F.col("data_coleta").cast("string").alias("data")).agg(count())


@query("clean_date_parts")
def clean_date_parts(spark, sf):
    rows = cleaning.parse_dates(cleaning.rename_headers(feeds.raw_prices(spark, sf)), "data_coleta")
    parts = cleaning.add_year_month(rows, "data_coleta")
    return parts.groupBy(F.coalesce("ano", F.lit(0)).alias("ano"), F.coalesce("mes", F.lit(0)).alias("mes")).agg(count())


@query("clean_fill_zero")
def clean_fill_zero(spark, sf):
    money = dict.fromkeys(cleaning.COST_COLUMNS, cleaning.MONEY)
    rows = cleaning.fill_zero(cleaning.parse_numbers(feeds.raw_operations(spark, sf), money))
    return rows.groupBy("tipo_veiculo", "mes").agg(
        count(), *(F.count(c).alias(f"n_{c}") for c in money), *(F.sum(c).alias(c) for c in money)
    )


@query("clean_period_string")
def clean_period_string(spark, sf):
    rows = feeds.table(spark, sf, "orders").select(F.year("o_orderdate").alias("periodo"))
    return cleaning.period_as_text(rows).groupBy("periodo").agg(count())


@query("clean_anp")
def clean_anp(spark, sf):
    return cleaning.clean_prices(feeds.raw_prices(spark, sf)).select(
        "regiao", "estado", "municipio", "produto", F.col("data_coleta").cast("string").alias("data_coleta"),
        "valor_venda", "valor_compra", F.coalesce("ano", F.lit(0)).alias("ano"),
        F.coalesce("mes", F.lit(0)).alias("mes"),
    )


@query("clean_ibge")
def clean_ibge(spark, sf):
    return cleaning.clean_indicators(feeds.raw_indicators(spark, sf))


@query("clean_denatran")
def clean_denatran(spark, sf):
    return cleaning.clean_registered_fleet(feeds.raw_fleet(spark, sf)).withColumn(
        "combustivel", F.coalesce("combustivel", F.lit("?"))
    )


@query("clean_fleet")
def clean_fleet(spark, sf):
    rows = cleaning.clean_vehicles(feeds.raw_vehicles(spark, sf), "_ordem")
    return rows.withColumn("km_atual", F.col("km_atual").cast("double"))


@query("clean_fleet_operacoes")
def clean_fleet_operacoes(spark, sf):
    return cleaning.clean_operations(feeds.raw_operations(spark, sf))


# --- standardising ----------------------------------------------------------------

def _prices(spark, sf):
    return cleaning.clean_prices(feeds.raw_prices(spark, sf))


def _indicators(spark, sf):
    return cleaning.clean_indicators(feeds.raw_indicators(spark, sf))


def _fleet(spark, sf):
    return cleaning.clean_registered_fleet(feeds.raw_fleet(spark, sf))


@query("std_price_monthly")
def std_price_monthly(spark, sf):
    return standardize.monthly_prices(_prices(spark, sf))


def _prices_wide(spark, sf):
    return standardize.prices_wide(standardize.monthly_prices(_prices(spark, sf)), feeds.PRODUCTS)


@query("std_price_pivot")
def std_price_pivot(spark, sf):
    return _prices_wide(spark, sf)


@query("std_price_names")
def std_price_names(spark, sf):
    wide = standardize.prices_wide(stored(standardize.monthly_prices(_prices(spark, sf)), "precos"))
    names = [c for c in wide.columns if c.startswith("preco_")]
    return wide.unpivot(["estado", "ano", "mes"], names, "coluna", "preco").groupBy("coluna").agg(
        F.count("preco").alias("n"), F.sum("preco").alias("soma")
    )


def _indicators_wide(spark, sf):
    return standardize.indicators_wide(_indicators(spark, sf), feeds.PRIORITIES)


def _rounded_values(df: DataFrame, keys: set[str]) -> DataFrame:
    return df.select(*(c if c in keys else F.round(f"`{c}`", 6).alias(c) for c in df.columns))


@query("std_indicator_wide")
def std_indicator_wide(spark, sf):
    return _rounded_values(_indicators_wide(spark, sf), {"estado", "ano"})


@query("std_indicator_wide_national")
def std_indicator_wide_national(spark, sf):
    national = _indicators(spark, sf).drop("estado")
    return _rounded_values(standardize.indicators_wide(national, feeds.PRIORITIES), {"periodo"})


@query("std_fleet_summary")
def std_fleet_summary(spark, sf):
    return standardize.fleet_summary(_fleet(spark, sf), feeds.SEGMENTS_IN_USE).drop("frota_operacional")


@query("std_fleet_operational")
def std_fleet_operational(spark, sf):
    return standardize.fleet_summary(_fleet(spark, sf), feeds.SEGMENTS_IN_USE).drop("num_tipos")


# --- enrichment -------------------------------------------------------------------

def _operations(spark, sf):
    return cleaning.clean_operations(feeds.raw_operations(spark, sf))


def _vehicles(spark, sf):
    return cleaning.clean_vehicles(feeds.raw_vehicles(spark, sf), "_ordem")


@query("enrich_vehicle")
def enrich_vehicle(spark, sf):
    unknown = F.concat(F.lit("X"), "veiculo_id")
    rows = feeds.with_orphans(_operations(spark, sf), "veiculo_id", unknown)
    return enrich.add_vehicle(rows, _vehicles(spark, sf)).groupBy(
        F.coalesce("marca", F.lit("?")).alias("marca"), F.coalesce("status", F.lit("?")).alias("status"), "ano"
    ).agg(count(), F.sum("km_rodado").alias("km"), F.sum("capacidade_carga_t").alias("capacidade"))


@query("enrich_price")
def enrich_price(spark, sf):
    wide = _prices_wide(spark, sf)
    prices = [c for c in wide.columns if c.startswith("preco_")]
    # later operations find no price
    rows = enrich.add_prices(_operations(spark, sf), wide.filter("ano < 2000"))
    return rows.groupBy("estado", "ano", "mes").agg(count(), *(F.sum(c).alias(c) for c in prices))


@query("enrich_indicators")
def enrich_indicators(spark, sf):
    rows = enrich.add_indicators(_operations(spark, sf), _indicators_wide(spark, sf))
    return rows.groupBy("estado", "ano").agg(
        count(), *(F.round(F.max(f"`{p}`"), 6).alias(p) for p in feeds.PRIORITIES)
    )


@query("enrich_registered_fleet")
def enrich_registered_fleet(spark, sf):
    fleet = standardize.fleet_summary(_fleet(spark, sf), feeds.SEGMENTS_IN_USE)
    rows = enrich.add_registered_fleet(_operations(spark, sf), fleet)
    return rows.groupBy("estado", "ano").agg(
        count(), F.sum("frota_total").alias("frota_total"),
        F.sum(F.col("frota_operacional").cast("double")).alias("frota_operacional"),
    )


def _derived(spark, sf, column: str) -> DataFrame:
    rows = feeds.measures(spark, sf).transform(enrich.derive_kpis)
    return rows.select("sk_veiculo", "sk_tempo", "km_rodado", rounded(column))


for _name, _column in {
    "derive_custo_total": "custo_total", "derive_custo_por_km": "custo_por_km",
    "derive_margem": "margem_operacional", "derive_km_por_litro": "km_por_litro_real",
    "derive_idade": "idade_veiculo",
}.items():
    query(_name)(lambda spark, sf, _c=_column: _derived(spark, sf, _c))


@query("star_join_tempo")
def star_join_tempo(spark, sf):
    s = feeds.load_star(spark, sf, "fato_frota", "dim_tempo")
    return s["fato_frota"].join(s["dim_tempo"], "sk_tempo").groupBy("ano", "trimestre", "semestre", "nome_mes").agg(
        count(), F.sum("km_rodado").alias("km")
    )


@query("star_join_estado")
def star_join_estado(spark, sf):
    s = feeds.load_star(spark, sf, "fato_frota", "dim_estado")
    return s["fato_frota"].join(s["dim_estado"], "sk_estado").groupBy("sigla_estado", "regiao").agg(
        count(), F.sum("km_rodado").alias("km")
    )


@query("star_join_veiculo")
def star_join_veiculo(spark, sf):
    s = feeds.load_star(spark, sf, "fato_frota", "dim_veiculo")
    rows = feeds.with_orphans(s["fato_frota"], "sk_veiculo", -1 - F.col("sk_veiculo"))
    return rows.join(s["dim_veiculo"], "sk_veiculo").groupBy("id_veiculo", "marca", "status").agg(
        count(), F.sum("km_rodado").alias("km")
    )


#: raw feeds that were written before, by application and tables: a bench times the job, not its fixture
PREPARED: dict[tuple[str, str], str] = {}


def raw_feeds(spark: SparkSession, sf: str) -> str:
    """The test tables as raw CSV feeds; returns their folder."""
    raw = new_work_dir(spark, "raw")
    prefixes = {
        "anp_combustivel": feeds.raw_prices, "ibge_indicadores": feeds.raw_indicators,
        "denatran_frota": feeds.raw_fleet, "frota_operacoes": feeds.raw_operations,
    }
    for prefix, build in prefixes.items():
        write_raw_csv(build(spark, sf), os.path.join(raw, f"{prefix}_{NEW}"))
    # one ordered file: the place of a row in the feed decides between copies of a vehicle
    vehicles = feeds.raw_vehicles(spark, sf).repartitionByRange(8, "_ordem").sortWithinPartitions("_ordem")
    write_raw_csv(vehicles.drop("_ordem"), os.path.join(raw, f"frota_veiculos_{NEW}"))
    return raw


def prepare(spark: SparkSession, sf: str) -> None:
    """Write the raw feeds once for all pipelines of this application."""
    PREPARED[spark.sparkContext.applicationId, sf] = raw_feeds(spark, sf)


def run_raw_to_staging(spark: SparkSession, sf: str) -> str:
    """Raw CSV feeds through the ETL; returns the staging folder."""
    raw = PREPARED.get((spark.sparkContext.applicationId, sf)) or raw_feeds(spark, sf)
    staging = new_work_dir(spark, "staging")
    pipelines.run_etl(spark, raw, staging, NEW)
    return staging


@query("enrich_pipeline")
def enrich_pipeline(spark, sf):
    staging = run_raw_to_staging(spark, sf)
    rows = readers.read_latest_parquet(spark, staging, "frota_enriquecida")
    # the least text would make Spark sort the rows of a single aggregate; as a key it is hashed
    by_make = rows.groupBy("estado", "ano", "mes", "marca").agg(
        count(), F.sum("km_rodado").alias("km"), F.sum("custo_total").alias("custo_total"),
        F.sum(F.round("custo_por_km", 6)).alias("soma_custo_km"),
        F.max("preco_diesel").alias("preco_diesel"), F.max("`1-URGENT`").alias("urgent"),
        F.max("frota_total").alias("frota_total"),
    )
    return by_make.groupBy("estado", "ano", "mes").agg(
        F.sum("n").alias("n"), F.sum("km").alias("km"), F.sum("custo_total").alias("custo_total"),
        F.round(F.sum("soma_custo_km"), 6).alias("soma_custo_km"),
        F.max("preco_diesel").alias("preco_diesel"), F.round(F.max("urgent"), 6).alias("urgent"),
        F.max("frota_total").alias("frota_total"), F.min("marca").alias("marca"),
    )


# --- star -------------------------------------------------------------------------

@query("dim_tempo")
def dim_tempo(spark, sf):
    return star.dim_tempo(feeds.measures(spark, sf))


@query("dim_estado")
def dim_estado(spark, sf):
    """States by the codes of the federal units, so that every region is met."""
    number = F.col("sk_estado")
    codes = feeds.measures(spark, sf).select(F.get(F.array(*(F.lit(u) for u in feeds.UFS)), number).alias("estado"))
    return star.dim_estado(codes)


@query("dim_veiculo")
def dim_veiculo(spark, sf):
    block = F.floor(F.substring("id_veiculo", 2, 18).cast("long") / 65536)
    dim = star.dim_veiculo(_vehicles(spark, sf), block=block, blocks=1)
    return dim.withColumn("km_atual", F.col("km_atual").cast("double"))


@query("dim_veiculo_hash")
def dim_veiculo_hash(spark, sf):
    """Vehicles by hashed keys: how many ids share the key, and the operations that find it without a join
    to look it up. The hash itself is no result, as only Spark computes it."""
    dim = star.dim_veiculo(_vehicles(spark, sf), hashed=True)
    ids = dim.groupBy("sk_veiculo").agg(F.count_distinct("id_veiculo").alias("ids_por_chave"))
    vehicle = F.concat(F.lit("V"), F.col("sk_veiculo").cast("string"))
    rows = feeds.measures(spark, sf).select(star.vehicle_key(vehicle).alias("sk_veiculo"))
    used = rows.groupBy("sk_veiculo").agg(F.count(F.lit(1)).alias("operacoes"))
    return dim.join(ids, "sk_veiculo").join(used, "sk_veiculo", "left").select(
        "id_veiculo", "tipo_veiculo", "ids_por_chave", F.coalesce("operacoes", F.lit(0)).alias("operacoes"))


@query("dim_veiculo_colisoes")
def dim_veiculo_colisoes(spark, sf):
    """Planted collisions: keys that keep only the vehicle number's remainder by 7, and one repeated row for each."""
    dim = star.dim_veiculo(_vehicles(spark, sf), hashed=True)
    short = dim.withColumn("sk_veiculo", F.substring("id_veiculo", 2, 18).cast("long") % 7)
    return star.key_collisions(short.unionByName(short))


@query("fact_key_lookup")
def fact_key_lookup(spark, sf):
    s = feeds.load_star(spark, sf)
    rows = feeds.with_orphans(_operations(spark, sf), "veiculo_id", F.concat(F.lit("X"), "veiculo_id"))
    keyed = star.add_fact_keys(rows, s["dim_tempo"], s["dim_estado"], s["dim_veiculo"])
    return keyed.groupBy(*star.FACT_KEYS).agg(count(), F.sum("km_rodado").alias("km"))


@query("fact_surrogate_key")
def fact_surrogate_key(spark, sf):
    return star.add_fact_number(feeds.fato(spark, sf), blocks=16).select("sk_fato_frota", "sk_tempo")


@query("fact_project_cast")
def fact_project_cast(spark, sf):
    return feeds.fato(spark, sf)


@query("star_pipeline")
def star_pipeline(spark, sf):
    staging = run_raw_to_staging(spark, sf)
    loaded = pipelines.run_load(spark, staging, new_work_dir(spark, "star"), blocks=16)
    rows = star.frota_wide(*(loaded[t] for t in ("fato_frota", "dim_estado", "dim_veiculo")))
    return rows.groupBy("sigla_estado", "regiao", "sk_estado", "ano", "nome_mes", "tipo_veiculo").agg(
        count(), F.sum("km_rodado").alias("km"), F.sum("custo_total").alias("custo_total"),
        F.sum("custo_por_km").alias("soma_custo_km"),
    )


# --- SQL analytics ----------------------------------------------------------------

E, V = "dim_estado", "dim_veiculo"
for _name, (_build, _dims) in {
    "vw_resumo_mensal": (views.vw_resumo_mensal, []),
    "vw_kpi_estado": (views.vw_kpi_estado, [E]),
    "vw_kpi_tipo_veiculo": (views.vw_kpi_tipo_veiculo, [V]),
    "vw_veiculos_alto_custo": (views.vw_veiculos_alto_custo, [V, E]),
    "vw_impacto_combustivel": (views.vw_impacto_combustivel, [E, V]),
    "vw_eficiencia_idade": (views.vw_eficiencia_idade, []),
    "vw_ranking_margem": (views.vw_ranking_margem, [V, E]),
    "kpi_custo_por_km": (kpis.kpi_custo_por_km, [V, E]),
    "kpi_consumo_medio": (kpis.kpi_consumo_medio, [V]),
    "kpi_utilizacao": (kpis.kpi_utilizacao, [E]),
    "kpi_composicao_custos": (kpis.kpi_composicao_custos, []),
    "kpi_rentabilidade": (kpis.kpi_rentabilidade, [V]),
    "diag_impacto_preco": (diagnostics.price_impact, [V, E]),
    "diag_ineficiencia": (diagnostics.inefficient_vehicles, [V, E]),
    "diag_causa_raiz": (diagnostics.root_cause, [V]),
    "diag_idade_manutencao": (diagnostics.age_and_maintenance, []),
    "diag_anomalia_consumo": (diagnostics.consumption_anomalies, [V, E]),
    "presc_vehicle_kpis": (prescriptive.vehicle_kpis, [V, E]),
    "dash_cards": (marts.cards, []),
    "dash_g1": (marts.monthly_cost_by_type, [V]),
    "dash_g2": (marts.revenue_and_cost_by_year, []),
    "dash_g3": (marts.cost_by_region, [E]),
    "dash_g4": (marts.cost_parts_by_type, [V]),
    "dash_g5": (marts.cost_by_type, [V]),
    "dash_g6": (marts.consumption_by_type, [V]),
    "dash_g9": (marts.cost_by_age_band, []),
    "dash_g10": (marts.maintenance_and_fuel_by_year, []),
    "dash_g12": (marts.availability_by_type, [V]),
}.items():
    def _star_query(spark, sf, _b=_build, _d=_dims):
        return _b(*feeds.load_star(spark, sf, "fato_frota", *_d).values())

    query(_name)(_star_query)


@query("diag_impacto_preco_uf")
def diag_impacto_preco_uf(spark, sf):
    s = feeds.load_star(spark, sf, "fato_frota", V, E)
    return diagnostics.price_impact(*s.values(), by_state=True)


# --- predictive -------------------------------------------------------------------

def _series(spark, sf, keys=SERIES, test="true"):
    s = feeds.load_star(spark, sf, "fato_frota", V)
    return forecast.monthly_series(s["fato_frota"].filter(test), keys, s[V])


def _digits(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*(round_floor(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns))


@query("pred_monthly_series")
def pred_monthly_series(spark, sf):
    return _digits(_series(spark, sf), {"custo_por_km": 6})


@query("pred_monthly_series_total")
def pred_monthly_series_total(spark, sf):
    return _digits(_series(spark, sf, []), {"custo_por_km": 6})


@query("pred_linreg_fit")
def pred_linreg_fit(spark, sf):
    fit = forecast.fit_regression(_series(spark, sf), SERIES)
    per_million = {c: F.col(c) * 1e6 for c in ("coef_km_rodado", "coef_custo_combustivel")}
    return _digits(
        fit.withColumns(per_million).select(*SERIES, "intercepto", "coef_periodo_idx", *per_million, "n"),
        {"intercepto": 5, "coef_periodo_idx": 6, "coef_km_rodado": 4, "coef_custo_combustivel": 4},
    )


@query("pred_linreg_metrics")
def pred_linreg_metrics(spark, sf):
    fit = forecast.fit_regression(_series(spark, sf), SERIES)
    return _digits(fit.select(*SERIES, "r2", "mae"), {"r2": 6, "mae": 6})


@query("pred_linreg_forecast")
def pred_linreg_forecast(spark, sf):
    fit = forecast.fit_regression(_series(spark, sf), SERIES)
    return forecast.forecast_regression(fit, SERIES, km=10_000.0, fuel_cost=20_000.0)


@query("pred_last_period")
def pred_last_period(spark, sf):
    return forecast.last_period(_series(spark, sf), SERIES)


@query("pred_arima")
def pred_arima(spark, sf):
    """Every series of the whole fact; one that ARIMA does not fit says why and has its moving average."""
    return forecast.forecast_series(_series(spark, sf), SERIES)


@query("pred_aic")
def pred_aic(spark, sf):
    fit = forecast.fit_arima(_series(spark, sf), SERIES)
    return _digits(fit.select(*SERIES, "n", "phi", "theta", "aic"), {"phi": 5, "theta": 5, "aic": 4})


@query("pred_moving_average")
def pred_moving_average(spark, sf):
    return forecast.moving_average(_series(spark, sf), SERIES)


@query("pred_moving_average_short")
def pred_moving_average_short(spark, sf):
    """Series of one year asked for 18 months: the mean of the series throughout."""
    first_year = _series(spark, sf, test="sk_tempo BETWEEN 199501 AND 199512")
    return forecast.moving_average(first_year, SERIES, periods=18)


@query("pred_trend_by_type")
def pred_trend_by_type(spark, sf):
    return forecast.trend(_series(spark, sf, ["tipo_veiculo"]))


@query("pred_series_forecast")
def pred_series_forecast(spark, sf):
    """The whole fact's series and, as further ones, those of one state in five cut after half a year, of another one
    at a constant cost, and of a third one growing ever faster."""
    series = stored(_series(spark, sf), "series")
    kind = F.col("sk_estado") % 5
    planted = series.filter("sk_estado % 5 = 0 AND ano * 100 + mes < 199507 OR sk_estado % 5 IN (1, 2)")
    wild = F.pow(F.lit(1.2), F.col("periodo_idx")) + F.col("periodo_idx") * 7 % 5 / 10
    cost = F.when(kind == 1, 2.0).when(kind == 2, wild).otherwise(F.col("custo_por_km"))
    planted = planted.withColumns({"custo_por_km": cost, "sk_estado": (-1 - F.col("sk_estado")).cast("int")})
    return forecast.forecast_series(series.unionByName(planted), SERIES)


@query("pred_forecast_counts")
def pred_forecast_counts(spark, sf):
    """As many series with a last period as with a forecast, over the whole fact."""
    series = stored(_series(spark, sf), "series")
    ends = forecast.last_period(series, SERIES).agg(F.lit("fim").alias("tabela"), count())
    return ends.unionByName(
        forecast.forecast_series(series, SERIES).filter("periodo = 1").agg(F.lit("previsao").alias("tabela"), count()))


@query("pred_pipeline")
def pred_pipeline(spark, sf):
    """All three forecasts of the fleet-wide and per-type series, as one long table."""
    s = feeds.load_star(spark, sf)
    folder = new_work_dir(spark, "predictive")
    paths = writers.write_results(pipelines.predictive(s), folder, NEW)
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    regression = tables["forecast_regressao_custo_km"].select(
        F.lit("regressao").alias("tabela"), F.concat_ws("/", "mes", "ano").alias("chave"),
        F.col("custo_por_km_previsto").alias("valor"),
    )
    fitted = [tables[n] for n in ("forecast_arima_custo_km", "forecast_media_movel") if n in tables]
    arima = reduce(DataFrame.unionByName, fitted).select(
        F.lit("serie").alias("tabela"), F.col("periodo").cast("string").alias("chave"),
        F.col("valor_previsto").alias("valor"),
    )
    line = tables["forecast_tendencia_tipo"].select(
        F.lit("tendencia").alias("tabela"), F.concat_ws(" ", "tipo_veiculo", "tendencia").alias("chave"),
        F.col("custo_projecao_6m").alias("valor"),
    )
    return regression.unionByName(arima).unionByName(line)


# --- prescriptive -----------------------------------------------------------------

def _kpis(spark, sf):
    return prescriptive.vehicle_kpis(*feeds.load_star(spark, sf, "fato_frota", V, E).values())


@query("presc_classify")
def presc_classify(spark, sf):
    names = [*prescriptive.KPIS, "custo_total"]
    return prescriptive.classify(_kpis(spark, sf), names=names).select(
        "id_veiculo", "sigla_estado", "idade_veiculo", "kpi", "valor_atual", "limite", "classificacao"
    )


@query("presc_action_lookup")
def presc_action_lookup(spark, sf):
    long = prescriptive.classify(_kpis(spark, sf))
    return long.groupBy("kpi", "classificacao", prescriptive.recommended_action().alias("acao")).agg(count())


@query("presc_alerts")
def presc_alerts(spark, sf):
    return prescriptive.alerts(_kpis(spark, sf))


@query("presc_age_recommendation")
def presc_age_recommendation(spark, sf):
    """Advice by age over the whole fact, with ages moved down by 3 so some are below 0."""
    fato = feeds.fato(spark, sf).withColumn("idade", F.col("idade_veiculo") - 3)
    return fato.groupBy("idade", prescriptive.age_advice("idade").alias("recomendacao")).agg(count())


@query("presc_decisions")
def presc_decisions(spark, sf):
    return prescriptive.in_priority_order(prescriptive.decisions(_kpis(spark, sf)))


@query("presc_resumo")
def presc_resumo(spark, sf):
    return prescriptive.summary(_kpis(spark, sf))


@query("presc_top_n")
def presc_top_n(spark, sf):
    return prescriptive.top_decisions(prescriptive.decisions(_kpis(spark, sf)))


@query("presc_top_n_alertas")
def presc_top_n_alertas(spark, sf):
    return prescriptive.top_critical_alerts(prescriptive.alerts(_kpis(spark, sf)))


@query("presc_pipeline")
def presc_pipeline(spark, sf):
    """The prescriptive layer written out and read back: rows and alerts per table and class."""
    s = feeds.load_star(spark, sf)
    rules = pipelines.prescriptive_tables(s)
    folder = new_work_dir(spark, "prescriptive")
    paths = writers.write_results({k: rules[k] for k in ("alertas", "decisoes")}, folder, NEW)
    alert_rows = spark.read.parquet(paths["alertas"]).groupBy(F.col("classificacao").alias("classe")).agg(
        count(), F.sum("limite").cast("double").alias("soma"))
    decided = spark.read.parquet(paths["decisoes"]).groupBy(F.col("decisao").alias("classe")).agg(
        count(), F.sum("num_alertas").cast("double").alias("soma"))
    return alert_rows.unionByName(decided)


# --- dashboard --------------------------------------------------------------------

def _high_cost(spark, sf):
    return views.vw_veiculos_alto_custo(*feeds.load_star(spark, sf, "fato_frota", V, E).values())


@query("dash_decision_counts")
def dash_decision_counts(spark, sf):
    return marts.decision_counts(prescriptive.decisions(_kpis(spark, sf)))


@query("dash_alto_custo_count")
def dash_alto_custo_count(spark, sf):
    return marts.high_cost_count(_high_cost(spark, sf))


@query("dash_g7")
def dash_g7(spark, sf):
    s = feeds.load_star(spark, sf, "fato_frota", E)
    return marts.states_by_cost(views.vw_kpi_estado(*s.values()))


@query("dash_g8")
def dash_g8(spark, sf):
    s = feeds.load_star(spark, sf, "fato_frota", V, E)
    return marts.lowest_margins(views.vw_ranking_margem(*s.values()))


@query("dash_g11")
def dash_g11(spark, sf):
    return marts.dearest_vehicles(_high_cost(spark, sf))


@query("dash_g13")
def dash_g13(spark, sf):
    return marts.decisions_by_type(prescriptive.decisions(_kpis(spark, sf)))


@query("dash_g14")
def dash_g14(spark, sf):
    return marts.alerts_by_kpi(prescriptive.alerts(_kpis(spark, sf)))


@query("dash_g15")
def dash_g15(spark, sf):
    fato = feeds.fato(spark, sf)
    future = forecast.forecast_regression(forecast.fit_regression(forecast.monthly_series(fato)))
    return marts.history_and_forecast(views.vw_resumo_mensal(fato), future)


@query("dash_g16")
def dash_g16(spark, sf):
    return marts.trend_by_type(forecast.trend(_series(spark, sf, ["tipo_veiculo"])))


@query("dash_tbl1")
def dash_tbl1(spark, sf):
    return marts.priority_table(prescriptive.decisions(_kpis(spark, sf)))
