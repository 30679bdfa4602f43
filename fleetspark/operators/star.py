"""Star schema: time, state and vehicle dimensions and the fleet fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import reference_data as ref
from ..functions.columns import kept_cast
from ..functions.keys import dense_number, stored_number
from ..schemas import DIM_VEICULO, STAR_MEASURES
from ..session import stored

FACT_KEYS = ["sk_veiculo", "sk_estado", "sk_tempo"]


def month_key(year: Column | str = "ano", month: Column | str = "mes") -> Column:
    """``yyyymm``."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return as_col(year) * 100 + as_col(month)


def _time_columns(df: DataFrame) -> DataFrame:
    names = F.array(*(F.lit(m) for m in ref.MONTH_NAMES))
    return df.select(
        month_key().cast("int").alias("sk_tempo"),
        F.col("ano").cast("int").alias("ano"),
        F.col("mes").cast("int").alias("mes"),
        (F.floor((F.col("mes") - 1) / 3) + 1).cast("int").alias("trimestre"),
        F.when(F.col("mes") <= 6, 1).otherwise(2).alias("semestre"),
        F.get(names, F.col("mes").cast("int") - 1).alias("nome_mes"),
    )


def dim_tempo(operations: DataFrame) -> DataFrame:
    """Every year seen with every month number seen, also months without data.

    The two sets are folded map-side into one short row (at most 12 months) and exploded.
    """
    seen = operations.agg(F.collect_set("ano").alias("anos"), F.collect_set("mes").alias("meses"))
    return (
        seen.select(F.explode("anos").alias("ano"), "meses")
        .select("ano", F.explode("meses").alias("mes"))
        .transform(_time_columns)
    )


def add_months(df: DataFrame, *names: str) -> DataFrame:
    """Columns of the time dimension that follow from ``sk_tempo``: an aggregate by month needs no join
    for them."""
    mes = (F.col("sk_tempo") % 100).cast("int")
    columns = {
        "ano": F.floor(F.col("sk_tempo") / 100).cast("int"),
        "mes": mes,
        "nome_mes": F.get(F.array(*(F.lit(m) for m in ref.MONTH_NAMES)), mes - 1),
    }
    return df.withColumns({name: columns[name] for name in names})


def region_of(state: Column | str) -> Column:
    pairs = [F.lit(x) for region, ufs in ref.REGIONS.items() for uf in ufs for x in (uf, region)]
    key = F.col(state) if isinstance(state, str) else state
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(ref.UNKNOWN_REGION))


def dim_estado(operations: DataFrame) -> DataFrame:
    """Distinct states numbered in order, with their region. The operations are read once."""
    states = stored(operations.select(F.col("estado").alias("sigla_estado")).dropna().distinct(), "estados")
    # blocks by first letter: numbers follow the order, and untidy input meets in no single task
    numbered = dense_number(states, "sk_estado", ["sigla_estado"], F.ascii("sigla_estado"), blocks=1)
    return numbered.select(
        F.col("sk_estado").cast("int").alias("sk_estado"), "sigla_estado",
        region_of("sigla_estado").alias("regiao"),
    )


def vehicle_key(vehicle: Column | str) -> Column:
    """A 64-bit key that follows from the id alone, so no table is needed to find it; NULL for no id."""
    as_col = F.col(vehicle) if isinstance(vehicle, str) else vehicle
    return F.when(as_col.isNotNull(), F.xxhash64(as_col))


def dim_veiculo(
    vehicles: DataFrame, block: Column | None = None, blocks: int = 1024, hashed: bool = False,
) -> DataFrame:
    """Vehicle dimension; columns missing in the source are left out.

    Its key is dense, 1..n, for registries that are small beside the fact: the registry is written once and
    numbered from there. With ``hashed`` it is ``vehicle_key``: one pass, no shuffle, the same key in every run and for
    every registry; ``key_collisions`` tells whether two ids share one.
    """
    renamed = vehicles.withColumnRenamed("veiculo_id", "id_veiculo")
    typed = renamed.select(
        *(F.col(c).cast(t).alias(c) for c, t in DIM_VEICULO.items() if c in renamed.columns)
    )
    if hashed:
        return typed.select(vehicle_key("id_veiculo").alias("sk_veiculo"), *typed.columns)
    typed = stored(typed, "veiculos")
    numbered = dense_number(typed, "sk_veiculo", ["id_veiculo"], block, blocks)
    return numbered.select(F.col("sk_veiculo").cast("long").alias("sk_veiculo"), *typed.columns)


def key_collisions(dim: DataFrame, key: str = "sk_veiculo", id_col: str = "id_veiculo") -> DataFrame:
    """Keys that stand for more than one id: how many, the first and the last of them. Repeated rows of one
    id are no collision; a missing key or id takes no part."""
    pairs = dim.select(key, id_col).dropna().distinct()
    counted = pairs.groupBy(key).agg(
        F.count(F.lit(1)).alias("ids"), F.min(id_col).alias("primeiro_id"), F.max(id_col).alias("ultimo_id"))
    return counted.filter(F.col("ids") > 1)


def add_fact_keys(
    enriched: DataFrame, tempo: DataFrame, estado: DataFrame, veiculo: DataFrame,
) -> DataFrame:
    """Look up the three keys; rows without all of them are dropped.

    Months match on numbers, so every month finds its key. The dimensions are read from their
    written tables, so the planner knows their size and broadcasts the small ones; hot keys of the
    others are split by AQE.
    """
    months = tempo.select("sk_tempo", "ano", "mes")
    states = estado.select("sk_estado", F.col("sigla_estado").alias("estado"))
    ids = veiculo.select("sk_veiculo", F.col("id_veiculo").alias("veiculo_id"))
    return (
        enriched.join(months, ["ano", "mes"])
        .join(states, "estado")
        .join(ids, "veiculo_id")
    )


def project_fact(df: DataFrame) -> DataFrame:
    """Keys and the available measures in their table types."""
    return df.select(
        *(F.col(k) for k in FACT_KEYS),
        *(kept_cast(c, t).alias(c) for c, t in STAR_MEASURES.items() if c in df.columns),
    )


def add_fact_number(fact: DataFrame, blocks: int = 1024) -> DataFrame:
    """``sk_fato_frota`` = 1..n, following the months. The fact is written first and numbered where its
    rows lie (``stored_number``), so nothing is derived twice or shuffled. ``blocks`` has no meaning any more."""
    return stored_number(fact, "sk_fato_frota", "sk_tempo", "fato").select("sk_fato_frota", *fact.columns)


def fato_frota(
    enriched: DataFrame, tempo: DataFrame, estado: DataFrame, veiculo: DataFrame, blocks: int = 1024,
) -> DataFrame:
    return (
        enriched.transform(add_fact_keys, tempo, estado, veiculo)
        .transform(project_fact)
        .transform(add_fact_number, blocks)
    )


def frota_wide(fato: DataFrame, estado: DataFrame, veiculo: DataFrame) -> DataFrame:
    """The fact with the dimension columns that downstream users read; those of the month follow from its
    key."""
    measures = [c for c in STAR_MEASURES if c in fato.columns]
    return (
        fato.select(*FACT_KEYS, *measures)
        .join(estado, "sk_estado")
        .join(
            veiculo.select("sk_veiculo", "tipo_veiculo", "id_veiculo", "marca", "consumo_medio_km_l"),
            "sk_veiculo",
        )
        .transform(add_months, "ano", "mes", "nome_mes")
        .select(
            *measures, *FACT_KEYS, "tipo_veiculo", "id_veiculo", "marca", "consumo_medio_km_l",
            "sigla_estado", "regiao", "ano", "mes", "nome_mes",
        )
    )
