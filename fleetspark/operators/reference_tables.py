"""Reference rows kept beside the star, and their insert-or-replace."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import reference_data as ref

# The limit table holds two rows per KPI, so its key has two columns.
KEYS = {
    "ref_combustivel": ["tipo_combustivel"],
    "ref_faixa_idade": ["faixa"],
    "ref_limites_kpi": ["kpi", "tipo_alerta"],
}


def reference_rows(spark: SparkSession) -> dict[str, DataFrame]:
    """The published reference rows."""
    fuels = spark.createDataFrame(
        ref.FUEL_REFERENCE,
        "tipo_combustivel string, custo_manutencao_por_km string, emissoes_co2_g_km string",
    ).withColumns(
        {
            "custo_manutencao_por_km": F.col("custo_manutencao_por_km").cast("decimal(8,2)"),
            "emissoes_co2_g_km": F.col("emissoes_co2_g_km").cast("decimal(8,1)"),
        }
    )
    ages = spark.createDataFrame(
        ref.AGE_REFERENCE, "faixa string, idade_min int, idade_max int, recomendacao string"
    )
    limit_rows = [
        (kpi, str(limit), alert, action)
        for kpi, *actions in ref.LIMIT_ACTIONS
        for limit, alert, action in zip(ref.LIMITS[kpi][:2], ["CRITICO", "ATENCAO"], actions)
    ]
    limits = spark.createDataFrame(
        limit_rows,
        "kpi string, valor_limite string, tipo_alerta string, acao_recomendada string",
    ).withColumn("valor_limite", F.col("valor_limite").cast("decimal(8,2)"))
    return {"ref_combustivel": fuels, "ref_faixa_idade": ages, "ref_limites_kpi": limits}


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``old`` and ``new`` with the new row where both have the key. ``new`` must hold a key
    once. The old rows whose key is new are left out by a join, so nothing is sorted by key to fold;
    NULL keys are equal to each other."""
    replaced = new.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return old.join(replaced, same, "left_anti").unionByName(new.select(*old.columns))
