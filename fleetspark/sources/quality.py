"""Constraint checks on a star: unique keys, required columns, keys that find their dimension."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored

PRIMARY_KEYS = {
    "dim_tempo": "sk_tempo",
    "dim_estado": "sk_estado",
    "dim_veiculo": "sk_veiculo",
    "fato_frota": "sk_fato_frota",
}
REQUIRED = {
    "dim_tempo": ["sk_tempo", "ano", "mes", "trimestre", "semestre", "nome_mes"],
    "dim_estado": ["sk_estado", "sigla_estado", "regiao"],
    "dim_veiculo": ["sk_veiculo", "id_veiculo", "tipo_veiculo", "marca", "ano_fabricacao", "combustivel"],
    "fato_frota": ["sk_veiculo", "sk_estado", "sk_tempo", "km_rodado"],
}
FOREIGN_KEYS = {"sk_veiculo": "dim_veiculo", "sk_estado": "dim_estado", "sk_tempo": "dim_tempo"}


def _row(df: DataFrame, table: str, check: Column | str, violations: Column) -> DataFrame:
    name = F.lit(check) if isinstance(check, str) else check
    return df.select(
        F.lit(table).alias("tabela"), name.alias("verificacao"),
        F.coalesce(violations, F.lit(0)).cast("long").alias("violacoes"),
    )


def duplicate_keys(df: DataFrame, table: str, key: str, shown: str | None = None) -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("v"))
    return _row(repeated, table, f"pk {shown or key}", F.col("v"))


def repeated_dense_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    """The same for whole-number keys of a large table, most of them next to each other.

    64 neighbours fold into one word, a bit for each value, in the map task already; a word with as many
    rows as bits repeats none of its values. Only the values of the other words are counted one by one, in
    a second look at the key column. NULL is no value.
    """
    values = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("valor"))
    values = values.withColumn("palavra", F.shiftright("valor", 6))
    bit = F.expr("shiftleft(1L, CAST(valor & 63 AS INT))")
    words = values.groupBy("palavra").agg(F.count(F.lit(1)).alias("n"), F.bit_or(bit).alias("bits"))
    uneven = words.filter(F.col("n") != F.bit_count("bits")).select("palavra")
    return duplicate_keys(values.join(uneven, "palavra", "left_semi"), table, "valor", key)


def missing_values(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Number of NULLs per required column, all columns in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    long = counts.select(
        F.explode(F.array(*(F.struct(F.lit(f"not null {c}").alias("c"), F.col(c).alias("v")) for c in columns))).alias("x")
    )
    return _row(long, table, F.col("x.c"), F.col("x.v"))


def fact_values(fato: DataFrame) -> DataFrame:
    """How often each value of the foreign keys and required columns occurs, ``coluna, valor, n``, stored: one
    row per value of a dimension key, so at most the size of the dimensions and their orphans. Of a column
    that is no key only missing (NULL) and present (0) are told apart. Copies of a hot key fold before
    the shuffle."""
    keys = [c for c in FOREIGN_KEYS if c in fato.columns]
    rest = [c for c in REQUIRED["fato_frota"] if c in fato.columns and c not in keys]
    values = [F.struct(F.lit(c).alias("coluna"), F.col(c).cast("long").alias("valor")) for c in keys]
    values += [
        F.struct(F.lit(c).alias("coluna"), F.when(F.col(c).isNotNull(), F.lit(0).cast("long")).alias("valor"))
        for c in rest
    ]
    long = fato.select(F.inline(F.array(*values)))
    return stored(long.groupBy("coluna", "valor").agg(F.count(F.lit(1)).alias("n")), "valores")


def fact_checks(fato: DataFrame, star: Mapping[str, DataFrame]) -> DataFrame:
    """Unique key, required columns and keys without a dimension row of the fact.

    Each column of the fact is read once, the key apart from the others. An empty key is no orphan. The dimensions
    join counted values, so a hot key is one row; the join is a left one with a marker because an anti join would
    be pushed below the count.
    """
    table = "fato_frota"
    primary = PRIMARY_KEYS[table]
    values = fact_values(fato)
    required = [c for c in REQUIRED[table] if c in fato.columns]
    empty = values.groupBy("coluna").agg(F.sum(F.when(F.col("valor").isNull(), F.col("n"))).alias("v"))
    parts = [("not null ", required, empty)]
    dims = {key: star[dim] for key, dim in FOREIGN_KEYS.items() if dim in star and key in fato.columns}
    if dims:
        known = [
            dim.select(F.lit(key).alias("coluna"), F.col(key).cast("long").alias("valor")).distinct()
            for key, dim in dims.items()
        ]
        found = reduce(DataFrame.unionByName, known).withColumn("_known", F.lit(True))
        used = values.filter(F.col("valor").isNotNull() & F.col("coluna").isin(*dims))
        lost = used.join(found, ["coluna", "valor"], "left").groupBy("coluna").agg(
            F.sum(F.when(F.col("_known").isNull(), F.col("n"))).alias("v")
        )
        parts.append(("fk ", list(dims), lost))
    checks = []
    for name, columns, counts in parts:
        expected = values.sparkSession.createDataFrame([(c,) for c in columns], "coluna string")
        checks.append(_row(expected.join(counts, "coluna", "left"), table, F.concat(F.lit(name), "coluna"), F.col("v")))
    if primary in fato.columns:
        checks.append(repeated_dense_keys(fato, table, primary))
    return reduce(DataFrame.unionByName, checks)


def constraint_report(star: Mapping[str, DataFrame]) -> DataFrame:
    """All checks on the tables present: one row per check with its number of violations."""
    checks = []
    for table, df in star.items():
        if table == "fato_frota":
            checks.append(fact_checks(df, star))
            continue
        if PRIMARY_KEYS[table] in df.columns:
            checks.append(duplicate_keys(df, table, PRIMARY_KEYS[table]))
        checks.append(missing_values(df, table, [c for c in REQUIRED[table] if c in df.columns]))
    return reduce(DataFrame.unionByName, checks)
