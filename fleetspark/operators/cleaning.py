"""Cleaning of the raw feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import reference_data as ref
from ..functions.columns import strip, to_date_br, to_number, upper_strip
from ..session import stored

# Wider than the star's types: a valid number is kept here, and one that a table type cannot hold fails
# when it is loaded there.
MONEY = "decimal(18,2)"
PRICE = "decimal(18,4)"
COST_COLUMNS = [
    "custo_combustivel", "custo_manutencao", "custo_seguro", "custo_ipva", "custo_depreciacao",
    "receita_estimada",
]


def rename_headers(df: DataFrame, names: Mapping[str, str] = ref.PRICE_HEADERS) -> DataFrame:
    """Rename the headers that are present."""
    return df.withColumnsRenamed(dict(names))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one copy of fully identical rows; copies fold together before the shuffle."""
    return df.dropDuplicates()


#: hashes of repeated rows that are sent to all tasks, 16 MB
FEW_COPIES = 2_000_000


def drop_rare_copies(df: DataFrame, order: str) -> DataFrame:
    """What ``drop_duplicate_rows`` keeps, for a table in which copies are rare: they are found by a hash of
    the row. Only rows that share theirs with another row are shuffled and compared in full; rows that differ and
    share it stay both. The table is written first, as it is read three times, and each file in ``order``;
    one with many copies is compared as a whole."""
    rows = stored(df.withColumn("_hash", F.xxhash64(*df.columns)).sortWithinPartitions(order), "linhas")
    seen = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_hash")
    repeated = stored(seen, "repetidas")
    found = repeated.count()
    if not found:
        return rows.drop("_hash")
    if found > FEW_COPIES:
        return drop_duplicate_rows(rows.drop("_hash"))
    single = rows.join(F.broadcast(repeated), "_hash", "left_anti").drop("_hash")
    return single.unionByName(drop_duplicate_rows(rows.join(F.broadcast(repeated), "_hash", "left_semi").drop("_hash")))


def keep_first_by_key(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """Keep the row of each key that comes first by ``ordinal``.

    Spark limits the ranking window to one row per key in every task before the shuffle, so a key
    that holds a large part of the table reaches its reducer as one row per task. Each task sorts its
    rows by key and ordinal for that (an aggregate by ``min_by`` would sort them too, and carry
    the rows as structs).
    """
    by_key = Window.partitionBy(*keys).orderBy(ordinal)
    return df.withColumn("_rank", F.row_number().over(by_key)).filter("_rank = 1").drop("_rank")


def parse_numbers(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text to numbers, NULL where the text is none; a number that does not fit is an error."""
    return df.withColumns({c: to_number(c, t) for c, t in types.items() if c in df.columns})


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def usable(df: DataFrame, column: str, type_: str) -> DataFrame:
    """Rows whose text in ``column`` is a number. Copies of a row are alike in this, so rows may go before
    copies are looked for and are not shuffled for that."""
    return df.filter(to_number(column, type_).isNotNull())


def upper_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: upper_strip(c) for c in columns if c in df.columns})


def strip_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: strip(c) for c in columns if c in df.columns})


def parse_dates(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, to_date_br(column))


def add_year_month(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns({"ano": F.year(column), "mes": F.month(column)})


def fill_zero(df: DataFrame) -> DataFrame:
    """Missing numbers become 0; missing text stays NULL."""
    return df.fillna(0)


def period_as_text(df: DataFrame, column: str = "periodo") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


def clean_prices(df: DataFrame) -> DataFrame:
    """Fuel prices: one row per station observation with a usable sale price."""
    return (
        df.transform(rename_headers)
        .transform(usable, "valor_venda", PRICE)
        .transform(drop_duplicate_rows)
        .transform(parse_numbers, {"valor_venda": PRICE, "valor_compra": PRICE})
        .transform(upper_text, ["estado", "produto", "regiao"])
        .transform(parse_dates, "data_coleta")
        .transform(add_year_month, "data_coleta")
    )


def clean_indicators(df: DataFrame) -> DataFrame:
    """Economic indicators, long form, with a usable value; ``estado`` is optional."""
    return (
        df.transform(usable, "valor", "decimal(24,6)")
        .transform(drop_duplicate_rows)
        .transform(parse_numbers, {"valor": "decimal(24,6)"})
        .transform(upper_text, ["estado", "indicador"])
        .transform(period_as_text)
    )


def clean_registered_fleet(df: DataFrame) -> DataFrame:
    """Registered vehicles by year, state and type with a usable quantity."""
    return (
        df.transform(usable, "quantidade", "decimal(18,2)")
        .transform(drop_duplicate_rows)
        .transform(upper_text, ["estado", "tipo_veiculo", "combustivel"])
        .transform(parse_numbers, {"quantidade": "decimal(18,2)"})
    )


def clean_vehicles(df: DataFrame, ordinal: str) -> DataFrame:
    """Vehicle registry: the first row of each vehicle in ingest order wins."""
    return (
        df.transform(keep_first_by_key, ["veiculo_id"], ordinal)
        .drop(ordinal)
        .transform(upper_text, ["estado"])
        .transform(strip_text, ["tipo_veiculo", "marca", "combustivel"])
        .transform(parse_numbers, {"km_atual": "int", "consumo_medio_km_l": "decimal(18,2)"})
    )


def clean_operations(df: DataFrame, rare_copies: bool = False) -> DataFrame:
    """Operations: copies removed, costs and revenue as numbers, missing numbers 0. With ``rare_copies`` by
    ``drop_rare_copies``, which writes working tables in order of the year."""
    rows = drop_rare_copies(df, "ano") if rare_copies else drop_duplicate_rows(df)
    return (
        rows
        .transform(parse_numbers, dict.fromkeys(COST_COLUMNS, MONEY))
        .transform(fill_zero)
        .transform(upper_text, ["estado"])
    )
