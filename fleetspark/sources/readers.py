"""Feed readers: header CSV with declared schemas, the newest snapshot of a feed, indicator JSON."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .. import reference_data as ref
from .. import schemas
from ..functions.columns import to_number

MISSING = "N/A"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV, UTF-8; ``N/A`` is a missing value.

    Columns are found by header, in any order. Declared ones get their type (NULL where a text
    is no number, an error where a number does not fit), others stay text, and a declared column the
    files lack stays out, which is how a national feed shows that it has no state. Nothing is inferred
    from the rows. The part files of a snapshot share one header: a file with another one is an error
    when it is read.
    """
    # with its header enforced, a file whose columns stand in another order fails instead of being misread
    raw = spark.read.options(header=True, nullValue=MISSING, encoding="UTF-8", enforceSchema=False).csv(path)
    declared = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(schema)}

    def typed(name: str) -> Column:
        c, type_ = F.col(f"`{name}`"), declared.get(name, "string")
        return c if type_ == "string" else to_number(c, type_).alias(name)

    return raw.select(*(typed(name) for name in raw.columns))


def with_ordinal(df: DataFrame, name: str = "_ordem") -> DataFrame:
    """Add the place of a row in the feed: file, block in the file, row in the block."""
    place = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    return df.withColumn(name, place)


# --- newest snapshot --------------------------------------------------------------

def list_snapshots(spark: SparkSession, folder: str, prefix: str) -> list[tuple[str, str]]:
    """Date and path of the snapshots ``<prefix>..._<yyyymmdd>`` (a file or a folder of part files).

    The names matching in this one folder are listed, nothing below them; file contents are not read.
    """
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder, f"{prefix}*_????????*")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place) or []
    found = []
    for file in files:
        name = re.fullmatch(r".*_(\d{8})(?:\.[A-Za-z.]+)?", file.getPath().getName())
        if name:
            found.append((name[1], file.getPath().toString()))
    return sorted(found)


def latest_snapshot(spark: SparkSession, folder: str, prefix: str) -> str:
    """Path of the newest snapshot; fails when there is none."""
    found = list_snapshots(spark, folder, prefix)
    if not found:
        raise FileNotFoundError(f"no snapshot {prefix}_<yyyymmdd> in {folder}")
    return found[-1][1]


def read_latest_parquet(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    return spark.read.parquet(latest_snapshot(spark, folder, prefix))


def read_staging(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The two staging tables the star is built from; fails when either is missing."""
    return {
        name: read_latest_parquet(spark, folder, name)
        for name in ("frota_enriquecida", "veiculos_clean")
    }


def read_results(spark: SparkSession, folder: str, prefix: str, schema: str) -> DataFrame:
    """Newest result table of a name (Parquet), or an empty one before the first run."""
    try:
        return read_latest_parquet(spark, folder, prefix)
    except FileNotFoundError:
        return spark.createDataFrame([], schema)


# --- feeds ------------------------------------------------------------------------

# File prefix and schema of each raw feed.
FEEDS = {
    "prices": ("anp_combustivel", schemas.PRICES_RAW),
    "indicators": ("ibge_indicadores", schemas.INDICATORS_RAW),
    "registered_fleet": ("denatran_frota", schemas.FLEET_RAW),
    "vehicles": ("frota_veiculos", schemas.VEHICLES_RAW),
    "operations": ("frota_operacoes", schemas.OPERATIONS_RAW),
}


def read_feed(spark: SparkSession, feed: str, folder: str, path: str | None = None) -> DataFrame:
    """A raw feed from ``path``, or its newest snapshot in ``folder``. Vehicles carry their place
    in the feed as ``_ordem``, which decides between copies."""
    prefix, schema = FEEDS[feed]
    rows = read_csv(spark, path or latest_snapshot(spark, folder, prefix), schema)
    return with_ordinal(rows) if feed == "vehicles" else rows


# --- indicator payload ------------------------------------------------------------

def read_indicator_json(spark: SparkSession, path: str) -> DataFrame:
    """Payload files, each a JSON list; one row per list element."""
    return spark.read.schema(schemas.INDICATOR_PAYLOAD).json(path, multiLine=True)


def parse_payload(text: Column | str) -> Column:
    """Payload text (a JSON list) as an array of elements."""
    return F.from_json(text, f"array<struct<{schemas.INDICATOR_PAYLOAD.replace('resultados array', 'resultados: array', 1)}>>")


def flatten_indicator(
    payload: DataFrame, keep: Sequence[str] = (), by_state: bool = False,
) -> DataFrame:
    """Long rows (period, value, locality) of payload elements.

    ``...`` and other text that is no number become NULL; rows stay. ``by_state`` names the
    locality ``uf_id, uf_nome`` instead of ``localidade_id, localidade_nome``.
    """
    place = "uf" if by_state else "localidade"
    keep = list(keep)
    return (
        payload.select(*keep, F.explode("resultados").alias("r"))
        .select(*keep, F.explode("r.series").alias("s"))
        .select(
            *keep,
            F.coalesce("s.localidade.id", F.lit("")).alias(f"{place}_id"),
            F.coalesce("s.localidade.nome", F.lit("")).alias(f"{place}_nome"),
            F.explode("s.serie").alias("periodo", "texto"),
        )
        .select(
            *keep, "periodo", to_number("texto", "decimal(24,6)").alias("valor"),
            f"{place}_id", f"{place}_nome",
        )
    )


def indicator_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        ref.INDICATORS, "indicador string, agregado string, classificacao string, descricao string"
    )


def indicator_config(name: str) -> Mapping[str, str]:
    """Entry of one indicator, by name in any case; fails for an unknown one."""
    for indicator, aggregate, classification, text in ref.INDICATORS:
        if indicator == name.upper():
            return {"agregado": aggregate, "classificacao": classification, "descricao": text}
    raise ValueError(f"unknown indicator {name!r}; use {[i[0] for i in ref.INDICATORS]}")


def indicator_rows(payload: DataFrame, name: str, by_state: bool = False) -> DataFrame:
    """Long rows of one indicator's payload with its name and description."""
    text = indicator_config(name)["descricao"]
    named = payload.select(F.lit(name).alias("indicador"), F.lit(text).alias("descricao"), "resultados")
    return flatten_indicator(named, ["indicador", "descricao"], by_state)


def lookup_indicators(rows: DataFrame, catalog: DataFrame, fail: bool = True) -> DataFrame:
    """Join rows with their catalog entry by upper-cased name.

    With ``fail`` an unknown name stops the job when its row is read; without it the row keeps
    an empty entry. The catalog is a handful of fixed rows.
    """
    key = F.upper("indicador")
    entries = catalog.withColumnRenamed("indicador", "_nome")
    joined = rows.join(entries, key == F.col("_nome"), "left")
    if fail:
        message = F.concat(F.lit("unknown indicator: "), F.coalesce("indicador", F.lit("NULL")))
        checked = F.when(F.col("_nome").isNull(), F.raise_error(message).cast("string")).otherwise(
            F.col("indicador")
        )
        joined = joined.withColumn("indicador", checked)
    return joined.drop("_nome")


def union_indicators(tables: Sequence[DataFrame]) -> DataFrame:
    """All indicator tables as one, columns matched by name; an empty one adds no rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
