"""A1: read the game collection with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from ..schema import GAME_SCHEMA, GAME_SCHEMA_CORE


def read_games(spark: SparkSession, path: str, format: str = "parquet", core: bool = False,
               extra: list[str] = (), **options) -> DataFrame:
    """Load games as a DataFrame with `GAME_SCHEMA`.

    Works for any reader format (parquet, json, orc, or a document-store
    connector the user has installed). With `core=True` the read schema is
    `GAME_SCHEMA_CORE` (player lines reduced to player and pts): the scan then
    reads only those leaves of the player lines, which nested pruning alone
    cannot achieve for arrays of structs inside arrays. `player_rows(...,
    stats=True)` needs the full schema. `extra` names whole-number folder
    columns (`name=<n>/`) to read as well.
    """
    schema = GAME_SCHEMA_CORE if core else GAME_SCHEMA
    schema = StructType([*schema.fields, *(StructField(c, IntegerType()) for c in extra)])
    return spark.read.schema(schema).format(format).options(**options).load(path)


def write_games(games: DataFrame, path: str, mode: str = "overwrite") -> None:
    games.write.mode(mode).parquet(path)
