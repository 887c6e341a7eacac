"""Declared schemas and the two small dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COUNTS = ["pts", "ast", "blk", "drb", "orb", "trb", "stl", "tov", "pf",
           "fg", "fga", "fg3", "fg3a", "ft", "fta"]
_TEXTS = ["fg_pct", "fg3_pct", "ft_pct", "mp"]

LINE_FIELDS = [T.StructField(c, T.IntegerType()) for c in _COUNTS] + [
    T.StructField(c, T.StringType()) for c in _TEXTS]

PLAYER_LINE = T.StructType([T.StructField("player", T.StringType())] + LINE_FIELDS)
TEAM_LINE = T.StructType(list(LINE_FIELDS))

BOX = T.StructType([
    T.StructField("players", T.ArrayType(PLAYER_LINE)),
    T.StructField("team", TEAM_LINE),
    T.StructField("won", T.IntegerType()),
])

TEAM = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("abbreviation", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("home", T.BooleanType()),
    T.StructField("won", T.IntegerType()),
])

# box[i] belongs to teams[i]; the home team may sit at position 0 or 1.
GAME_SCHEMA = T.StructType([
    T.StructField("game_id", T.LongType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("teams", T.ArrayType(TEAM)),
    T.StructField("box", T.ArrayType(BOX)),
])

# The leaves the forecasting pipelines use. Passed as the read schema, Parquet
# reads only these (nested pruning cannot reach fields of structs inside an
# array inside an array, so a narrower read schema is how the scan stays narrow).
CORE_LINE = T.StructType([T.StructField("player", T.StringType()), T.StructField("pts", T.IntegerType())])
GAME_SCHEMA_CORE = T.StructType([
    T.StructField("game_id", T.LongType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("teams", T.ArrayType(TEAM)),
    T.StructField("box", T.ArrayType(T.StructType([
        T.StructField("players", T.ArrayType(CORE_LINE)),
        T.StructField("won", T.IntegerType()),
    ]))),
])

# The 30 teams (abbreviation, name) accepted in requests.
TEAMS = [
    ("BOS", "Boston Celtics"),
    ("NJN", "Brooklyn (New Jersey) Nets"),
    ("NYK", "New York Knicks"),
    ("PHI", "Philadelphia 76ers"),
    ("TOR", "Toronto Raptors"),
    ("CHI", "Chicago Bulls"),
    ("CLE", "Cleveland Cavaliers"),
    ("DET", "Detroit Pistons"),
    ("IND", "Indiana Pacers"),
    ("MIL", "Milwaukee Bucks"),
    ("ATL", "Atlanta Hawks"),
    ("CHA", "Charlotte Hornets"),
    ("MIA", "Miami Heat"),
    ("ORL", "Orlando Magic"),
    ("WAS", "Washington Wizards"),
    ("DEN", "Denver Nuggets"),
    ("MIN", "Minnesota Timberwolves"),
    ("POR", "Portland Trail Blazers"),
    ("OKC", "Oklahoma City Thunder"),
    ("UTA", "Utah Jazz"),
    ("GSW", "Golden State Warriors"),
    ("LAC", "Los Angeles Clippers"),
    ("LAL", "Los Angeles Lakers"),
    ("PHO", "Phoenix Suns"),
    ("SAC", "Sacramento Kings"),
    ("DAL", "Dallas Mavericks"),
    ("HOU", "Houston Rockets"),
    ("MEM", "Memphis Grizzlies"),
    ("NOH", "New Orleans Pelicans"),
    ("SAS", "San Antonio Spurs"),
]

# Seasons offered for search run from 1984-85 to 2012-13.
FIRST_SEASON = 1984
LAST_SEASON = 2012


def teams_dim(spark: SparkSession, teams: list[tuple[str, str]] | None = None) -> DataFrame:
    """`(abbr, name)`; 30 rows by default. Always small enough to broadcast."""
    rows = teams if teams is not None else TEAMS
    df = spark.createDataFrame(rows, "abbr string, name string")
    return df.select("abbr", F.trim("name").alias("name"))


def season_label(season: str | Column) -> Column:
    """"Temporada YY/YY" of a season's start year."""
    y = F.col(season) if isinstance(season, str) else season
    two = lambda c: F.lpad((c % 100).cast("string"), 2, "0")
    return F.concat(F.lit("Temporada "), two(y), F.lit("/"), two(y + 1))


def season_value(season: str | Column) -> Column:
    """"Y1-Y2" of a season's start year."""
    y = F.col(season) if isinstance(season, str) else season
    return F.concat_ws("-", y.cast("string"), (y + 1).cast("string"))


def seasons_dim(spark: SparkSession, first: int = FIRST_SEASON, last: int = LAST_SEASON) -> DataFrame:
    """`(season, label, value)` for seasons first..last, newest first.

    label is "Temporada YY/YY", value is "Y1-Y2"; season is the start year.
    """
    y = F.col("id")
    return (spark.range(first, last + 1)
            .select(y.cast("int").alias("season"),
                    season_label(y).alias("label"), season_value(y).alias("value"))
            .orderBy(F.desc("season")))
