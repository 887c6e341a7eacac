"""Writers (B1-B4): prediction files, team prediction files, series dumps, JSON responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import round_half_up
from .requests import framed


def _per_request_text(lines: DataFrame, blank_line: bool) -> DataFrame:
    """(request_id, side, line, text) -> (request_id, value): home lines first.

    One group per request, bounded by its lines.
    """
    ordered = F.array_sort(F.collect_list(F.struct(
        F.when(F.col("side") == "home", 0).otherwise(1).alias("s"), F.col("line"), F.col("text"))))
    g = lines.groupBy("request_id").agg(ordered.alias("ls"))
    home = F.transform(F.filter("ls", lambda e: e["s"] == 0), lambda e: e["text"])
    away = F.transform(F.filter("ls", lambda e: e["s"] == 1), lambda e: e["text"])
    sep = "\n\n" if blank_line else "\n"
    return g.select("request_id", F.concat(F.array_join(home, "\n"), F.lit(sep),
                                           F.array_join(away, "\n")).alias("value"))


def _ranked(preds: DataFrame, per_side: int | None, by: str) -> DataFrame:
    """Lines numbered per side by name; with `per_side`, only that many."""
    from ..plans.pipelines import top_per_side
    if per_side is not None:
        return top_per_side(preds, per_side, by)
    w = Window.partitionBy("request_id", "side").orderBy(by)
    return preds.withColumn("line", F.row_number().over(w))


def _write(out: DataFrame, path: str, mode: str, layout: str, max_per_file: int = 100_000) -> None:
    if layout == "single":
        out.repartition("request_id").write.mode(mode).partitionBy("request_id").text(path)
        return
    out.select(framed(F.col("request_id"), F.col("value")).alias("value")).write.mode(mode).option("maxRecordsPerFile", str(max_per_file)).text(path)


def write_predictions(preds: DataFrame, path: str, per_side: int | None = None, blank_line: bool = True,
                      mode: str = "overwrite", layout: str = "bundle") -> None:
    """B1: per request, `player/prediction` lines by player name, home side
    first, a blank line between sides (or none: then only a roster tells a
    reader the sides). `per_side` (20 in the surveyed files) caps a side.
    layout="single": one file per request; "bundle": records (`requests.framed`)."""
    lines = _ranked(preds, per_side, "player").select(
        "request_id", "side", "line",
        F.concat_ws("/", "player", F.col("prediction").cast("string")).alias("text"))
    _write(_per_request_text(lines, blank_line), path, mode, layout)


def write_team_predictions(preds: DataFrame, path: str, mode: str = "overwrite",
                           layout: str = "bundle") -> None:
    """B2: `abbr/prediction/RMSE/R2`, home then away, one file per request."""
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NaN"))
    lines = preds.select("request_id", "side", F.lit(1).alias("line"),
                         F.concat_ws("/", "abbreviation", s("prediction"), s("rmse"), s("r2")).alias("text"))
    _write(_per_request_text(lines, blank_line=False), path, mode, layout)


def write_series(history: DataFrame, path: str, keys: tuple[str, ...] = ("request_id", "player"),
                 value: str = "pts", index: str = "idx", mode: str = "overwrite") -> None:
    """The series under each side: `side=<side>/` folders of lines
    `<keys>/<game number>/<value>`, in series order within a file's part.
    A `/` in a key is written as %2F."""
    text = [F.regexp_replace(F.col(c).cast("string"), "/", "%2F") for c in keys]
    order = ["side", *keys, index]
    (history.repartition("side", *keys).sortWithinPartitions(*order)
     .select("side", F.concat_ws("/", *text, F.col(index).cast("string"), F.col(value).cast("string")).alias("value"))
     .write.mode(mode).partitionBy("side").text(path))


def read_series(spark: SparkSession, path: str, keys: tuple[str, ...] = ("request_id", "player"),
                value: str = "pts", index: str = "idx") -> DataFrame:
    """A series dump (`write_series`) as a table: keys as text, bigint index, double value."""
    parts, n = F.split("value", "/"), len(keys)
    return spark.read.text(path).select(
        "side", *[F.regexp_replace(F.get(parts, i), "%2F", "/").alias(c) for i, c in enumerate(keys)],
        F.get(parts, n).cast("bigint").alias(index), F.get(parts, n + 1).cast("double").alias(value))


def to_response(preds: DataFrame, by: str = "player") -> DataFrame:
    """(request_id, response) with the JSON the web client receives:
    {success, msg, local: [{player, pts}], visit: [{player, pts}]}, pts
    rounded half up, each list sorted by player."""
    item = F.struct(F.col(by).alias("player"), round_half_up("prediction").alias("pts"))
    g = preds.groupBy("request_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("side") == "home", item))).alias("local"),
        F.array_sort(F.collect_list(F.when(F.col("side") == "away", item))).alias("visit"))
    body = F.struct(F.lit(True).alias("success"), F.lit("").alias("msg"), "local", "visit")
    return g.select("request_id", F.to_json(body).alias("response"))
