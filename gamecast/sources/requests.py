"""Request files (A4) and prediction files (A5).

A request file has five lines: home abbreviation, away abbreviation, home
roster, away roster (comma separated, apostrophes written as \\'), and the
date "Y-M-D" (month 0-based when written by the web form). A directory of
such files is a table of requests; one file per request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import escape_name, parse_ymd, round_half_up, split_roster, unescape_name


def _request_id_from_path(path: Column) -> Column:
    """`request_id=<n>` in the file's path, else a 64-bit hash of the path."""
    found = F.regexp_extract(path, r"request_id=(-?\d+)", 1)
    return F.when(found != "", found.cast("bigint")).otherwise(F.xxhash64(path))


RS = "\x1e"                    # the record separator character begins a record's first line in a bundle, and no other line
RECORD_MARK = f"\n{RS}#"       # between the records of a bundle, each of which begins with RS, "#<request_id>" and a line break
BAD_SINGLE = "a file of one request holds a line that begins with the record mark"


def _stuffed(text: Column) -> Column:
    """Lines that begin with RS get one more, so that no line of a request can look like a record's begin."""
    return F.substring(F.regexp_replace(F.concat(F.lit("\n"), text), f"\n{RS}", f"\n{RS}{RS}"), 2, 1 << 30)


def _unstuffed(text: Column) -> Column:
    return F.substring(F.regexp_replace(F.concat(F.lit("\n"), text), f"\n{RS}{RS}", f"\n{RS}"), 2, 1 << 30)


def framed(request_id: Column, text: Column) -> Column:
    """A bundle's record."""
    return F.concat(F.lit(f"{RS}#"), request_id.cast("string"), F.lit("\n"), _stuffed(text))


def _records(raw: DataFrame, least_lines: int) -> DataFrame:
    """Text rows split at `RECORD_MARK` -> (request_id, source, body), one row per request.

    Two layouts: a single request per file (the web form's file; the id comes
    from a `request_id=<n>` folder or a hash of the path), or a bundle: records
    (`framed`), many per file. A file is a bundle if its first record shows the
    mark; the others of it have lost it. A file of one request may hold any
    line, such as one that begins with `#`, but for one that begins with the
    mark itself, which is refused. Bundles written before there was a mark
    begin with a line `#<digits>` and have at least `least_lines` lines with
    it, which no file of one request has; they are read too, each in one piece.
    """
    rows = raw.select(F.translate("value", "\r", "").alias("value"), F.col("_metadata.file_path").alias("source"))
    marked = F.col("value").startswith(f"{RS}#")
    files = rows.groupBy("source").agg(F.max(marked).alias("_bundle"), F.count(F.lit(1)).alias("_rows"))
    # one row per file of several records: few, where files of one request may be many, so that no text is shuffled by its file
    files = files.where("_bundle or _rows > 1")
    old = F.col("value").rlike(r"^#-?\d+\n") & (F.size(F.split(F.rtrim(F.col("value"), F.lit("\n")), "\n")) >= least_lines)
    x = (rows.join(F.broadcast(files), "source", "left")
         .withColumns({"_bundle": F.coalesce("_bundle", F.lit(False)), "_rows": F.coalesce("_rows", F.lit(1))})
         .withColumn("_old", ~F.col("_bundle") & old))
    one = F.when(F.col("_rows") > 1, F.raise_error(F.lit(BAD_SINGLE))).otherwise(F.col("value"))
    recs = (F.when(F.col("_bundle"), F.array(F.regexp_replace("value", f"^{RS}#", "")))
            .when(F.col("_old"), F.split(F.substring("value", 2, 1 << 30), "\n#")).otherwise(F.array(one)))
    x = x.select("source", "_bundle", "_old", F.explode(recs).alias("_rec"))
    has_id, head = F.col("_bundle") | F.col("_old"), F.substring_index("_rec", "\n", 1)
    rest = F.expr("substr(_rec, length(substring_index(_rec, '\n', 1)) + 2)")
    return x.select(
        F.when(has_id, F.trim(head).cast("bigint")).otherwise(_request_id_from_path(F.col("source"))).alias("request_id"),
        "source", F.when(F.col("_bundle"), _unstuffed(rest)).when(F.col("_old"), rest).otherwise(F.col("_rec")).alias("body"))


def _read_text(spark: SparkSession, path: str) -> DataFrame:
    """Records, not files: Spark splits a large bundle over many tasks."""
    return (spark.read.option("recursiveFileLookup", "true").option("lineSep", RECORD_MARK).text(path)
            .select("value", "_metadata"))


def parse_requests(raw: DataFrame, zero_based_month: bool = True) -> DataFrame:
    """Parse text rows split at `RECORD_MARK` (`value`, `_metadata`) into (request_id,
    source, home_abbr, away_abbr, rdate, home_roster, away_roster)."""
    r = _records(raw, least_lines=6)
    lines = F.split("body", "\n")
    line = lambda i: F.coalesce(F.get(lines, i), F.lit(""))
    return r.select(
        "request_id", "source",
        F.trim(line(0)).alias("home_abbr"), F.trim(line(1)).alias("away_abbr"),
        parse_ymd(line(4), zero_based_month).cast("timestamp_ntz").alias("rdate"),
        split_roster(line(2)).alias("home_roster"), split_roster(line(3)).alias("away_roster"))


def read_requests(spark: SparkSession, path: str, zero_based_month: bool = True) -> DataFrame:
    """A4: a directory of request files (single or bundled) -> parsed requests."""
    return parse_requests(_read_text(spark, path), zero_based_month)


def requests_table(parsed: DataFrame) -> DataFrame:
    return parsed.select("request_id", "rdate", "home_abbr", "away_abbr")


def roster_table(parsed: DataFrame) -> DataFrame:
    """(request_id, side, player), distinct per side."""
    sides = parsed.select("request_id", F.explode(F.array(
        F.struct(F.lit("home").alias("side"), F.col("home_roster").alias("names")),
        F.struct(F.lit("away").alias("side"), F.col("away_roster").alias("names")))).alias("s"))
    return (sides.select("request_id", "s.side", F.explode("s.names").alias("player"))
            .dropDuplicates(["request_id", "side", "player"]))


def render_requests(requests: DataFrame, roster: DataFrame, zero_based_month: bool = True) -> DataFrame:
    """(request_id, text): the five-line request file of every request."""
    names = lambda side: F.array_join(F.array_sort(F.collect_list(
        F.when(F.col("side") == side, escape_name("player")))), ",")
    # One group per request, bounded by the request's roster.
    lists = roster.groupBy("request_id").agg(names("home").alias("home"), names("away").alias("away"))
    month = F.month("rdate") - F.lit(1 if zero_based_month else 0)
    day_text = F.format_string("%d-%d-%d", F.year("rdate"), month, F.dayofmonth("rdate"))
    r = requests.join(lists, "request_id", "left")
    text = F.concat_ws("\n", "home_abbr", "away_abbr", F.coalesce("home", F.lit("")),
                       F.coalesce("away", F.lit("")), day_text)
    return r.select("request_id", text.alias("text"))


def write_requests(rendered: DataFrame, path: str, mode: str = "overwrite",
                   layout: str = "bundle", max_per_file: int = 100_000) -> None:
    """layout="single": one file per request under `path/request_id=<n>/`
    (the web form's format; fine for a handful of requests). layout="bundle":
    records (`framed`: the id, then the five lines), up to `max_per_file` per
    file; the file count follows the partitions, not the requests."""
    if layout == "single":
        (rendered.repartition("request_id").write.mode(mode)
         .partitionBy("request_id").text(path))
        return
    (rendered.select(framed(F.col("request_id"), F.col("text")).alias("value")).write.mode(mode)
     .option("maxRecordsPerFile", str(max_per_file)).text(path))


NO_SIDES = "a prediction record has no blank line between sides: pass the roster that tells them apart"


def _file_lines(spark: SparkSession, path: str) -> DataFrame:
    """(request_id, pos, text, block, cut): lines of prediction records; block 0 is before the first blank line."""
    r = _records(_read_text(spark, path), least_lines=2).select("request_id", F.split("body", "\n").alias("ls"),
                                                 F.col("body").contains("\n\n").alias("cut"))
    r = r.select("request_id", "cut", F.array_position("ls", "").alias("blank"), F.posexplode("ls").alias("pos", "text"))
    return r.where(F.col("text") != "").select(
        "request_id", "cut", "pos", "text",
        F.when(F.col("cut") & (F.col("blank") <= F.col("pos")), 1).otherwise(0).alias("block"))


def _sided(lines: DataFrame, roster: DataFrame) -> DataFrame:
    """`side` of each line by the roster. A name on both rosters is home where it comes first and away where it
    comes again; a name on neither has no side (null)."""
    home, away = (F.max(F.col("side") == s).alias(s) for s in ("home", "away"))
    sides = roster.groupBy("request_id", "player").agg(home, away)
    again = Window.partitionBy("request_id", "player").orderBy("pos")
    j = lines.withColumn("again", F.row_number().over(again) > 1).join(sides, ["request_id", "player"], "left")
    return j.withColumn("side", F.when(F.col("home") & ~(F.col("away") & F.col("again")), "home").when(F.col("away"), "away"))


def _counted(lines: DataFrame, roster: DataFrame) -> DataFrame:
    """`side` of each line by its number: the first lines, as many as the home roster has names, are home."""
    n_home = roster.where("side = 'home'").groupBy("request_id").agg(F.count_distinct("player").alias("n_home"))
    order = Window.partitionBy("request_id").orderBy("pos")           # bounded by the lines of a request
    j = lines.withColumn("n", F.row_number().over(order)).join(n_home, "request_id", "left")
    return j.withColumn("side", F.when(F.col("n") <= F.coalesce("n_home", F.lit(0)), "home").otherwise("away"))


def read_predictions(spark: SparkSession, path: str, roster: DataFrame | None = None, by: str = "name") -> DataFrame:
    """A5: prediction files (single or bundled; per request home lines, then
    away lines; each line `player/prediction`) ->
    (request_id, side, line, player, prediction, pts).

    With `roster` (request_id, side, player) sides are told apart by name (a
    name on neither roster keeps its line, with a null side), or with
    by="count" by number: the first lines, as many as there are names on the
    home roster, are home. Without a roster the blank line between sides tells
    them apart; a record without one is refused then. pts is the prediction
    rounded half up, as the web response shows it.
    """
    if by not in ("name", "count"):
        raise ValueError("by: 'name' or 'count'")
    pred = F.regexp_extract("text", r"/([^/]*)$", 1).try_cast("double")
    lines = _file_lines(spark, path).withColumn(
        "player", unescape_name(F.regexp_extract("text", r"^(.*)/[^/]*$", 1)))
    if roster is None:
        side = (F.when(~F.col("cut"), F.raise_error(F.lit(NO_SIDES)))
                .when(F.col("block") == 0, "home").otherwise("away"))
        lines = lines.withColumn("side", side)
    else:
        lines = (_sided if by == "name" else _counted)(lines, roster)
    order = Window.partitionBy("request_id", "side").orderBy("pos")   # bounded by the lines of one side
    return lines.select("request_id", "side", F.row_number().over(order).alias("line"), "player",
                        pred.alias("prediction"), round_half_up(pred).alias("pts"))


def read_team_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Team prediction files (B2: `abbr/prediction/RMSE/R2`, home then away) ->
    (request_id, side, abbreviation, prediction, rmse, r2); NaN is read as null."""
    parts = F.split("text", "/")
    number = lambda i: F.nanvl(F.get(parts, i).try_cast("double"), F.lit(None).cast("double"))
    order = Window.partitionBy("request_id").orderBy("pos")           # two lines
    lines = _file_lines(spark, path).withColumn("n", F.row_number().over(order))
    return lines.select("request_id", F.when(F.col("n") == 1, "home").otherwise("away").alias("side"),
                        F.get(parts, 0).alias("abbreviation"), number(1).alias("prediction"),
                        number(2).alias("rmse"), number(3).alias("r2"))
