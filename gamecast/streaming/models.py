"""L1 with games that arrive: P1's models kept up to date by a stateful stream.

Games land in a folder; the stream unnests them and keeps, per player, the
sums of all points and of the sampled ones (n, Sx, Sy, Sxx, Sxy, Syy each) and
the place of the last point. A micro-batch adds its points and emits the
players it touched, so a model costs its new points and not its history.

A point is taken if it comes after the player's last one in the order of the
series (date, game, box, line). Others, late games and games that come again,
change nothing and are counted (`late`): the series' numbers are those of a
full fit over the games in order, and a file that arrives twice does no harm.
Points without a value take no part.

Each micro-batch overwrites its own folder, so a replay leaves the same rows,
and `latest_models` takes of every player the row with the most points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.fit import P, SUMS, _finish, model_columns
from ..operators.rows import PLAYER_ORDER, player_rows
from ..schema import GAME_SCHEMA_CORE

_SIDES = [f"{c}_{s}" for s in ("a", "s") for c in ("n", *SUMS)]      # of all points, of the sampled ones
STATE = ", ".join(f"{c} long" for c in _SIDES) + ", late long, last string"
UPDATE = "player string, " + ", ".join(f"{c} long" for c in _SIDES) + ", late long"


def _update(threshold: int):
    """Add a player's new points to the sums (runs inside applyInPandasWithState)."""
    p, names, order = P, list(_SIDES), list(PLAYER_ORDER)

    def run(key, frames, state):
        import hashlib
        import json

        import pandas as pd
        (player,) = key
        total = dict(zip([*names, "late", "last"], state.get)) if state.exists else {**dict.fromkeys([*names, "late"], 0), "last": ""}
        last = json.loads(total["last"]) if total["last"] else None
        # the points of one player in one micro-batch; sums are whole numbers
        for row in pd.concat(list(frames)).sort_values(order).itertuples(index=False):
            at = [row.date.value if hasattr(row.date, "value") else str(row.date), int(row.game_id), int(row.bpos), int(row.ppos)]
            if last is not None and at <= last:
                total["late"] += 1
                continue
            x, y, last = total["n_a"], int(row.pts), at
            h = int(hashlib.md5(f"{player}|{x}".encode()).hexdigest()[:8], 16) % p
            for side in ("a", "s") if h < threshold else ("a",):
                for c, v in (("n", 1), ("sx", x), ("sy", y), ("sxx", x * x), ("sxy", x * y), ("syy", y * y)):
                    total[f"{c}_{side}"] += v
        total["last"] = json.dumps(last) if last is not None else ""
        state.update(tuple(total[c] for c in [*names, "late", "last"]))
        yield pd.DataFrame([[player, *(total[c] for c in [*names, "late"])]], columns=["player", *names, "late"])

    return run


def models_of(updates: DataFrame, reg: float = 0.001) -> DataFrame:
    """P1's model (as `fit_split` gives it) and `late` of each row of sums; an empty sample falls back to all points."""
    use = F.col("n_s") > 0
    s = updates.select("player", "late", F.col("n_a").alias("n_all"),
                       *[F.when(use, F.col(f"{c}_s")).otherwise(F.col(f"{c}_a")).alias(c) for c in ("n", *SUMS)])
    m = s.where("n_all > 0").select("player", "late", "n_all", F.col("n").alias("n_fit"), *model_columns(reg, exact=True))
    return _finish(m, ["player"], ["late"])


def refresh_models_stream(spark: SparkSession, games_dir: str, out_dir: str, checkpoint: str, frac: float = 0.7, reg: float = 0.001,
                          format: str = "parquet", available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; returns the StreamingQuery. `checkpoint`: its own folder in shared storage.

    Files must not bring games of one player out of order within what is taken (late ones are counted, see above);
    sums hold up to some 3 million points a player.
    """
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder of its own")
    reader = spark.readStream.schema(GAME_SCHEMA_CORE).format(format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    points = (player_rows(reader.load(games_dir)).where(F.col("pts").isNotNull() & F.col("player").isNotNull())
              .select("player", *PLAYER_ORDER, "pts"))
    sums = points.groupBy("player").applyInPandasWithState(
        _update(int(-(-frac * P // 1))), UPDATE, STATE, "update", GroupStateTimeout.NoTimeout)

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        models_of(batch, reg).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")

    writer = sums.writeStream.outputMode("update").foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def latest_models(spark: SparkSession, out_dir: str) -> DataFrame:
    """The newest model of every player: the one of the most points (then of the most late ones)."""
    rows = spark.read.parquet(out_dir).drop("batch_id")
    cols = [c for c in rows.columns if c != "player"]
    newest = rows.groupBy("player").agg(F.max_by(F.struct(*cols), F.struct("n", "late")).alias("m"))
    return newest.select("player", "m.*")
