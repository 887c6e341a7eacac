"""L1: score request files as they arrive.

Request files land in a directory; each micro-batch is parsed (A4), scored
and written as prediction files (B1) under `out_dir/batch_id=<n>/`. The writer
overwrites its own batch folder, so a batch replayed after a failure produces
the same files (exactly-once at the file level, with the checkpoint tracking
inputs). P1 and P2 models do not depend on a request: they are fitted before
the stream starts, written once, and a micro-batch only joins them. P3 is
fitted per request and reads the games in every batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans import pipelines as PL
from ..session import materialize
from ..sources.requests import RECORD_MARK, parse_requests, requests_table, roster_table
from ..sources.sinks import write_predictions
from .models import latest_models

MODELS = {"quick": PL.quick_models, "best": PL.best_models}


def score_request_stream(spark: SparkSession, in_dir: str, games: DataFrame | None, out_dir: str, checkpoint: str,
                         pipeline: str = "quick", models: DataFrame | None = None,
                         zero_based_month: bool = True, available_now: bool = True,
                         per_side: int | None = None, max_files_per_trigger: int | None = None,
                         models_dir: str | None = None):
    """Start the stream; returns the StreamingQuery (call awaitTermination()).

    `checkpoint`: the stream's own folder in shared storage. A restart with it
    goes on where the stream stopped; no other stream may use it.
    `models`: a stored table of player models (`quick_models`, `best_models`);
    without it, `pipeline` ("quick" or "best") fits one from `games` first.
    `models_dir`: where `refresh_models_stream` keeps P1's models; each
    micro-batch then scores with the newest ones.
    pipeline="context" needs `games` and takes no models.
    """
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder of its own")
    if pipeline == "context":
        if games is None or models is not None:
            raise ValueError("the context pipeline fits per request: it needs games and takes no models")
    elif models is None and models_dir is None:
        models = materialize(MODELS[pipeline](games), "stream-models")
    reader = (spark.readStream.format("text").option("lineSep", RECORD_MARK)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(in_dir).select("value", "_metadata")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_requests(batch, zero_based_month).persist()
        try:
            roster = roster_table(parsed)
            current = latest_models(spark, models_dir) if models_dir else models
            preds = (PL.attach_models(current, roster) if current is not None
                     else PL.predict_players_context(games, requests_table(parsed), roster))
            write_predictions(preds, f"{out_dir.rstrip('/')}/batch_id={batch_id}", per_side=per_side)
        finally:
            parsed.unpersist()

    writer = raw.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
