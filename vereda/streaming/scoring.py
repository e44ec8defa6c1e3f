"""New points of a series scored with the forest that is stored for it."""

from pyspark.sql import DataFrame

from vereda import presets
from vereda.operators.forest import score_forest
from vereda.plans.anomalies import SERIES, fill_zero
from vereda.session import park
from vereda.sinks import files
from vereda.streaming.publish import BATCH

SCORE = "_score"


def score_points(points: DataFrame, models_path: str) -> DataFrame:
    """Points with ``_score`` by the stored forest of their series, null where there is none.

    The forests are those a batch run has stored, so a point gets the score it had there. Forests
    of series without new points are left out by the join.
    """
    features = [f"_{name}" for name in presets.FEATURES]
    ready = park(fill_zero(points), "arrivals")
    forest = files.load_forest(points.sparkSession, models_path).drop("modelo", "balde")
    return score_forest(ready, forest, SERIES, features, SCORE).drop(*features)


def score_stream(points: DataFrame, models_path: str, path: str, checkpoint: str, bounded=False):
    """Score a stream of points, a folder ``lote=`` below ``path`` for every batch.

    A batch that is repeated after a failure replaces its folder, so each point is there once.
    The forests are read for each batch, so a newer version is used from the next batch on.
    """
    def store(batch, number):
        scored = score_points(batch, models_path)
        scored.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    writer = points.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if bounded:
        writer = writer.trigger(availableNow=True)
    return writer.start()
