"""Streaming form of the fold and scoring.

The fold (C) and the feature flattening (D) are row-local projections, so
they run unchanged on a streaming DataFrame: each new JSONL file of match
logs is folded, flattened and scored by a fitted ``PipelineModel`` as it
arrives.  Output goes through ``foreachBatch`` to the prediction CSV sink,
one folder per micro-batch, with the query's checkpoint in the shared
folder (exactly-once file output per batch id).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import evaluate as EV
from ..operators import features as FT
from ..operators import timeline as TL
from ..operators.models import positive_probability
from ..session import scratch_path


def stream_match_states(spark: SparkSession, in_dir: str, max_files_per_trigger: int = 1
                        ) -> DataFrame:
    """Streaming fold: new JSONL files -> match states (rejects removed)."""
    logs = (spark.readStream.schema(S.MATCH_LOG).option("maxFilesPerTrigger", max_files_per_trigger)
            .json(in_dir))
    state = TL.fold_match_logs(logs, is_train=False)
    return state.where(F.col("reject_reason").isNull()).drop("reject_reason")


def start_scoring(spark: SparkSession, in_dir: str, model: PipelineModel, out_dir: str,
                  prob_col: str = "lr_probability", threshold: float = S.LINEAR_THRESHOLD,
                  checkpoint: str | None = None, once: bool = True):
    """Start the streaming scorer; returns the ``StreamingQuery``."""
    feats = FT.match_features(stream_match_states(spark, in_dir))
    scored = model.transform(feats)
    p = positive_probability(prob_col)
    out = scored.select("battle_id", p.alias("probability"),
                        EV.predict_at(p, threshold).alias("prediction"))

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.col("battle_id").cast("long").alias("battle_id"),
                      F.col("prediction").cast("int").alias("player_won"))
         .write.mode("overwrite").option("header", True).csv(f"{out_dir}/batch={batch_id}"))

    w = (out.writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt")))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="10 seconds")
    return w.start()
