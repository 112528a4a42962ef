"""Stream scoring with the same frozen plan.

Rows arriving as files are read with ``readStream``; each micro-batch is a static DataFrame on
which ``foreachBatch`` runs the frozen preparation (including the kNN donor join, which needs
the training donors) and the ensemble. A batch is written to ``batch_id=<epoch>`` of the sink and
overwrites what an earlier attempt left, so a retried batch counts once. The query is stateless:
no watermark or state store is needed; the checkpoint folder makes it restartable.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from adlytics.plans.prep import FittedPrep
from adlytics.plans.scoring import predict


def score_stream(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, prep: FittedPrep,
                 models: dict[str, PipelineModel], id_col: str, threshold: float = 0.5,
                 max_files_per_trigger: int = 1, available_now: bool = True):
    """Start the streaming scorer; with ``available_now`` it processes what is there and stops."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source)

    def batch(df, epoch_id):
        predict(df, prep, models, id_col, threshold).write.mode("overwrite").parquet(f"{sink}/batch_id={epoch_id}")

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
