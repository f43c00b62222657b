"""foreachBatch function: fit, score and keep one forest per micro-batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from envstream import schemas as S
from envstream.operators.clean import categories
from envstream.operators.metrics import SCORE_PARTS, confusion_counts, score_parts
from envstream.plans.model import SEED, fit_and_score, metrics_for
from envstream.sinks.outputs import show_batch, write_metrics, write_model
from envstream.streaming.batch_parts import BatchParts


@dataclass(frozen=True)
class BatchTrainer:
    """Fits from zero on each batch of complete readings.

    A batch whose training or test part is empty is skipped. Model and metrics
    are stored under the batch id, so a repeated batch replaces its own. ``scores``
    names a folder for the parts that scores over the whole stream are made of.
    """

    models: str
    metrics: str
    seed: int = SEED
    share: float = 0.8
    verbose: bool = False
    scores: str | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if self.verbose:
                show_batch(rows)
                categories(rows, S.LABEL).show()
            scored = fit_and_score(rows, self.seed, self.share)
            if scored is None:
                return
            model, pairs = scored
            pairs = pairs.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                if self.verbose:
                    confusion_counts(pairs).show()
                write_metrics(metrics_for(pairs, batch_id), self.metrics)
                if self.scores:
                    BatchParts(self.scores, SCORE_PARTS).write(score_parts(pairs), batch_id)
                write_model(model, self.models, batch_id)
            finally:
                pairs.unpersist()
        finally:
            rows.unpersist()
