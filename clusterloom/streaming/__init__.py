"""Fitted models on streams.

Prediction is a projection with model-sized parameters: no state, no watermark, no shuffle. The same
``transform`` therefore serves batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def score(model, stream: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
    """Add the cluster of every row of a streaming frame."""
    if not stream.isStreaming:
        raise ValueError("not a streaming frame; call model.transform")
    return model.transform(stream, features, cluster)
