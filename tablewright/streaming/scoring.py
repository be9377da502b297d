"""Score new files in a folder with a saved pipeline model."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablewright.operators.model import predict
from tablewright.session import checkpoint_dir
from tablewright.sources.tables import load_model


def score_stream(spark: SparkSession, model_path: str, source_dir: str, schema: T.StructType | str,
                 sink_dir: str, keep: list[str], checkpoint: str | None = None,
                 fmt: str = "parquet", available_now: bool = True,
                 truncate_to_int: bool = True) -> StreamingQuery:
    """Read files from ``source_dir`` as a stream, score them, append to ``sink_dir``.

    Scoring is stateless, so each micro-batch is independent and the file
    sink plus the checkpoint give exactly-once output.  The checkpoint goes
    under the session's shared checkpoint folder unless given.
    """
    model = load_model(model_path)
    src = spark.readStream.schema(schema).format(fmt).load(source_dir)
    scored = predict(model, src)
    pred = F.col("prediction").cast("bigint") if truncate_to_int else F.col("prediction")
    out = scored.select(*keep, pred.alias("target"))
    # one checkpoint per sink, so several scoring streams never share state
    tag = hashlib.sha1(sink_dir.encode()).hexdigest()[:16]
    ck = checkpoint or checkpoint_dir(spark).rstrip("/") + f"/score_stream/{tag}"
    w = out.writeStream.format("parquet").option("path", sink_dir) \
        .option("checkpointLocation", ck).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
