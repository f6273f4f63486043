import tempfile

import numpy as np

from clusterloom.operators import kmeans
from clusterloom.streaming import score


def test_fitted_model_scores_a_stream(spark, frame, blobs):
    x, _ = blobs
    df = frame(x)
    model = kmeans.KMeans(3, random_state=1).fit(df)
    folder = tempfile.mkdtemp(prefix="stream-")
    df.write.mode("overwrite").parquet(folder)
    stream = score(model, spark.readStream.schema(df.schema).parquet(folder))
    q = stream.select("id", "cluster").writeStream.format("memory").queryName("scored").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = [r["cluster"] for r in spark.sql("SELECT * FROM scored").orderBy("id").collect()]
    assert np.array_equal(got, [r["cluster"] for r in model.transform(df).orderBy("id").collect()])
