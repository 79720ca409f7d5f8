import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F


def test_a_stage_sends_long_texts_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    texts = spark.range(0, 100, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    found = [r.size for r in corpus_pipeline.bounded(lambda spark, docs, _: docs.mapInArrow(sizes, "size long"))(spark, texts, "").collect()]
    assert sum(found) >= 100 << 20 and max(found) <= 6 << 20
