import os
import tempfile

from pyspark.sql import functions as F

from brute import SF001
from wordmill.operators import bpe
from wordmill.streaming import encode_stream


def test_stream_encode_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="wm-stream-src-")
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    docs.repartition(3).write.mode("overwrite").parquet(os.path.join(src, "in"))
    model = bpe.model_from_merges(None, [("t", "h", 0), ("th", "e", 0), ("e", "</w>", 0)])
    stream = encode_stream.text_stream(spark, os.path.join(src, "in"), "doc_id long, text string")
    out = os.path.join(src, "out")
    encode_stream.run_available(encode_stream.encoded(stream, model).select("doc_id", "ids"), out,
                                os.path.join(src, "ckpt"))
    got = {r["doc_id"]: list(r["ids"]) for r in spark.read.parquet(out).collect()}
    want = {r["doc_id"]: list(r["ids"]) for r in bpe.encode(docs, "text", model).collect()}
    assert got == want
