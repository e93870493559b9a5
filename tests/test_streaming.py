"""The fitted cleaning steps give the same rows on a stream as on a batch."""

import tempfile
import uuid

from tabmill.plans import pipeline as P
from tabmill.sources.assay import ASSAY_SPEC
from tabmill.streaming.score import apply_cleaning, clean_stream


def test_stream_equals_batch(spark, sf_small):
    raw = P.assay_raw(spark, sf_small)
    pre = P.preprocess(raw, ASSAY_SPEC, cut_lineage=False)
    root = tempfile.mkdtemp(prefix="tabmill-stream-")
    src, sink, ck = (f"{root}/{n}-{uuid.uuid4().hex}" for n in ("src", "sink", "ck"))
    raw.write.parquet(src)
    q = clean_stream(spark, src, raw.schema, pre, sink, ck)
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(sink)
    want = apply_cleaning(raw, pre)
    assert sorted(got.columns) == sorted(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
