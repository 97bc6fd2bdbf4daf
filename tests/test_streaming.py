"""Streaming ingest equals the batch aggregate (files landing in two waves)."""

import os
import tempfile

from yieldcast.operators.aggregate import aggregate_site_gl_week
from yieldcast.operators.clean import clean_records
from yieldcast.sources.files import read_raw_csv, write_csv
from yieldcast.sources.fixture import raw_records
from yieldcast.streaming.ingest import fold_partials, start_ingest

SF = "/root/testdata/sf0.001"


def test_stream_partials_fold_to_batch_aggregate(spark):
    base = tempfile.mkdtemp(prefix="yc-stream-")
    land, table, ckpt = (os.path.join(base, d) for d in ("landing", "table", "ckpt"))
    raw = raw_records(spark, SF).drop("vendor_name")
    write_csv(raw.filter("year < 1998"), os.path.join(land, "wave1"))
    q = start_ingest(spark, os.path.join(land, "*"), table, ckpt)
    q.awaitTermination()
    write_csv(raw.filter("year >= 1998"), os.path.join(land, "wave2"))
    q = start_ingest(spark, os.path.join(land, "*"), table, ckpt)
    q.awaitTermination()
    got = fold_partials(spark, table)
    want = aggregate_site_gl_week(clean_records(read_raw_csv(spark, os.path.join(land, "*"))))
    cols = sorted(want.columns)
    assert got.count() == want.count()
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
