from threadweave.operators import prep
from threadweave.runtime import scratch_path
from threadweave.sources import fixture
from threadweave.streaming import start_prep_stream
from tests.conftest import SF_SMALL


def test_prep_stream_goes_on_without_a_checkpoint_argument(spark):
    """Months that arrive between two calls with the same output are neither lost nor doubled."""
    raw = fixture.comments_raw(spark, SF_SMALL)
    src, out = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-out")
    raw.filter("month < '1997-01'").write.parquet(f"{src}/a")
    schema = spark.read.parquet(f"{src}/a").schema
    start_prep_stream(spark, f"{src}/*", schema, out).awaitTermination(180)
    first = spark.read.parquet(out).count()
    raw.filter("month >= '1997-01'").write.parquet(f"{src}/b")
    start_prep_stream(spark, f"{src}/*", schema, out).awaitTermination(180)
    want = prep.prep_comments(raw).count()
    assert 0 < first < want == 5871 == spark.read.parquet(out).count()


def test_prep_stream_resumes_without_duplicates(spark):
    raw = fixture.comments_raw(spark, SF_SMALL)
    src = scratch_path(spark, "stream-src")
    out = scratch_path(spark, "stream-out")
    ckpt = scratch_path(spark, "stream-ckpt")
    # months arrive in two batches; the second run resumes from the stream checkpoint
    raw.filter("month < '1998-01'").write.parquet(f"{src}/a")
    schema = spark.read.parquet(f"{src}/a").schema
    start_prep_stream(spark, f"{src}/*", schema, out, kind="comments", checkpoint=ckpt).awaitTermination(180)
    raw.filter("month >= '1998-01'").write.parquet(f"{src}/b")
    start_prep_stream(spark, f"{src}/*", schema, out, kind="comments", checkpoint=ckpt).awaitTermination(180)
    got = spark.read.parquet(out)
    want = prep.prep_comments(raw)
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0
