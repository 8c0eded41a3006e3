import pytest
from pyspark.sql import functions as F

from threadweave.functions import java_string_hash, java_string_hash_expr

# Golden values of String.hashCode (fixed values from the JVM).
GOLDEN = [("The_Donald", 2072386884), ("politics", 547400545), ("HillaryClinton", -1345365794),
          ("a", 97), ("été", 227742), ("😀x", 54959989), ("", 0), (None, None)]


@pytest.mark.parametrize("fn", [java_string_hash, java_string_hash_expr])
def test_golden(spark, fn):
    df = spark.createDataFrame(GOLDEN, "s string, want int")
    got = {r.s: r.got for r in df.select("s", fn("s").alias("got")).collect()}
    assert got == dict(GOLDEN)


def test_batches_with_few_other_values(spark):
    """ASCII values of a batch keep the direct path beside others, slices and nulls."""
    from threadweave.functions.hashing import _make_hash_arrow
    import pyarrow as pa
    values = ["plain", "", None, "été", "a" * 300, "😀x", "The_Donald", "\x7f", "é"] * 20

    def want(v):
        h = 0
        raw = v.encode("utf-16-be")
        for i in range(0, len(raw), 2):
            h = (h * 31 + int.from_bytes(raw[i:i + 2], "big")) & 0xFFFFFFFF
        return h - (1 << 32) if h >> 31 else h

    fn = _make_hash_arrow()
    for part in (pa.array(values), pa.array(values, pa.large_string()).slice(5, 40), pa.chunked_array([values[:3], values[3:]]), pa.array([], pa.string())):
        assert fn(part).to_pylist() == [None if v is None else want(v) for v in part.to_pylist()]


def test_forms_agree_on_data(spark):
    from tests.conftest import SF_SMALL
    from threadweave.sources.fixture import comments_raw
    c = comments_raw(spark, SF_SMALL)
    diff = c.filter(java_string_hash("link_id") != java_string_hash_expr("link_id")).count()
    assert diff == 0
    assert c.select(java_string_hash("author").alias("h")).filter(F.col("h").isNull()).count() == 0
