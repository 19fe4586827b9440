"""Property: the split (hot-key) path of the keyed scan equals the plain window,
for every scan op, with NULL keys, NULL values, ties in time and two-column keys."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import F

from walletyield.operators.scan import keyed_scan

row = st.tuples(
    st.sampled_from([1, 1, 1, 1, 2, 3, None]),          # k1: key 1 is hot
    st.sampled_from(["a", "b"]),                         # k2
    st.integers(0, 40),                                  # minute (many ties)
    st.one_of(st.none(), st.integers(-50, 50)),          # value
)


def _key(t):
    return tuple((x is None, str(x)) for x in t)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=30, max_size=120), st.integers(2, 6))
def test_split_equals_plain(spark, rows, parts):
    base = dt.datetime(2024, 1, 1)
    data = [(k1, k2, base + dt.timedelta(minutes=m), v, i) for i, (k1, k2, m, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k1 int, k2 string, ts timestamp_ntz, v int, seq long")
    scans = {"s": ("sum", F.col("v")), "n": ("count", F.col("v")), "mx": ("max", F.col("v")),
             "mn": ("min", F.col("v")), "lv": ("last", F.col("v")),
             "mo": ("maxoff", (F.col("v").cast("long"), 3))}
    leads = {"nts": F.col("ts"), "nv": F.col("v")}
    for key in (["k1"], ["k1", "k2"]):
        plain = keyed_scan(df, key, ["ts", "seq"], scans, leads, split_hot=False)
        split = keyed_scan(df, key, ["ts", "seq"], scans, leads, fanout=4, range_partitions=parts)
        a = sorted((tuple(r) for r in plain.collect()), key=_key)
        b = sorted((tuple(r) for r in split.select(*plain.columns).collect()), key=_key)
        assert a == b, key
