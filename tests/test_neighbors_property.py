"""Property: for any data shape and block width the neighbour operator equals
lag/lead over a window."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cabgrid.operators.sequence import with_neighbors
from test_neighbors import expected, rows

rows_st = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.integers(0, 300),
        st.one_of(st.none(), st.integers(2**60, 2**60 + 9)),
        st.one_of(st.none(), st.floats(allow_infinity=False)),
    ),
    max_size=80,
)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=rows_st, width=st.integers(1, 200), lags=st.integers(0, 3), leads=st.integers(0, 3))
def test_property_matches_window(spark, data, width, lags, leads):
    leads = leads or (0 if lags else 1)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id long, g string, t int, v long, x double")
    got = with_neighbors(df, ["g"], ["t", "id"], ["v", "x"], F.floor(F.col("t") / width), lags=lags, leads=leads)
    assert rows(got) == rows(expected(df, ["g"], ["t", "id"], ["v", "x"], lags, leads))
