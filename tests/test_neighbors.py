"""The neighbour operator equals lag/lead over a window, also when one group
holds a third of the rows and blocks are few, many, tiny or far apart."""

import math
import random

import pytest
from pyspark.sql import Window, functions as F

from cabgrid.operators.sequence import lag_name, lead_name, with_neighbors


def expected(df, by, order, values, lags, leads):
    w = Window.partitionBy(*by).orderBy(*order)
    cols = [F.col(c) for c in df.columns]
    cols += [F.lag(v, j).over(w).alias(lag_name(v, j)) for j in range(1, lags + 1) for v in values]
    cols += [F.lead(v, j).over(w).alias(lead_name(v, j)) for j in range(1, leads + 1) for v in values]
    return df.select(*cols)


def rows(df):
    plain = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(map(plain, r)) for r in df.select(sorted(df.columns)).collect()), key=str)


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        g = "HOT" if i % 3 == 0 else None if i % 31 == 1 else f"g{rnd.randrange(40)}"
        t = rnd.randrange(50) + rnd.choice([0, 0, 400, 5000])  # blocks without rows lie between
        x = rnd.choice([None, float("nan"), rnd.random()])
        out.append((i, g, rnd.randrange(3), t, 2**60 + rnd.randrange(9), rnd.choice([None, 2**60 + i]), x))
    return spark.createDataFrame(out, "id long, g string, day int, t int, big long, maybe long, x double")


@pytest.mark.parametrize("width", [1, 7, 60, 100_000])
@pytest.mark.parametrize("by,lags,leads", [(["g"], 1, 0), (["g", "day"], 1, 3), (["g"], 2, 2), (["g"], 0, 4)])
def test_matches_window(spark, width, by, lags, leads):
    df = _data(spark)
    values = ["big", "maybe", "x", "t"]
    got = with_neighbors(df, by, ["t", "id"], values, F.floor(F.col("t") / width), lags=lags, leads=leads)
    exp = expected(df, by, ["t", "id"], values, lags, leads)
    assert got.columns == exp.columns and got.schema.simpleString() == exp.schema.simpleString()
    assert rows(got) == rows(exp)


def test_empty_input_and_no_neighbours(spark):
    df = _data(spark, 10)
    assert with_neighbors(df.limit(0), ["g"], ["t", "id"], ["x"], F.col("t"), lags=1).count() == 0
    with pytest.raises(ValueError):
        with_neighbors(df, ["g"], ["t", "id"], ["x"], F.col("t"), lags=0)


def test_plan_is_lazy_and_without_python(spark, capsys):
    out = with_neighbors(_data(spark, 50), ["g"], ["t", "id"], ["x"], F.floor(F.col("t") / 10), lags=1, leads=1)
    out.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
