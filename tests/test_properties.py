"""Property tests (hypothesis): basket text round trip; every layout of a
random panel reads back to the same long table; element counts."""
import itertools

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelspark.functions import scalars as S
from panelspark.plans import pipelines as PL

ids = st.lists(st.from_regex(r"[0-9]{1,8}", fullmatch=True), min_size=1, max_size=12)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(baskets=st.lists(ids, min_size=1, max_size=8))
def test_basket_text_roundtrip(spark, baskets):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(baskets)], "i int, a array<string>")
    rows = df.select("i", "a", S.parse_basket(S.basket_text("a")).alias("back"),
                     S.basket_text_count(S.basket_text("a")).alias("n")).collect()
    for r in rows:
        assert r.back == r.a and r.n == len(r.a)


def write(tmp, layout, p):
    from tests.test_layout_files import write_layout
    return write_layout(tmp, layout, p)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n_dates=st.integers(1, 3), n_stocks=st.integers(1, 3), n_factors=st.integers(1, 3),
       seed=st.integers(0, 1000), layout=st.sampled_from([1, 3, 4, 5, 6]))
def test_layouts_agree_on_random_panels(spark, tmp_path_factory, n_dates, n_stocks, n_factors, seed, layout):
    dates = [f"2020-0{m}-15" for m in range(1, n_dates + 1)]
    stocks = [f"{600000 + k}" for k in range(n_stocks)]
    factors = [f"f{k}" for k in range(n_factors)]
    rows = [(d, s, f, float((seed + i) % 97) + 0.25) for i, (d, s, f) in enumerate(itertools.product(dates, stocks, factors))]
    p = pd.DataFrame(rows, columns=["date", "stock", "factor", "value"])
    tmp = tmp_path_factory.mktemp("prop")
    got = {(str(r.date), r.stock, r.factor, r.value) for r in
           PL.read_layout(spark, layout, write(tmp, layout, p), "csv").panel.collect()}
    assert got == set(map(tuple, p.itertuples(index=False)))
