"""Property test: on random small visit sets, every plan variant gives the same rows."""

from conftest import poi_df, visits_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quartermart import catalog as C
from quartermart.plans.attraction_quarter import attraction_quarter
from quartermart.plans.city_quarter import city_quarter
from quartermart.plans.user_quarter import user_quarter

POIS = [("p1", "A", "c1", "r1"), ("p2", "B", "c2", "r1"), ("p3", "A", "未分类", "r2"), ("p4", "C", "c1", "r3")]

visit = st.tuples(
    st.sampled_from(["u1", "u2", "u3"]),
    st.sampled_from(["2020-01-05", "2020-02-10", "2020-03-31", "2020-04-01", "2021-07-15"]),
    st.sampled_from(["Solo", "Family", "Unrecorded", "2-HIGH"]),
    st.sampled_from(["p1", "p2", "p3", "p4", "zz"]),   # zz: not in the dimension
    st.sampled_from(["", "x"]),                          # two raw rows of one user-date
)


def _same(a, b):
    a, b = C.normalize(a), C.normalize(b)
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(visit, min_size=1, max_size=25))
def test_plan_variants_agree(spark, rows):
    v, p = visits_df(spark, rows), poi_df(spark, POIS)
    assert _same(user_quarter(v, p, broadcast=True), user_quarter(v, p, broadcast=False))
    assert _same(attraction_quarter(v, p, broadcast=True), attraction_quarter(v, p, broadcast=False))
    assert _same(city_quarter(v, p, broadcast=True), city_quarter(v, p, broadcast=False))
