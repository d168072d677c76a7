"""Property test of I7: the Spark outcome-price expressions agree with a
plain-Python statement of the rules on random outcome lists."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricescope.operators import ingest as ig

LABELS = ["Yes", "yes", "YES", "No", "no", "Maybe", "Other"]
PRICES = ["0.1", "0.25", "0.5", "0.75", "0.9", "1", "0", "abc", ""]


def rule(labels, prices):
    """The rules as stated: equal lengths, every price a number, labels are
    dictionary keys (first position, last value), yes/no matched
    case-insensitively with the last match winning, and with no "yes" and
    exactly two outcomes the first and second values are yes and no."""
    if len(labels) != len(prices):
        return None, None, None
    values = []
    for p in prices:
        try:
            values.append(float(p))
        except ValueError:
            return None, None, None
    m = {}
    for k, v in zip(labels, values):
        m[k] = v
    yes = no = None
    for k, v in m.items():
        if k.lower() == "yes":
            yes = v
        elif k.lower() == "no":
            no = v
    if yes is None and len(m) == 2:
        yes, no = list(m.values())
    return m, yes, no


cases = st.lists(st.tuples(st.lists(st.sampled_from(LABELS), max_size=4),
                           st.lists(st.sampled_from(PRICES), max_size=4)), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cases)
def test_outcome_rules_match_the_stated_rules(spark, batch):
    rows = [(i, json.dumps(l), json.dumps(p)) for i, (l, p) in enumerate(batch)]
    df = spark.createDataFrame(rows, "i int, o string, p string")
    m = ig.outcome_map(F.col("o"), F.col("p"))
    d = df.select("i", m.alias("m"))
    yes, no = ig.yes_no_prices(F.col("m"))
    got = {r.i: (r.m, r.yes, r.no) for r in d.select("i", "m", yes.alias("yes"), no.alias("no")).collect()}
    for i, (labels, prices) in enumerate(batch):
        exp_m, exp_yes, exp_no = rule(labels, prices)
        g_m, g_yes, g_no = got[i]
        assert (g_m is None) == (exp_m is None), (labels, prices, got[i])
        if exp_m is not None:
            assert dict(g_m) == exp_m, (labels, prices, got[i])
            assert (g_yes, g_no) == (exp_yes, exp_no), (labels, prices, got[i])
