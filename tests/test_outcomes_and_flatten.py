"""Outcome maps, yes/no prices, inheritance, skipped keys."""

import json

from pyspark.sql import functions as F

from pricescope.operators import ingest as ig
from pricescope.sources import feeds


def _prices(spark, rows):
    df = spark.createDataFrame(rows, "outcomes string, prices string")
    m = ig.outcome_map(F.col("outcomes"), F.col("prices"))
    d = df.select(m.alias("m"))
    yes, no = ig.yes_no_prices(F.col("m"))
    return [(r.m, r.yes, r.no) for r in d.select("m", yes.alias("yes"), no.alias("no")).collect()]


def test_outcome_map_rules(spark):
    rows = [
        ('["Yes","No"]', '["0.4","0.6"]'),
        ('["YES","no"]', '["0.3","0.7"]'),
        ('["No","Maybe"]', '["0.2","0.8"]'),       # no "yes": fallback overrides "no"
        ('["Yes","No","Maybe"]', '["0.5","0.3","0.2"]'),
        ('["Yes","No"]', '["0.5"]'),                # unequal lengths
        ('["Yes","No"]', '["0.5","abc"]'),          # one non-number nulls the map
        ('["Yes","Yes"]', '["0.1","0.9"]'),         # duplicate label: last wins
        ('["Yes",', '["0.1","0.9"]'),               # malformed JSON
        ('[]', '[]'),                               # empty map
        (' ["Yes","No"] ', '[0.25, 0.75]'),         # whitespace, numbers
        ('{"a":1}', '["0.1"]'),                     # not a list
    ]
    out = _prices(spark, rows)
    assert out[0] == ({"Yes": 0.4, "No": 0.6}, 0.4, 0.6)
    assert out[1][1:] == (0.3, 0.7)
    assert out[2][1:] == (0.2, 0.8)
    assert out[3][1:] == (0.5, 0.3)
    assert out[4] == (None, None, None)
    assert out[5] == (None, None, None)
    assert out[6][0] == {"Yes": 0.9} and out[6][1] == 0.9 and out[6][2] is None
    assert out[7] == (None, None, None)
    assert out[8][0] == {} and out[8][1] is None
    assert out[9][1:] == (0.25, 0.75)
    assert out[10] == (None, None, None)


def test_yes_last_match_wins_case_insensitive(spark):
    out = _prices(spark, [('["yes","No","YES"]', '["0.1","0.2","0.3"]')])
    assert out[0][1] == 0.3 and out[0][2] == 0.2


def _page(events):
    return json.dumps({"page_ts": "2024-01-30T18:00:00Z", "page_no": 0, "events": events})


def test_flatten_inherits_and_skips(spark):
    ev = {"id": "E1", "slug": "ev-slug", "title": "Ev", "category": "Cat", "startDate": "2024-01-01T00:00:00Z",
          "endDate": "2024-02-01T00:00:00Z", "markets": [
              {"id": "1", "conditionId": "C1", "slug": "", "category": "", "endDate": "",
               "outcomes": '["Yes","No"]', "outcomePrices": '["0.4","0.6"]', "liquidity": "12.5",
               "volume": 3, "volume24hr": "x"},
              {"id": "2", "conditionId": "C2", "slug": "own", "category": "Mine",
               "outcomes": '["Yes","No"]', "outcomePrices": '["0.4","0.6"]'},
              {"id": "3", "conditionId": "", "slug": "s3"},
              {"id": "4", "slug": "s4"}]}
    no_markets = {"id": "E2", "slug": "e2", "markets": []}
    not_array = {"id": "E3", "slug": "e3", "markets": "oops"}
    pages = spark.createDataFrame([(_page([ev, no_markets, not_array]),)], "value string")
    flat = ig.flatten_prob(feeds.prob_market_elements(feeds.prob_events(pages)))
    rows = {r.market_id: r for r in flat.collect()}
    assert set(rows) == {"1", "2", "3", "4"}
    assert rows["1"].slug == "ev-slug" and rows["1"].category == "Cat"
    assert rows["1"].end_date == "2024-02-01T00:00:00Z"
    assert rows["2"].slug == "own" and rows["2"].category == "Mine"
    norm = {r.condition_id: r for r in ig.normalize_prob(flat).collect()}
    assert set(norm) == {"C1", "C2"}                      # '' and missing keys skipped
    assert norm["C1"].liquidity == 12.5 and norm["C1"].volume == 3.0
    assert norm["C1"].volume_24hr is None                 # safe cast
    assert ig.skipped_count(flat).first().n_skipped == 2
