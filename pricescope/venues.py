"""Venue descriptions: two venues, one implementation.

Every operator takes a :class:`Venue` and reads column names from it, so
the tick venue (integer bid/ask in cents) and the probability venue (a
0..1 price plus liquidity) share one code path.
"""

from __future__ import annotations

from dataclasses import dataclass

from pricescope.constants import PROB_STAT_DIGITS, TICK_STAT_DIGITS


@dataclass(frozen=True)
class Venue:
    name: str           # platform code used in alerts ('tick' | 'prob')
    key: str            # market key column
    price: str          # the price that moves: mid or yes price
    weight: str         # volatility-index weight: open interest or liquidity
    title: str          # display title column of the current-state table
    event: str          # event / series column of the per-market snapshot
    stat_digits: int    # rounding of the move averages in move statistics
    price_now: str      # output names of the pair operator
    price_prev: str


TICK = Venue(name="tick", key="market_ticker", price="mid", weight="open_interest",
             title="title", event="series_ticker", stat_digits=TICK_STAT_DIGITS,
             price_now="mid_now", price_prev="mid_prev")

PROB = Venue(name="prob", key="condition_id", price="outcome_yes_price",
             weight="liquidity", title="question", event="event_id",
             stat_digits=PROB_STAT_DIGITS, price_now="price_now", price_prev="price_prev")

VENUES = {"tick": TICK, "prob": PROB}
