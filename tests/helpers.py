import datetime as dt

from pricescope.schemas import TICK_SNAPSHOT, TICK_STATE


def t(s):
    return dt.datetime.fromisoformat(s)


def tick_snaps(spark, rows):
    """rows: (snap_ts, key, mid, spread, volume, oi[, series])"""
    out = []
    for r in rows:
        ts_, key, mid, spread, vol, oi = r[:6]
        series = r[6] if len(r) > 6 else "E1"
        bid = None if mid is None else int(mid - (spread or 0) / 2)
        out.append((t(ts_), 1, key, series, None, bid, None if bid is None else bid + (spread or 0), vol, oi,
                    spread, mid))
    return spark.createDataFrame(out, TICK_SNAPSHOT)


def tick_state(spark, rows):
    """rows: dicts of TICK_STATE fields (missing -> null)."""
    names = TICK_STATE.fieldNames()
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], TICK_STATE)
