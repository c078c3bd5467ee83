"""A hot customer holding a third of all usage rows: the usage-side operators stay
exact (checked against pandas brute force over all row pairs)."""

import datetime as dt

import numpy as np
import pandas as pd

from ceasekit.operators.relational import same_month_join
from ceasekit.plans import features as FE
from ceasekit.plans import quality as Q

ID = "unique_customer_identifier"


def _data(spark):
    rng = np.random.default_rng(11)
    n = 9000
    ids = np.where(rng.random(n) < 1 / 3, "hot", np.char.add("c", rng.integers(0, 300, n).astype(str)))
    day0 = dt.date(2024, 1, 1)
    usage = pd.DataFrame({ID: ids, "calendar_date": [day0 + dt.timedelta(days=int(d)) for d in rng.integers(0, 200, n)]})
    cids = np.concatenate([["hot"] * 4, np.char.add("c", rng.integers(0, 300, 200).astype(str))])
    cease = pd.DataFrame({ID: cids, "cease_placed_date": [day0 + dt.timedelta(days=int(d))
                                                          for d in rng.integers(0, 220, cids.size)]})
    obs = pd.DataFrame({ID: ["hot"] + [f"c{i}" for i in range(300)],
                        "behav_win": [dt.date(2024, 1 + i % 6, 1) for i in range(301)]})
    sdf = lambda p, schema: spark.createDataFrame(p, schema).repartition(6)
    return (usage, cease, obs, sdf(usage, f"{ID} string, calendar_date date"),
            sdf(cease, f"{ID} string, cease_placed_date date"), sdf(obs, f"{ID} string, behav_win date"))


def test_usage_after_with_hot_customer(spark):
    usage, cease, _, su, sc, _ = _data(spark)
    got = {(r[ID], r.cease_placed_date): (r.events, r.after)
           for r in Q.usage_rows_after(su, sc, ID, "calendar_date", "cease_placed_date").collect()}
    pairs = cease.merge(usage, on=ID)
    dpairs = cease.drop_duplicates().merge(usage, on=ID)
    after = dpairs[dpairs.calendar_date > dpairs.cease_placed_date].groupby([ID, "cease_placed_date"]).size()
    events = cease.groupby([ID, "cease_placed_date"]).size()
    want = {k: (int(v), int(after.get(k, 0))) for k, v in events.items()}
    assert got == want
    hot = [v for k, v in got.items() if k[0] == "hot"]
    assert hot and max(a for _, a in hot) > 1000
    agg = Q.usage_after(su, sc, ID, "calendar_date", "cease_placed_date").first()
    ok = pairs[pairs.calendar_date > pairs.cease_placed_date]
    assert agg.customers == ok[ID].nunique() and agg.records == len(ok)


def test_same_month_usage_days_with_hot_customer(spark):
    usage, _, obs, su, _, so = _data(spark)
    j = same_month_join(su, so, ID, "calendar_date", "behav_win")
    days = {r[ID]: r.usage_days for r in FE.usage_days(j).collect()}
    m = usage.merge(obs, on=ID)
    m = m[pd.to_datetime(m.calendar_date).dt.to_period("M").dt.start_time.dt.date == m.behav_win]
    assert j.count() == len(m)
    assert days == {k: int(v) for k, v in m.groupby(ID).calendar_date.nunique().items()}
