import datetime as dt
import random
from collections import Counter

from events_cases import NOW

from cairnlake.operators import halflife

START = dt.date(2024, 1, 1)


def brute(rows):
    last = max(day for _, day, _ in rows)
    result = {}
    for repo in {r for r, _, _ in rows if r is not None}:
        mine = [(day, type_) for r, day, type_ in rows if r == repo]
        releases = [day for day, type_ in mine if type_ == "ReleaseEvent"]
        if not releases:
            continue
        counts = Counter(day for day, _ in mine if day >= min(releases))
        peak = max(counts.values())
        peak_day = min(d for d, n in counts.items() if n == peak)
        half, day = None, peak_day
        while half is None and day <= last:
            if counts.get(day, 0) * 2 <= peak:
                half = day
            day += dt.timedelta(days=1)
        days = (half - peak_day).days if half else None
        result[repo] = (min(releases), peak_day, peak, half, days)
    return result


def test_half_life_equals_brute_force(spark):
    for seed in range(3):
        rng = random.Random(seed)
        rows = []
        for repo in ["a", "b", "c", "d", "e", "f", "hot", None]:
            for day in range(rng.randrange(2, 15)):
                many = rng.choice([0, 0, 1, 2, 3, 8]) * (20 if repo == "hot" else 1)
                for _ in range(many):
                    type_ = "ReleaseEvent" if rng.random() < 0.1 else "PushEvent"
                    rows.append((repo, START + dt.timedelta(days=day), type_))
        rows += [("end", START + dt.timedelta(days=14), "ReleaseEvent")]  # half never reached
        df = spark.createDataFrame(rows, "repo_name STRING, event_date DATE, type STRING")
        got = {r.repo_name: tuple(r)[1:] for r in halflife.half_life(df).collect()}
        assert got == brute(rows)
        assert got["end"][3:] == (None, None)
    assert NOW
