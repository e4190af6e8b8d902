"""The schedule against the weights given."""

from __future__ import annotations

import numpy as np

from cartpulse.llm import mixing


def test_schedule_follows_the_weights_themselves():
    weights = {f"s{i:02}": 1 if i else 19 for i in range(20)}  # the first has a half
    schedule = mixing.Schedule(dict.fromkeys(weights, 6_000), weights)
    for name, weight in weights.items():
        had = schedule.slots(name, np.arange(6_000))
        had = had[had < 10_000]
        k = np.arange(len(had))
        assert (np.abs((k + 1) * 38 - weight * (had + 1)) < 38).all()
        assert (np.abs(k * 38 - weight * had) < 38).all()
        assert abs(len(had) * 38 - weight * 10_000) < 38
