"""Mixtures over many slots, with weights that are not whole."""

import numpy as np
import pytest

from corpusloom.llm import mixing


def shares(blocks, weights):
    """How many blocks of each source the ideal mixture has run after each number of slots."""
    blocks, weights = np.array(blocks, float), np.array(weights, float)
    ends = blocks / weights
    clocks = np.concatenate([[0.0], np.sort(ends)])
    slots = np.minimum(blocks, clocks[:, None] * weights).sum(1)
    clock = np.interp(np.arange(1, int(blocks.sum()) + 1), slots, clocks)
    return np.minimum(blocks, clock[:, None] * weights)


@pytest.mark.parametrize("rows", [[1_000_000, *[105_263] * 19], [7, 90_000, 3_333, 64_001, 250_000]])
def test_deviation_of_fractional_weights(rows):
    """Within one block of the square-root weights after every slot, to the end of every source."""
    rows = dict(enumerate(rows))
    blocks = {s: -(-n // 64) for s, n in rows.items()}
    weights = mixing.temperature_weights(rows)
    done = np.zeros((sum(blocks.values()), len(rows)))
    for s, phases in mixing.schedule(blocks, weights).items():
        for first, last, base, period, own in phases:
            j = np.arange(last - first)
            done[base + j // len(own) * period + np.array(own)[j % len(own)], s] = 1
    off = done.cumsum(0) - shares(list(blocks.values()), list(weights.values()))
    assert (done.sum(1) == 1).all() and np.abs(off).max() < 1 + 1e-6


def test_plan_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 100)
    blocks, weights = [200, 0, 33, 90], [5, 1, 2, 3]
    got = sorted(tuple(r) for r in mixing.plan_table(spark, blocks, weights)[0].collect())
    plan = mixing.schedule(dict(enumerate(blocks)), dict(enumerate(weights)))
    assert got == sorted((s, i, t) for s, phases in plan.items() for i, t in enumerate(phases[0][4]))


def test_more_sources_than_a_thousand(spark):
    """Every row comes out once, equal sources in the order of their names."""
    docs = spark.range(2400).selectExpr("id AS doc_id", "if(id % 1200 = 7, null, format_string('h%04d', id % 1200)) AS source")
    out = mixing.mix(docs).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(2400))
    owner = {r["slot"]: r["source"] for r in out}
    assert sorted(owner) == list(range(1200))
    names = [owner[t] for t in range(1200)]
    assert names == [None, *sorted(names[1:])]
