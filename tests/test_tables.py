"""Region and receiver tables."""

from __future__ import annotations

import random

from conftest import at, clean_row

from txspark.plans.tables import latest_sale_per_receiver, region_risk, top_receivers
from txspark.streaming.live import latest_sales


def address(i: int) -> str:
    return f"0x{i:040x}"


def test_regions_by_mean_risk(cleaned):
    df = cleaned(
        clean_row(location_region="Asia", risk_score=10.0),
        clean_row(location_region="Asia", risk_score=20.0),
        clean_row(location_region="Europe", risk_score=90.0),
        clean_row(location_region="Africa", risk_score=15.0),
    )
    assert [tuple(r) for r in region_risk(df).collect()] == [
        ("Europe", 90.0, 1),
        ("Africa", 15.0, 1),
        ("Asia", 15.0, 2),
    ]


def test_means_are_rounded(cleaned):
    df = cleaned(*[clean_row(risk_score=s) for s in (1.0, 1.0, 2.0)])
    assert region_risk(df).first().avg_risk_score == 1.333333


def test_latest_sale_wins_over_larger_ones(cleaned):
    df = cleaned(
        clean_row(timestamp=at(1), amount=900.0),
        clean_row(timestamp=at(5), amount=10.0),
        clean_row(timestamp=at(9), amount=5000.0, transaction_type="purchase"),
    )
    assert [r.amount for r in top_receivers(df).collect()] == [10.0]


def test_simultaneous_sales_give_the_largest(cleaned):
    df = cleaned(*[clean_row(timestamp=at(2), amount=a) for a in (3.0, 8.0, 5.0)])
    assert [r.amount for r in latest_sale_per_receiver(df).collect()] == [8.0]


def test_top_k_is_ordered_and_breaks_ties_by_address(cleaned):
    amounts = [5.0, 70.0, 70.0, 1.0, 30.0]
    df = cleaned(
        *[clean_row(receiving_address=address(i), amount=a) for i, a in enumerate(amounts)]
    )
    rows = top_receivers(df).collect()
    assert [(r.receiving_address, r.amount) for r in rows] == [
        (address(1), 70.0),
        (address(2), 70.0),
        (address(4), 30.0),
    ]
    assert top_receivers(df, k=1).count() == 1
    assert top_receivers(df).columns == ["receiving_address", "amount", "timestamp"]


def test_no_sales_and_no_rows(cleaned):
    assert top_receivers(cleaned(clean_row(transaction_type="transfer"))).count() == 0
    assert top_receivers(cleaned()).count() == 0
    assert region_risk(cleaned()).count() == 0


def test_against_brute_force_with_a_hot_receiver(cleaned):
    rng = random.Random(7)
    rows = [
        clean_row(
            receiving_address=address(0 if rng.random() < 0.4 else rng.randrange(30)),
            timestamp=at(rng.randrange(1, 29), rng.randrange(24)),
            amount=float(rng.randrange(1, 50)),
            transaction_type=rng.choice(["sale", "purchase"]),
        )
        for _ in range(600)
    ]
    best: dict[str, tuple] = {}
    for r in rows:
        if r["transaction_type"] == "sale":
            key = (r["timestamp"], r["amount"])
            best[r["receiving_address"]] = max(best.get(r["receiving_address"], key), key)
    expected = {(k, a) for k, (_, a) in best.items()}
    df = cleaned(*rows).repartition(7)
    for build in (latest_sale_per_receiver, latest_sales):
        got = {(r.receiving_address, r.amount) for r in build(df).collect()}
        assert got == expected
