"""D08 / D09 on the sweep fixtures of FIXTURES.md §3, plus D09 against a
brute-force day loop written from the rule."""

import collections
import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest

from tesoro.operators import ledger as LG
from tesoro.operators.ledger import _sweep_cents, ledger_roll_forward
from tesoro.operators.sweep import sweep_allocation, sweep_transfers

DAY = dt.date(2026, 8, 7)
ACCTS = ["1000000003", "2000000003", "3000000003", "4000000003"]


def balances(spark, values, day=DAY, accts=ACCTS):
    rows = [(day, a, "GBP", Decimal(str(v))) for a, v in zip(accts, values)]
    return spark.createDataFrame(rows, "date date, account_number string, currency string, "
                                       "closing_balance decimal(18,2)")


def closings(df):
    return {r.account_number: float(r.closing_balance) for r in df.collect()}


@pytest.mark.parametrize("mode", ["snapshot", "waterfall"])
def test_one_deficit(spark, mode):
    b = balances(spark, [186886.29, -5726.02, 436142.72, 300966.41], dt.date(2026, 2, 12))
    mv, new = sweep_allocation(b, mode)
    assert list(closings(new).values()) == [186886.29, 0.0, 430416.70, 300966.41]
    legs = sorted((r.transaction_id, float(r.amount)) for r in mv.collect())
    assert legs == [("SWEEP-2000000003-3000000003", 5726.02), ("SWEEP-3000000003-2000000003", -5726.02)]


def test_snapshot_spends_twice(spark):
    _, new = sweep_allocation(balances(spark, [2686.65, 2209.62, -11374.05, -16843.98]), "snapshot")
    assert list(closings(new).values()) == [-2686.65, -2209.62, -6477.78, -11947.71]


def test_waterfall_spends_once(spark):
    _, new = sweep_allocation(balances(spark, [2686.65, 2209.62, -11374.05, -16843.98]), "waterfall")
    assert list(closings(new).values()) == [0.0, 0.0, -11374.05, -11947.71]


def test_hand_waterfall(spark):
    b = balances(spark, [100, 40, -90, -60, -50], accts=["a", "b", "e", "c", "d"])
    got = sorted((r.deficit_acct, r.surplus_acct, float(r.amount))
                 for r in sweep_transfers(b, mode="waterfall").collect())
    assert got == [("c", "a", 10.0), ("c", "b", 40.0), ("e", "a", 90.0)]


def brute_sweep(pre, mode):
    """The rule, cent by cent: surplus cents stand in a row, largest account
    first, and so do the cents asked for, largest deficit first.  Waterfall
    pairs the two rows; in a snapshot every deficit pairs its own cents with
    the whole row of surplus cents."""
    order = sorted(range(len(pre)), key=lambda i: (-abs(pre[i]), i))
    offered = [i for i in order if pre[i] > 0 for _ in range(pre[i])]
    asked = [[i] * -pre[i] for i in order if pre[i] < 0]
    pairs = zip(sum(asked, []), offered) if mode == "waterfall" else [p for own in asked for p in zip(own, offered)]
    net = collections.Counter()
    for taker, giver in pairs:
        net[taker] += 1
        net[giver] -= 1
    return [net[i] for i in range(len(pre))]


@pytest.mark.parametrize("mode", ["snapshot", "waterfall"])
def test_kernel_matches_brute(mode):
    rng = random.Random(7)
    for _ in range(300):
        pre = [rng.choice([-1, 1]) * rng.randint(0, 5000) for _ in range(rng.randint(1, 9))]
        got = _sweep_cents(np.array(pre, dtype=np.int64), mode).tolist()
        assert got == brute_sweep(pre, mode), pre


@pytest.mark.parametrize("mode", ["snapshot", "waterfall"])
def test_ledger_matches_day_loop(spark, mode):
    rng = random.Random(11)
    accts = [f"A{i}" for i in range(6)]
    pools = {a: ("EUR" if i < 3 else "GBP") for i, a in enumerate(accts)}
    start = dt.date(2026, 1, 1)
    opening = {a: rng.randint(-5000, 20000) for a in accts}
    moves = []
    for k in range(20):
        for a in accts:
            if rng.random() < 0.5:
                moves.append((start + dt.timedelta(days=k), a, pools[a], rng.randint(-15000, 12000)))
    end = start + dt.timedelta(days=21)
    op = spark.createDataFrame([(a, pools[a], Decimal(c) / 100) for a, c in opening.items()],
                               "account_number string, currency string, opening_balance decimal(18,2)")
    mv = spark.createDataFrame([(d, a, p, Decimal(c) / 100) for d, a, p, c in moves],
                               "date date, account_number string, currency string, amount decimal(18,2)")
    got = {(r.date, r.account_number): (int(r.starting_balance * 100), int(r.total_movements * 100),
                                        int(r.closing_balance * 100))
           for r in ledger_roll_forward(op, mv, start, end, mode).collect()}
    # brute force, one pool at a time, day by day
    bal = dict(opening)
    want = {}
    day = start
    while day <= end:
        mov = {a: 0 for a in accts}
        for d, a, p, c in moves:
            if d == day:
                mov[a] += c
        for cur in ("EUR", "GBP"):
            members = [a for a in accts if pools[a] == cur]
            pre = [bal[a] + mov[a] for a in members]
            sw = brute_sweep(pre, mode)
            for a, p0, s0 in zip(members, pre, sw):
                want[(day, a)] = (bal[a], mov[a], p0 + s0)
                bal[a] = p0 + s0
        day += dt.timedelta(days=1)
    assert got == want


OPEN = "account_number string, currency string, opening_balance decimal(18,2)"
MOVE = "date date, account_number string, currency string, amount decimal(18,2)"


def test_unknown_opening_and_unknown_account(spark):
    day = dt.date(2026, 1, 1)
    op = spark.createDataFrame([("A", "EUR", None), ("B", "EUR", Decimal("-5.25"))], OPEN)
    mv = spark.createDataFrame([(day, "A", "EUR", Decimal("1.10")), (day, "X", "EUR", Decimal("9.00")),
                                (day, "Y", "GBP", Decimal("9.00"))], MOVE)
    got = {(r.account_number, r.date.day): (str(r.starting_balance), str(r.closing_balance))
           for r in ledger_roll_forward(op, mv, day, dt.date(2026, 1, 2)).collect()}
    assert got == {("A", 1): ("100000.00", "99995.85"), ("B", 1): ("-5.25", "0.00"),
                   ("A", 2): ("99995.85", "99995.85"), ("B", 2): ("0.00", "0.00")}
    assert sorted(r.account_number for r in LG.unknown_movements(op, mv).collect()) == ["X", "Y"]
    flat = {(r.account_number, r.date.day): str(r.closing_balance)
            for r in LG.balance_roll_forward(op, mv, day, dt.date(2026, 1, 2)).collect()}
    assert flat == {("A", 1): "100001.10", ("B", 1): "-5.25", ("A", 2): "100001.10", ("B", 2): "-5.25"}


def test_quiet_pool_comes_in_bounded_frames():
    accounts = np.array([f"A{i:04d}" for i in range(2000)], dtype=object)
    stream = LG._PoolStream(("EUR",), accounts, np.full(2000, 100, np.int64), 0, "waterfall", ["currency"])
    sizes = [len(f) for f in stream.advance(1500)] + [len(f) for f in stream.flush()]
    assert sum(sizes) == 2000 * 1501
    assert max(sizes) <= LG.FLUSH_ROWS + 2000


def test_days_split_over_batches():
    import pandas as pd
    rows = [("EUR", "A", -1, 0, 500), ("EUR", "B", -1, 0, -100), ("EUR", "A", 0, 1, -50), ("EUR", "B", 0, 1, 30),
            ("EUR", "A", 2, 1, 7), ("GBP", "C", -1, 0, 1), ("JPY", "D", 1, 1, 5)]
    whole = pd.DataFrame(rows, columns=["currency", "account_number", "day", "kind", "cents"])
    run = LG._ledger_kernel(0, 2, "waterfall", ["currency"])
    want = pd.concat(list(run([whole])), ignore_index=True)
    for size in (1, 2, 3):
        parts = [whole.iloc[i:i + size] for i in range(0, len(whole), size)]
        got = pd.concat(list(run(parts)), ignore_index=True)
        pd.testing.assert_frame_equal(got, want)
    assert set(want["currency"]) == {"EUR", "GBP"}      # a pool without accounts has no balances


def test_pools_enter_the_kernel_with_their_first_deficit(spark, monkeypatch):
    """EUR dips on the fifth day, GBP never, JPY opens overdrawn, CHF has no
    movements; the kernel sees no day before, and no pool without a deficit."""
    start, end = dt.date(2026, 1, 1), dt.date(2026, 1, 9)
    day = lambda k: start + dt.timedelta(days=k)
    op = spark.createDataFrame([("A", "EUR", Decimal(10)), ("B", "EUR", Decimal(50)), ("C", "GBP", Decimal(5)), ("D", "JPY", Decimal(-3)),
                                ("E", "JPY", Decimal(9)), ("F", "CHF", Decimal(1)), ("G", None, Decimal(2)), ("H", None, Decimal(-1))], OPEN)
    mv = spark.createDataFrame([(day(1), "A", "EUR", Decimal(-4)), (day(4), "A", "EUR", Decimal(-20)), (day(4), "B", "EUR", Decimal(1)),
                                (day(6), "B", "EUR", Decimal(-90)), (day(2), "C", "GBP", Decimal(-5)), (day(3), "E", "JPY", Decimal(-1)),
                                (day(3), "H", None, Decimal(-9))], MOVE)
    seen = []
    real = LG._swept

    def watched(op, mv, dips, *rest):
        seen.extend(sorted((str(r[0]), r[1] - (start - LG.EPOCH).days) for r in dips.collect()))
        return real(op, mv, dips, *rest)

    monkeypatch.setattr(LG, "_swept", watched)
    out = ledger_roll_forward(op, mv, start, end).collect()
    assert seen == [("EUR", 4), ("JPY", 0), ("None", 0)]
    assert len(out) == 8 * 9
    got = {(r.account_number, (r.date - start).days): (int(r.starting_balance), int(r.total_movements), int(r.sweep_amount), int(r.closing_balance)) for r in out}
    assert got["A", 3] == (6, 0, 0, 6) and got["A", 4] == (6, -20, 14, 0) and got["B", 4] == (50, 1, -14, 37)
    assert got["A", 6] == (0, 0, 0, 0) and got["B", 6] == (37, -90, 0, -53)
    assert got["C", 8] == (0, 0, 0, 0) and got["F", 8] == (1, 0, 0, 1)
    assert got["D", 0] == (-3, 0, 3, 0) and got["E", 3] == (6, -1, 0, 5)
    assert got["H", 0] == (-1, 0, 1, 0) and got["H", 3] == (0, -9, 1, -8) and got["G", 8] == (0, 0, 0, 0)
