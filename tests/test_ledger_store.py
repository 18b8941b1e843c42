"""The ledger kept file by file equals the ledger rolled from all movements."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tesoro.operators.ledger import balance_roll_forward
from tesoro.session import scratch_path
from tesoro.streaming.ledger_store import LedgerStore, ledger_stream

START, END = dt.date(2026, 1, 1), dt.date(2026, 4, 20)
SCHEMA = "source_file string, account_number string, date date, amount decimal(18,2)"


def accounts(spark):
    return spark.createDataFrame([(f"A{i}", "EUR" if i % 2 else "USD", Decimal(100 * i) if i else None) for i in range(6)],
                                 "account_number string, currency string, opening_balance decimal(18,2)")


def day_file(rng, day, n=6):
    return [(f"A{rng.randrange(6)}", day, Decimal(rng.randrange(-5000, 5000)) / 100) for _ in range(n)]


def frame(spark, files):
    return spark.createDataFrame([(name, *r) for name, rows in files.items() for r in rows], SCHEMA)


def balances(df):
    return {(r.account_number, r.date): (r.currency, r.starting_balance, r.total_movements, r.closing_balance) for r in df.collect()}


def batch(spark, files):
    return balances(balance_roll_forward(accounts(spark), frame(spark, files), START, END))


def commits(store, kind):
    return {p: c for p, c in store.manifest().parts.items() if p.startswith(f"part={kind}-")}


def test_file_by_file_equals_the_batch(spark):
    rng = random.Random(4)
    days = [dt.date(2026, 1, 5), dt.date(2026, 1, 31), dt.date(2026, 2, 1), dt.date(2026, 4, 2), dt.date(2026, 4, 20)]
    files = {f"f{i}": day_file(rng, d) for i, d in enumerate(days)}
    store, loaded = LedgerStore(spark, scratch_path(spark, "t-ledger")), {}
    for name, rows in files.items():
        store.apply(frame(spark, {name: rows}))
        loaded[name] = rows
    assert balances(store.balances(accounts(spark), START, END)) == batch(spark, loaded)
    assert store.months(store.manifest()) == ["c-2026-01", "c-2026-02", "c-2026-04"]

    # a late file in a month without one: earlier months stay as they are
    before = commits(store, "c")
    loaded["late"] = day_file(rng, dt.date(2026, 3, 15))
    store.apply(frame(spark, {"late": loaded["late"]}))
    after = commits(store, "c")
    assert [after[f"part=c-2026-0{i}"] == before[f"part=c-2026-0{i}"] for i in (1, 2)] == [True, True]
    assert after["part=c-2026-04"] != before["part=c-2026-04"] and "part=c-2026-03" in after
    want = batch(spark, loaded)
    assert balances(store.balances(accounts(spark), START, END)) == want

    # the same file again: same balances, no month written
    store.apply(frame(spark, {"late": loaded["late"]}))
    assert commits(store, "c") == after
    assert balances(store.balances(accounts(spark), START, END)) == want

    # a corrected file that leaves its former day, and two files in one batch
    loaded["f1"] = day_file(rng, dt.date(2026, 2, 10))
    loaded["f9"] = day_file(rng, dt.date(2026, 4, 3), 40)
    store.apply(frame(spark, {k: loaded[k] for k in ("f1", "f9")}))
    want = batch(spark, loaded)
    assert balances(store.balances(accounts(spark), START, END)) == want
    # any span starts from the closings of the month before it
    for lo, hi in ((dt.date(2026, 3, 10), dt.date(2026, 4, 5)), (dt.date(2026, 4, 1), END)):
        assert balances(store.balances(accounts(spark), lo, hi)) == {k: v for k, v in want.items() if lo <= k[1] <= hi}
    closing = {r.account_number: r.opening_balance for r in store.closing(accounts(spark)).collect()}
    assert closing == {a: want[a, END][3] for a in closing} and len(closing) == 6


def test_a_lost_load_changes_nothing(spark, monkeypatch):
    rng = random.Random(5)
    files = {"a": day_file(rng, dt.date(2026, 1, 9)), "b": day_file(rng, dt.date(2026, 1, 10))}
    store = LedgerStore(spark, scratch_path(spark, "t-ledger"))
    store.apply(frame(spark, {"a": files["a"]}))
    with monkeypatch.context() as m:
        m.setattr(LedgerStore, "_publish", lambda self, manifest: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            store.apply(frame(spark, {"b": files["b"]}))
    assert balances(store.balances(accounts(spark), START, END)) == batch(spark, {"a": files["a"]})
    store.apply(frame(spark, {"b": files["b"]}))
    assert balances(store.balances(accounts(spark), START, END)) == batch(spark, files)


def test_odd_rows(spark):
    store = LedgerStore(spark, scratch_path(spark, "t-ledger"))
    assert store.apply(frame(spark, {})) is None and store.manifest() is None
    day = dt.date(2026, 1, 2)
    odd = [("A1", day, None), (None, day, Decimal(5)), ("A1", None, Decimal(5)), ("Z", day, Decimal(5)), ("A2", day, Decimal("1.25"))]
    store.apply(frame(spark, {"x": odd}).withColumn("part", F.lit("clash")))
    assert balances(store.balances(accounts(spark), START, END)) == batch(spark, {"x": odd})
    # only bad rows left in the corrected file: its former movement goes
    store.apply(frame(spark, {"x": odd[1:3]}))
    assert balances(store.balances(accounts(spark), START, END)) == batch(spark, {"x": odd[1:3]})


def test_stream_loads_each_file_once(spark, tmp_path):
    rng = random.Random(6)
    files = {f"f{i}": day_file(rng, dt.date(2026, 1, 2 + i)) for i in range(4)}
    store = LedgerStore(spark, scratch_path(spark, "t-ledger"))
    (tmp_path / "in").mkdir()
    ddl = "account_number string, date date, amount decimal(18,2)"
    for part in (["f0", "f1", "f2"], ["f3"], []):
        for name in part:
            lines = ["account_number,date,amount"] + [f"{a},{d},{x}" for a, d, x in files[name]]
            (tmp_path / "in" / f"{name}.csv").write_text("\n".join(lines) + "\n")
        ledger_stream(spark, str(tmp_path / "in"), ddl, store, str(tmp_path / "ck"), max_files=2)
    assert balances(store.balances(accounts(spark), START, END)) == batch(spark, files)
    assert store.versions() == [1, 2, 3]
