"""What the plans of the shared steps shuffle: rows of the facts, not the rows
or bitmaps that are made of them."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tesoro.operators import distinct as X
from tesoro.operators import ledger as LG
from tesoro.operators.sweep import sweep_transfers
from tesoro.plans import bindings as B

DAY = dt.date(2026, 1, 1)
OPEN = "account_number string, currency string, opening_balance decimal(18,2)"
MOVE = "date date, account_number string, currency string, amount decimal(18,2)"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def weekly(spark):
    rows = [(f"id{i % 40}", DAY + dt.timedelta(days=7 * (i % 5)), "AB"[i % 2]) for i in range(200)]
    f = spark.createDataFrame(rows, "id string, week date, bank string")
    return X.distinct_state(f, "id", ["week", "bank"], X.numbered_ids(f, "id", "week"))


def test_no_part_of_a_bitmap_is_shuffled(spark):
    p = plan(weekly(spark))
    whole, partial = p.index("bitmap_construct_agg"), p.index("partial_bitmap_construct_agg")
    assert "Exchange" not in p[whole:partial]


def test_bitmaps_are_united_before_they_are_repeated(spark):
    state = X._written(weekly(spark), "t-weekly")
    rolling, cube = plan(X.distinct_rolling(state, "week", 7, 3)), plan(X.distinct_cube(state, ["bank"]))
    assert rolling.rindex("bitmap_or_agg") > rolling.index("Generate")
    assert cube.rindex("bitmap_or_agg") > cube.index("Expand")


def test_daily_balances_are_not_shuffled(spark):
    op = spark.createDataFrame([("A", "EUR", Decimal(10)), ("A", "EUR", Decimal(10)), ("B", "EUR", None), (None, "EUR", Decimal(1))], OPEN)
    mv = spark.createDataFrame([(DAY, "A", "EUR", Decimal(5)), (DAY + dt.timedelta(2), "A", "EUR", Decimal(-1)), (DAY, "X", "EUR", Decimal(9)),
                                (DAY + dt.timedelta(1), "B", "EUR", None)], MOVE)
    out = LG.balance_roll_forward(op, mv, DAY, DAY + dt.timedelta(days=3))
    p = plan(out)
    assert "Exchange" not in p[:p.index("Generate explode(sequence")]
    got = sorted((r.account_number or "", r.date.day, int(r.starting_balance), int(r.total_movements), int(r.closing_balance)) for r in out.collect())
    # each of two rows of an account counts both rows' movements, one after the other
    assert got == [("", d, 1, 0, 1) for d in (1, 2, 3, 4)] + [
        ("A", 1, 10, 5, 15), ("A", 1, 15, 5, 20), ("A", 2, 20, 0, 20), ("A", 2, 20, 0, 20), ("A", 3, 19, -1, 18), ("A", 3, 20, -1, 19),
        ("A", 4, 18, 0, 18), ("A", 4, 18, 0, 18)] + [("B", d, 100000, 0, 100000) for d in (1, 2, 3, 4)]


def test_ledger_days_are_sorted_once(spark):
    op = spark.createDataFrame([("A", "EUR", 100), ("B", None, 5)], "account_number string, currency string, open long")
    mv = spark.createDataFrame([("A", "EUR", 2, 7), ("B", None, 3, -9), ("X", "EUR", 2, 1)], "account_number string, currency string, day int, cents long")
    days = LG.account_days(op, mv, ["currency"], 1, 5)
    assert plan(days).count("Exchange") == 1
    got = sorted((r.account_number, r.day, r.kind, r.cents, r.after, r.next) for r in days.collect())
    assert got == [("A", 0, 0, 100, 100, 2), ("A", 2, 1, 7, 107, 6), ("B", 0, 0, 5, 5, 3), ("B", 3, 1, -9, -4, 6)]


def test_pools_are_dealt_once(spark):
    b = spark.createDataFrame([(DAY, a, "EUR", Decimal(v)) for a, v in [("a", 7), ("b", -3), ("c", -6), ("d", 1)]],
                              "date date, account_number string, currency string, closing_balance decimal(18,2)")
    t = sweep_transfers(b)
    assert plan(t).count("Exchange") == 1
    assert sorted((r.deficit_acct, r.surplus_acct, int(r.amount)) for r in t.collect()) == [("b", "a", 1), ("b", "d", 1), ("c", "a", 6)]


def test_movements_are_numbered_before_their_texts_are_added(spark, tmp_path):
    line = dict(l_orderkey=1, l_linenumber=1, l_partkey=1, l_suppkey=1, l_extendedprice=10.0, l_returnflag="R", l_linestatus="F",
                l_shipdate=dt.datetime(2026, 1, 1), l_quantity=1.0)
    tables = {"lineitem": [line, {**line, "l_returnflag": "N", "l_linenumber": 2}], "supplier": [dict(s_suppkey=1, s_nationkey=0, s_acctbal=1.0)],
              "nation": [dict(n_nationkey=0, n_name="N0", n_regionkey=0)], "region": [dict(r_regionkey=0, r_name="R0")]}
    for name, rows in tables.items():
        spark.createDataFrame(rows).write.parquet(f"{tmp_path}/{name}.parquet")
    m = B.movements(B.Tables(spark, str(tmp_path)))
    p = plan(m)
    assert "Withdraw" in p[:p.index("Window")] and "Withdraw" not in p[p.index("Window"):]
    got = [(r.transaction_id[-1], r.type, r.category, float(r.amount), r.description) for r in m.orderBy(F.col("transaction_id")).collect()]
    assert got == [("1", "Withdraw", "Transactions", -10.0, "Withdraw movement"), ("2", "Charges", "Fees", -0.1, "Bank charges")]


def line_tables(spark, path):
    """Two suppliers in N1, one in the base currency, one of an unknown nation."""
    rows = [dict(l_orderkey=i, l_linenumber=1, l_partkey=i, l_suppkey=i % 5 or None, l_extendedprice=100.0 * (i % 7 + 1), l_returnflag="RAN"[i % 3],
                 l_linestatus="OF"[i % 2], l_shipdate=dt.datetime(2026, 1, 29) + dt.timedelta(days=i % 4), l_quantity=float(i % 2 + 1)) for i in range(60)]
    tables = {"lineitem": rows, "supplier": [dict(s_suppkey=k, s_nationkey=n, s_acctbal=50.0 * k) for k, n in ((1, 0), (2, 1), (3, 1), (4, 9))],
              "nation": [dict(n_nationkey=k, n_name=f"NATION_{k}", n_regionkey=0) for k in (0, 1)], "region": [dict(r_regionkey=0, r_name="R0")]}
    for name, table in tables.items():
        spark.createDataFrame(table).write.parquet(f"{path}/{name}.parquet")
    return B.Tables(spark, str(path))


def test_lines_are_not_shuffled_to_meet_their_accounts(spark, tmp_path):
    t = line_tables(spark, tmp_path)
    m = B.unnumbered_movements(t)
    assert "Exchange hashpartitioning" not in plan(m)
    known = {1, 2, 3}
    assert sorted(r.l_orderkey for r in m.collect()) == [i for i in range(60) if i % 5 in known]


def test_only_sums_meet_the_rates(spark, tmp_path):
    from tesoro.plans import q_fx, q_rules, q_treasury
    t = line_tables(spark, tmp_path)
    out = q_rules.d15(t)
    assert not t.known("ledger")                     # accounts x days are not written
    assert "partial_sum(amount" in plan(out)         # lines are summed before they are shuffled
    rate = {(r.date, r.currency): r.fx_to_usd for r in q_fx.history(t).collect()}
    usd = lambda rows, col: round(sum(float(r[col]) / rate[r.date, r.currency] for r in rows), 4)
    led, mv = q_treasury.ledger(t).collect(), B.movements(t).collect()
    rows = out.collect()
    got = {r.date: r for r in rows}
    assert sorted(got) == [dt.date(2026, 1, 29) + dt.timedelta(days=k) for k in range(4)]
    for day, r in got.items():
        own, moved = [x for x in led if x.date == day], [x for x in mv if x.date == day]
        want = (usd(own, "closing_balance"), usd(own, "total_movements"), usd([x for x in moved if x.type == "Deposit"], "amount"),
                -usd([x for x in moved if x.type == "Withdraw"], "amount"), usd(own, "closing_balance") if day == dt.date(2026, 1, 31) else None)
        assert all(a == b if b is None else abs(a - b) < 2e-4 for a, b in zip((r.closing_usd, r.movements_usd, r.deposits_usd, r.withdrawals_usd, r.month_end_closing_usd), want))
    # the sums are the same when an earlier query has staged the ledger
    again = B.Tables(spark, str(tmp_path))
    q_treasury.ledger(again)
    assert sorted(q_rules.d15(again).collect()) == sorted(rows)


def trade_tables(spark, path):
    """Order 2 stands twice, customer 11 twice, customer 13 nowhere."""
    line = lambda k, n, part, size: dict(l_orderkey=k, l_linenumber=n, l_partkey=part, l_suppkey=1, l_quantity=1.0, l_extendedprice=size, l_discount=0.05,
                                         l_tax=0.01, l_returnflag="R", l_linestatus="F", l_shipdate=dt.datetime(2026, 1, 1))
    order = lambda k, c, day: dict(o_orderkey=k, o_custkey=c, o_orderstatus="F", o_orderdate=dt.datetime(2026, 1, day))
    tables = {"lineitem": [line(1, 2, 3, 20.0), line(1, 1, 1, 10.0), line(2, 1, 0, 30.0), line(3, 1, 0, 40.0), line(9, 1, 0, 50.0)],
              "orders": [order(1, 10, 5), order(2, 13, 6), order(2, 11, 7), order(3, 13, 8)],
              "customer": [dict(c_custkey=k, c_mktsegment=m) for k, m in ((10, "A"), (11, "B"), (11, None), (12, "C"))]}
    for name, rows in tables.items():
        spark.createDataFrame(rows, "c_custkey long, c_mktsegment string" if name == "customer" else None).write.parquet(f"{path}/{name}.parquet")
    return B.Tables(spark, str(path))


def test_orders_meet_customers_before_their_lines(spark, tmp_path):
    legs = B.legs(trade_tables(spark, tmp_path))
    got = sorted((r.trade_id, r.bank_id or "", r.trade_date.day, float(r.trade_size_usd)) for r in legs.collect())
    assert got == [(1, "A", 5, 10.0), (1, "A", 5, 20.0), (2, "", 7, 30.0), (2, "B", 7, 30.0)]
    assert sorted((r.trade_id, float(r.trade_size_usd), r.leg_id) for r in legs.filter("trade_id = 1").collect()) == [(1, 10.0, 1), (1, 20.0, 2)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = [x for x in plan(legs.groupBy("trade_id").agg(F.min("leg_id"), F.min("bank_id"))).splitlines() if "Exchange hashpartitioning" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # lines and orders by order, orders and customers by customer; the joined lines are dealt no more
    assert sorted(x.split("(")[1].split("#")[0] for x in lines) == ["c_custkey", "l_orderkey", "o_custkey", "o_orderkey"]


def test_valued_days_come_from_trades_that_are_kept(spark, tmp_path):
    from tesoro.plans.q_collateral import trade_mtm
    m = trade_mtm(trade_tables(spark, tmp_path))
    p = plan(m)
    assert "l_orderkey" not in p                                    # the lines are not shuffled again for each load
    assert p.count("Exchange hashpartitioning") == 1 and p.index("Generate explode(sequence") < p.index("Exchange hashpartitioning")
    got = sorted((r.trade_id, r.report_date.day, r.bank_id, float(r.trade_size_usd), round(float(r.mtm), 6)) for r in m.filter("trade_id = 1").collect())
    # 4 % a year's steps of (day mod 5) - 2 hundredths: 5, 6, 7, 8, 9 January
    assert got == [(1, 5, "A", 10.0, -0.0008), (1, 6, "A", 10.0, -0.0012), (1, 7, "A", 10.0, -0.0012), (1, 8, "A", 10.0, -0.0008), (1, 9, "A", 10.0, 0.0)]


def test_balance_files_are_read_and_written_without_a_shuffle(spark, tmp_path):
    from tesoro.plans import q_io, q_treasury
    t = line_tables(spark, tmp_path)
    out = q_io.s04(t)
    assert "Exchange hashpartitioning" not in plan(out)
    files = {f.rsplit("/", 1)[0].rsplit("/", 1)[1]: f for f in out.inputFiles() if ".csv" in f}
    assert sorted(files) == ["narrow", "wide"] and all(f.endswith(".csv.gz") for f in files.values())
    names = {r.account_number: (r.bank_id, r.bank_name) for r in B.accounts(t).collect()}
    want = sorted((*names[r.account_number], r.account_number, r.currency, *map(float, (r.starting_balance, r.total_movements, r.closing_balance)), r.date)
                  for r in q_treasury.ledger(t).collect())
    assert sorted(map(tuple, out.collect())) == want and len(want) == 12


def test_ledger_rows_come_once_for_each_row_of_their_account(spark):
    from tesoro.plans.q_io import per_account_row
    led = spark.createDataFrame([(a, d) for a in ("A", "B", None) for d in (1, 2)], "account_number string, day int")
    accounts = spark.createDataFrame([("A", "x"), ("B", "y"), ("B", "z"), (None, "w")], "account_number string, bank_name string")
    out = per_account_row(led, accounts)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, led.join(accounts.select("account_number"), "account_number").collect()))
    assert "Exchange hashpartitioning" not in plan(out)
