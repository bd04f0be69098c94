from collections import defaultdict
from datetime import timedelta

import numpy as np
import pytest
from builders import NOON, bronze, by_key, silver
from conftest import executed_plan

from vigiltx.operators import detectors


def random_tx(spark, seed, n=400, span=5 * 86_400, channels=("Plataforma_Terceros", "Transferencia_Bancaria")):
    """A few customers; one of them owns a third of all rows."""
    rng = np.random.default_rng(seed)

    def party():
        return "hot" if rng.random() < 0.33 else f"c{rng.integers(5)}"

    rows = [
        (party(), party(), str(rng.choice(channels)), round(float(rng.uniform(1, 100)), 2), int(rng.integers(span)))
        for _ in range(n)
    ]
    return rows, silver(spark, rows)


def sessions_by_hand(rows, gap):
    times = defaultdict(list)
    for origin, _, _, amount, at in rows:
        times[origin].append((at, amount))
    found = set()
    for origin, events in times.items():
        run = []
        for at, amount in sorted(events) + [(10**12, 0.0)]:
            if run and at - run[-1][0] > gap:
                found.add((origin, NOON + timedelta(seconds=run[0][0]), NOON + timedelta(seconds=run[-1][0]),
                           len(run), round(sum(a for _, a in run), 2)))
                run = []
            run.append((at, amount))
    return found


@pytest.mark.parametrize("gap", [59, 600, 3600, 30_000, 86_400])
def test_sessions_match_a_scan_by_hand(spark, gap):
    rows, tx = random_tx(spark, gap)
    got = detectors.burst_sessions(tx, gap)
    assert {(r.customer_id, r.started_at, r.ended_at, r.events, r.amount) for r in got.collect()} == sessions_by_hand(rows, gap)


@pytest.mark.parametrize("step, sessions", [(59, 1), (60, 3)])
def test_session_gap_bound(spark, step, sessions):
    tx = silver(spark, [("a", "b", "c", 1.0, i * step) for i in range(3)])
    assert detectors.burst_sessions(tx).count() == sessions


def test_a_session_may_span_many_slices(spark):
    rows = [("a", "b", "c", 1.0, i * 50_000) for i in range(60)]
    (row,) = detectors.burst_sessions(silver(spark, rows), 50_000).collect()
    assert (row.events, row.amount, row.span_seconds) == (60, 60.0, 59 * 50_000)


def test_sessions_share_one_read(spark, tmp_path):
    path = str(tmp_path / "tx")
    random_tx(spark, 1)[1].write.parquet(path)
    plan = executed_plan(detectors.burst_sessions(spark.read.parquet(path), 600))
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


def test_sessions_are_chained_in_all_shuffle_partitions(spark):
    """Adaptive execution would put all these pieces together in one task."""
    rows, tx = random_tx(spark, 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        sessions = detectors.burst_sessions(tx, 600)
        plan = executed_plan(sessions)
        got = {(r.customer_id, r.started_at, r.ended_at, r.events, r.amount) for r in sessions.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == sessions_by_hand(rows, 600)
    dealt = [line for line in plan.splitlines() if " Exchange hashpartitioning(customer_id" in line and "REPARTITION_BY_NUM" in line and "Reused" not in line]
    assert len(dealt) == 2 and all(", 7), " in line for line in dealt)


def test_near_duplicates(spark):
    def at(second):
        return f"2026-09-01 12:00:{second:02d}"

    rows = [("a", at(0)), ("a", "01/09/2026 12:00:01"), ("a", at(3)), ("b", at(0)), ("b", at(2)),
            ("c", at(0)), ("c", at(0)), ("c", at(1)), ("c", at(1)), ("c", at(1)), (None, at(0)), (None, at(1)), ("d", "never")]
    raw = bronze(spark, [{"tx_id": k, "time_text": t} for k, t in rows])
    got = {(r.tx_id, r.first_at.second, r.second_at.second, r.first_rows, r.second_rows)
           for r in detectors.near_duplicates(raw).collect()}
    assert got == {("a", 0, 1, 1, 1), ("c", 0, 1, 2, 3)}


def test_defects(spark):
    raw = bronze(
        spark,
        [{"tx_id": None}, {"tx_id": "k"}, {"tx_id": "k", "currency": " pen "}, {"tx_id": "u", "time_text": "01/09/2026 12:00:00"}],
    )
    (row,) = detectors.defect_profile(raw).collect()
    assert row.asDict() == {"bronze_rows": 4, "slash_dates": 1, "nonstandard_currencies": 1, "missing_keys": 1, "repeated_key_rows": 2}
    assert detectors.defect_profile(raw.limit(0)).first().missing_keys == 0


@pytest.mark.parametrize(
    "amounts, found",
    [
        ([5000.0, 5000.01], False), ([3000.0, 3000.0, 4000.0], False), ([3000.0, 3000.0, 4000.01], True),
        ([2500.0] * 5, True), ([2500.0] * 6, False), ([10000.0, 100.0, 100.0], False),
    ],
)
def test_cash_splitting(spark, amounts, found):
    tx = silver(spark, [("a", "a", "Deposito_Efectivo", x, i) for i, x in enumerate(amounts)])
    assert detectors.cash_splitting(tx).count() == int(found)


IN, OUT = "Plataforma_Terceros", "Transferencia_Bancaria"


@pytest.mark.parametrize(
    "out, at, found",
    [(899.9, 10, False), (900.0, 10, True), (900.0, -10, False), (900.0, 200_000, True), (9999.0, 10, True)],
)
def test_pass_through(spark, out, at, found):
    tx = silver(spark, [("x", "a", IN, 400.0, -5), ("y", "a", IN, 600.0, 0), ("a", "z", OUT, out, at)])
    assert detectors.pass_through(tx).count() == int(found)


@pytest.mark.parametrize("limit_case, found", [(9998.99, False), (9999.0, True), (10000.0, False)])
def test_pass_through_near_the_limit(spark, limit_case, found):
    tx = silver(spark, [("x", "a", IN, 50_000.0, 0), ("a", "z", OUT, limit_case, 10)])
    assert detectors.pass_through(tx).count() == int(found)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pass_through_matches_a_scan_by_hand(spark, seed):
    rows, tx = random_tx(spark, seed, n=150, span=3 * 86_400)
    want = {}
    for who in {r[0] for r in rows}:
        into = [(at, x) for _, d, c, x, at in rows if d == who and c == IN]
        if not into:
            continue
        last = max(into)[0]
        out = [x for o, _, c, x, at in rows if o == who and c == OUT and at > last]
        if out and round(sum(out), 2) >= 0.001 * round(sum(x for _, x in into), 2):
            want[who] = (len(into), round(sum(x for _, x in into), 2), len(out), round(sum(out), 2))
    got = detectors.pass_through(tx, min_share=0.001, limit=None)
    assert {k: (r["in_count"], r["in_total"], r["out_count"], r["out_total"]) for k, r in by_key(got).items()} == want


def test_time_profile(spark):
    hours = [0, 1, 5, 6, 9, 18, 19]
    tx = silver(spark, [("a", "b", "c", 1.0, (h - 12) * 3600) for h in hours] + [("n", "b", "c", 1.0, None)])
    got = by_key(detectors.time_profile(tx))
    assert (got["a"]["night_count"], got["a"]["office_count"], got["a"]["weekend_count"]) == (2, 2, 0)
    assert got["a"]["night_share"] == 2 / 7
    assert got["n"]["timed_count"] == 0 and got["n"]["night_share"] is None
    saturday = silver(spark, [("a", "b", "c", 1.0, 4 * 86_400)])
    assert detectors.time_profile(saturday).first().weekend_share == 1.0


WALLET, EXCHANGE = "Crypto_Wallet", "Exchange_Crypto"


@pytest.mark.parametrize(
    "inbound, exits, total, found",
    [(5, ["e"], 500.0, True), (4, ["e"], 400.0, False), (5, ["e", "f"], 500.0, False), (5, ["e"], 400.0, False)],
)
def test_single_exit(spark, inbound, exits, total, found):
    rows = [(f"x{i}", "a", WALLET, 100.0, i) for i in range(inbound)]
    rows += [("a", e, EXCHANGE, total / len(exits), 100) for e in exits]
    assert detectors.single_exit(silver(spark, rows)).count() == int(found)


def test_single_exit_counts_exchange_outflow_only(spark):
    rows = [(f"x{i}", "a", WALLET, 100.0, i) for i in range(5)]
    rows += [("a", "e", EXCHANGE, 500.0, 100), ("a", "friend", WALLET, 1.0, 101)]
    (row,) = detectors.single_exit(silver(spark, rows)).collect()
    assert (row.in_count, row.out_count, row.exits, row.out_total) == (5, 1, 1, 500.0)


@pytest.mark.parametrize("amounts", [[9.5e16], [5e16, 5e16], [5e16, 5e16, 0.25]])
def test_large_amounts_stay_in_all_totals(spark, amounts):
    want = sum(amounts)
    rows = [("x", "a", "Plataforma_Terceros", v, i) for i, v in enumerate(amounts)]
    rows += [("a", "y", "Transferencia_Bancaria", v, 100 + i) for i, v in enumerate(amounts)]
    assert {r.amount for r in detectors.burst_sessions(silver(spark, rows)).collect()} == {want}
    (row,) = detectors.pass_through(silver(spark, rows)).collect()
    assert (row.in_total, row.out_total) == (want, want)
    rows = [("x", "a", "Crypto_Wallet", v, i) for i, v in enumerate(amounts)] + [("a", "y", "Exchange_Crypto", v, i) for i, v in enumerate(amounts)]
    (row,) = detectors.single_exit(silver(spark, rows[::-1]), min_inbound=1).collect()
    assert (row.in_total, row.out_total) == (want, want)
    rows = [("a", "y", "Cajero", v, i) for i, v in enumerate(amounts)]
    (row,) = detectors.cash_splitting(silver(spark, rows), deposits=(1, 5), each_below=1e18).collect()
    assert row.amount == want


def test_an_infinite_amount_shows(spark):
    rows = [("a", "y", "c", 1.0, 0), ("a", "y", "c", float("inf"), 5)]
    assert [r.amount for r in detectors.burst_sessions(silver(spark, rows)).collect()] == [float("inf")]
