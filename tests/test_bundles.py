"""Bundles in columns: they find what each entity finds by itself, and Python does not run through all the steps of each entity."""

import random
import sys

import pandas as pd
from pyspark.sql import Row

from playcohort.streaming import state
from tests.test_state_calls import Handle, added_up, fed

MONTHS = ["2023-12", "2024-01", "2024-02"]


def moment(r):
    return f"{r.choice(MONTHS)}-{r.choice((1, 2, 27, 28)):02d} {r.choice((0, 5, 23)):02d}:{r.randrange(60):02d}:07"


def devices(n):
    return [("opera" if i % 2 else "market", i % 3 - 1, "m", "" if i % 5 else 's"\n', "p", None if i == 7 else "" if i == 8 else f"d{i}") for i in range(n)]


def device_batches(r, entities, batches=4, rows=150):
    return [[Row(**dict(zip(state.DEVICE, r.choice(entities), strict=True)), hour=moment(r)[:13]) for _ in range(rows)] for _ in range(batches)]


def account_batches(r, accounts, batches=5, rows=120):
    def one(i):
        at, who, game = moment(r), r.choice(accounts), r.randrange(-1, 3)
        if r.random() < 0.3:
            return Row(game_account=who, time=at, game_id=game, parent_channel=r.choice("mx"), child_channel="", pkg_code="p", order_no=None, money=0, price=0)
        price = r.choice((0, 1, 2**40))
        return Row(game_account=who, time=at, game_id=game, parent_channel=None, child_channel=None, pkg_code=None, order_no=f"o{i}", money=price + r.randrange(2), price=price)

    return [[one(b * rows + i) for i in range(rows)] for b in range(batches)]


def bundled(one, keys, batches):
    """Changes of a bundle that gets its rows in frames, as from a stream."""
    bundle, out = state.Bundle(one, keys), []
    bundle.init(Handle())
    for rows in batches:
        half = len(rows) // 2
        frames = [pd.DataFrame([r.asDict() for r in part]) for part in (rows[:half], rows[half:])]
        for found in bundle.handleInputRows((1,), iter(frames), None):
            out += [Row(**dict(zip(found.columns, t, strict=True))) for t in zip(*[found[c].tolist() for c in found.columns], strict=True)]
    return out


def one_by_one(make, keys, batches):
    out, entities = [], {tuple(r[k] for k in keys) for rows in batches for r in rows}
    for entity in entities:
        mine = [[r for r in rows if tuple(r[k] for k in keys) == entity] for rows in batches]
        out += fed(make(), entity, *[rows for rows in mine if rows])[0]
    return out


def test_bundles_equal_their_entities_over_late_days_and_moved_owners():
    for seed in range(6):
        r = random.Random(seed)
        for make in (state.Registrations, state.Activations):
            batches = device_batches(r, devices(12))
            got, want = added_up(bundled(make(), state.DEVICE, batches)), added_up(one_by_one(make, state.DEVICE, batches))
            assert got == want and got
        batches = account_batches(r, [f"a{i}" for i in range(9)])
        got, want = added_up(bundled(state.Payments(), ["game_account"], batches)), added_up(one_by_one(state.Payments, ["game_account"], batches))
        assert got == want and {place[0] for place in got} == {"money", "money_hour", "payer", "payer_hour", "ltv", "first_payer"}


def calls_of(one, keys, rows):
    """Python functions entered while a bundle takes the rows, and the changes it finds."""
    bundle, entered = state.Bundle(one, keys), 0
    bundle.init(Handle())

    def count(frame, event, arg):
        nonlocal entered
        entered += event == "call" and "playcohort" in frame.f_code.co_filename

    before = sys.getprofile()
    sys.setprofile(count)
    try:
        out = list(bundle.handleInputRows((1,), iter(rows), None))
    finally:
        sys.setprofile(before)
    return entered, out


def test_python_steps_and_changes_do_not_grow_with_the_entities():
    """Twenty times the devices and accounts of the same hours and places: as many changes, and not twenty times the calls."""
    regi = lambda i: Row(**dict(zip(state.DEVICE, ("opera", 1, "", "", "", f"d{i}"), strict=True)), hour=f"2024-01-03 {i % 4:02d}")
    paid = lambda i: Row(game_account=f"a{i}", time=f"2024-01-03 {i % 4:02d}:00:00", game_id=1, parent_channel=None, child_channel=None, pkg_code=None, order_no=f"o{i}", money=3, price=2)
    for make, keys, row in ((state.Registrations, state.DEVICE, regi), (state.Activations, state.DEVICE, regi), (state.Payments, ["game_account"], paid)):
        (few, small), (many, large) = (calls_of(make(), keys, [row(i) for i in range(n)]) for n in (100, 2000))
        assert len(large) == len(small) and many < few + 4 * 1900
        assert sum(sum(r.m) for r in large) == 20 * sum(sum(r.m) for r in small)
