"""Keyed state by bucket: calls to state per micro-batch, not per row; queues longer than an entry."""

import random
from collections import deque
from types import SimpleNamespace

import pytest

from eventide.streaming import stateful as ST

from .test_stream_state import FakeHandle, FakeState, drive


class Counted(FakeState):
    calls = 0

    def __getattribute__(self, name):
        if name in ("getValue", "updateValue", "removeKey", "get", "update", "clear"):
            Counted.calls += 1
        return super().__getattribute__(name)


@pytest.fixture
def counted(monkeypatch):
    Counted.calls = 0
    monkeypatch.setattr(FakeHandle, "_state", lambda self, name, *_: self.states.setdefault(name, Counted(self.reads)))
    monkeypatch.setattr(FakeHandle, "getMapState", FakeHandle._state)
    monkeypatch.setattr(FakeHandle, "getValueState", FakeHandle._state)


def _rows(n, keys, seed, **extra):
    """Rows of many keys, each about alone in its minute."""
    rng = random.Random(seed)
    return [SimpleNamespace(id=i, ts=rng.randrange(n) * 60_000_000, of=rng.choice(keys), **{k: f(rng) for k, f in extra.items()})
            for i in range(n)]


def _batches(rows, n):
    """In order of arrival, at most 2,000 minutes late, with the watermark behind."""
    rng, top = random.Random(1), 0
    rows = sorted(rows, key=lambda r: r.ts + rng.randrange(2_000) * 60_000_000)
    for at in range(0, len(rows), n):
        some = rows[at:at + n]
        yield some, top
        top = max(top, max(r.ts for r in some) // 1000 - 2_000 * 60_000)
    yield [], 10 ** 12


def test_sparse_keys_cost_few_calls_to_state(counted):
    rows = _rows(20_000, [*range(60), None], 3)
    processor = ST.RunningCountProcessor()
    got = {r.id: (r.key, r.running_count) for r in drive(processor, _batches(rows, 4_000))}
    n, want = {}, {}
    for r in sorted(rows, key=lambda r: (r.ts, r.id)):
        n[r.of] = n.get(r.of, 0) + 1
        want[r.id] = (r.of, n[r.of])
    assert got == want
    assert Counted.calls < len(rows) / 50 and len(processor.handle_seen.timers) <= 6


@pytest.mark.parametrize("seed", range(3))
def test_deadlines_of_many_keys_in_a_bucket(counted, seed):
    within = [30, 600, 30_000][seed] * 60_000_000
    rows = _rows(6_000, [*range(20), None], seed, is_first=lambda r: r.random() < .6, is_then=lambda r: r.random() < .05)
    got = {(r.first_id, r.then_id, r.kind) for r in drive(ST.FollowedByProcessor(within), _batches(rows, 1_500))}
    waits, want = {}, set()
    for r in sorted(rows, key=lambda r: (r.ts, r.id)):
        mine = waits.setdefault(r.of, deque())
        while mine and mine[0].ts + within <= r.ts:
            want.add((mine.popleft().id, None, "timeout"))
        while r.is_then and mine:
            want.add((mine.popleft().id, r.id, "match"))
        if r.is_first:
            mine.append(r)
    want |= {(w.id, None, "timeout") for mine in waits.values() for w in mine}
    assert got == want and Counted.calls < len(rows) / 10


def test_queue_longer_than_an_entry_keeps_order_and_reads_its_ends():
    handle = FakeHandle()
    pages, rng, want, n, most = handle.getMapState("pages"), random.Random(5), deque(), 0, 0
    items: list = []
    for _ in range(400):
        queue = ST.KeyQueue(pages, None, "open", items)
        for _ in range(rng.randrange(300)):
            queue.push((n, n * 10))
            want.append((n, n * 10))
            n += 1
        for _ in range(rng.randrange(60 if n < 30_000 else 900)):
            if want:
                assert queue.pop() == want.popleft()
            assert bool(queue) == bool(want)
        items = queue.items()
        most = max(most, len(items))
    assert n > 30_000 and most <= 2 * ST.PIECE_ROWS + 1 and max(handle.reads) <= ST.PIECE_ROWS
    queue = ST.KeyQueue(pages, None, "open", items)
    assert [queue.pop() for _ in range(len(want))] == list(want) and not queue and not pages.data


def test_hot_key_waiting_for_a_partner_stays_in_pages():
    """20,000 open rows of one key: a firing holds the ends of the queue."""
    rows = [SimpleNamespace(id=i, ts=i * 1_000_000, side="left") for i in range(20_000)]
    processor = ST.ReconcileProcessor(10 ** 12)
    list(drive(processor, [(rows[:10_000], 0), (rows[10_000:], 10_000_000), ([], 100_000_000)]))
    states = processor.handle_seen.states
    assert sum(len(v[0]) for v in states["values"].data.values()) <= 2 * ST.PIECE_ROWS + 1
    assert len(states["pages"].data) >= 38


def test_piece_that_ends_after_the_watermark_is_put_back():
    rows = [SimpleNamespace(id=i, ts=i * 30_000_000) for i in range(100)]
    found = drive(ST.RunningCountProcessor(), [(rows, 0), ([], 600_000), ([], 600_001), ([], 10 ** 9)])
    assert [r.id for r in found] == list(range(100))
