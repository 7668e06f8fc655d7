"""Sessions by their gaps against rows held one by one."""

import random
import zlib
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest

from palimpsest.llm import sessions

START = datetime(2024, 1, 1)
US = timedelta(microseconds=1)


def plainly(rows, batches=12, delay=120 * sessions.HOUR, apart=30 * sessions.MINUTE):
    """The contract, row after row: ``rows`` are (click_id, ts, arrived, client) in microseconds."""
    once = {}
    for click, ts, arrived, client in rows:
        if None not in (click, ts, client):
            once[click] = min(once.get(click, (1 << 62, 0, 0)), (ts if arrived is None else arrived, ts, client))
    hours = [a // sessions.HOUR for a, _, _ in once.values()]
    cut = [[] for _ in range(batches)]
    for click, (arrived, ts, client) in once.items():
        b = batches * (arrived // sessions.HOUR - min(hours)) // (max(hours) - min(hours) + 1)
        b += b < batches - 1 and zlib.crc32(f"{client}:{ts // sessions.HOUR}".encode()) % 7 == 0
        cut[b].append((client, ts, zlib.crc32(str(click).encode())))
    opened, out, bound, top = {}, [], None, None  # client: list of (times, checksum, merges)
    for b, arrived in enumerate(cut):
        late = bound
        for client, ts, crc in arrived:
            if late is None or ts >= late:
                opened.setdefault(client, []).append(([ts], crc, None))
            top = ts if top is None else max(top, ts)
        bound = None if top is None else top - delay
        for client, held in opened.items():
            joined = []
            for times, crc, merges in sorted(held, key=lambda s: (min(s[0]), max(s[0]))):
                if joined and min(times) - max(joined[-1][0]) <= apart:
                    old, sums, known = joined[-1]
                    both = [m for m in (known, merges) if m is not None]
                    joined[-1] = (old + times, sums + crc, sum(both) + len(both) - 1 if both else None)
                else:
                    joined.append((times, crc, merges))
            opened[client] = []
            for times, crc, merges in joined:
                if b == batches - 1 or bound is not None and max(times) < bound - apart:
                    label = b if max(times) < bound - apart else batches
                    out.append((client, min(times), max(times), len(times), crc, merges or 0, label))
                else:
                    opened[client].append((times, crc, merges or 0))
    return sorted(out)


def table(spark, rows, zone=True):
    stamp = lambda t: None if t is None else datetime(1970, 1, 1) + t * US
    if zone:
        stamp = lambda t: None if t is None else datetime(1970, 1, 1, tzinfo=timezone.utc) + t * US
    kind = "timestamp" if zone else "timestamp_ntz"
    return spark.createDataFrame([(c, stamp(t), stamp(a), who, "x", 0) for c, t, a, who in rows], f"click_id long, ts {kind}, arrived_at {kind}, client_id long, bucket string, t int")


def made(seed, n, clients, days=9):
    r, base = random.Random(seed), 1_704_067_200_000_000
    rows = []
    for i in range(n):
        ts = base + r.randrange(days * 24) * sessions.HOUR + r.choice([r.randrange(sessions.HOUR), 0, 30 * sessions.MINUTE, 30 * sessions.MINUTE + 1])
        rows.append((i, ts, ts + r.choice([0, 1, 20, 60, 150]) * sessions.HOUR, 0 if r.random() < 0.4 else r.randrange(clients)))
    return rows


def test_gaps_against_rows():
    """Rows of one key in random steps: the stored gaps are those of all rows, totals and merges those of the sessions."""
    for seed in range(60):
        r = random.Random(seed)
        gaps, times, parts = sessions.Gaps.none(), [], []
        for _ in range(6):
            points = [r.randrange(400) for _ in range(r.randrange(12))]
            gaps = sessions.arrive(gaps, *(np.array(x, np.int64) for x in ([7] * len(points), points, points, [1] * len(points), points)), 10) if points else gaps
            fresh = [([p], 0) for p in points]
            joined = []
            for times, merges in sorted(parts + fresh, key=lambda s: (min(s[0]), max(s[0]))):
                known = any(times is p[0] for p in parts)
                if joined and min(times) - max(joined[-1][0]) <= 10:
                    last = joined[-1]
                    joined[-1] = (last[0] + times, last[1] + merges + (known and last[2]), known or last[2])
                else:
                    joined.append((times, merges, known))
            parts = [(t, m) for t, m, _ in joined]
            _, found = sessions.close(gaps, sessions.EVER)
            assert [tuple(map(int, x)) for x in zip(*found[1:], strict=True)] == [(min(t), max(t), len(t), sum(t), m) for t, m in parts]


@pytest.mark.parametrize("seed, zone", [(1, True), (2, False)])
def test_stream_against_rows(spark, seed, zone):
    rows = made(seed, 700, 6)
    rows += [(3, *rows[3][1:]), (9, rows[9][1] + 5, rows[9][2] + 9 * sessions.HOUR, 1), (None, rows[0][1], rows[0][2], 1), (9000, None, rows[0][2], 1), (9001, rows[0][1], rows[0][2], None), (9002, rows[5][1], None, 2)]
    found = sessions.close_sessions(table(spark, rows, zone))
    want = plainly(rows)
    assert sorted(map(tuple, found.collect())) == want
    assert any(w[5] for w in want) and len({w[6] for w in want}) > 3


def test_one_client_and_repeats(spark):
    """One client holds all rows, most at one time; fewer batches than usual, and a state of several buckets."""
    base = 1_704_067_200_000_000
    rows = [(i, base + (i % 3) * sessions.HOUR, base + i * sessions.MINUTE, -5) for i in range(900)]
    got = sessions.close_sessions(table(spark, rows), batches=3, bucket_rows=10)
    assert sorted(map(tuple, got.collect())) == plainly(rows, batches=3)


def test_empty(spark):
    for rows in ([], [(None, None, None, None)]):
        got = sessions.close_sessions(table(spark, rows))
        assert got.collect() == [] and got.columns == [c.split()[0] for c in sessions.RESULT.split(", ")]
