from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from replaykit.llm import suffix_dedup

from .corpora import documents, empty, prose

W = suffix_dedup.WINDOW


def expected(rows):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + W] for _, b in raws for p in range(len(b) - W + 1))
    out = Counter()
    for i, b in raws:
        gone = bytearray(len(b))
        for p in range(len(b) - W + 1):
            if seen[b[p : p + W]] > 1:
                gone[p : p + W] = b"\1" * W
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[(i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def answer(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removals(df).collect())


def test_the_cover_meets_every_difference_once():
    d = suffix_dedup.COVER
    assert len(d) == 12
    assert Counter(int(a - b) % suffix_dedup.V for a in d for b in d if a != b) == Counter(range(1, suffix_dedup.V))


def test_equals_brute_force_on_edge_cases(spark):
    df = documents(spark, extra=True)
    assert answer(df) == expected([(r.doc_id, r.text) for r in df.collect()])


@pytest.mark.parametrize("limit", (4096, 2))
def test_overlaps_borders_and_crowded_cores(spark, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "GROUP_LIMIT", limit)
    base, other = prose(1, 200), prose(2, 200)
    items = [base[a : a + n] + f"<{a}{n}>" + other[b : b + m] for a, n, b, m in [
        (0, 400, 0, 199), (10, 300, 5, 200), (90, 310, 7, 201), (300, 205, 100, 330), (301, 400, 0, 150), (0, 199, 99, 260), (200, 700, 50, 350),
    ]]
    items += ["ab" * 300, "ba" * 110, base[50:250], base[50:249]]
    df = documents(spark, items=items)
    assert answer(df) == expected([(r.doc_id, r.text) for r in df.collect()])


def test_empty_table(spark):
    assert suffix_dedup.removals(empty(spark)).count() == 0


def test_places_of_a_very_long_text_are_kept():
    n, place = (1 << 23) + 10, (1 << 23) + 5

    def unit(core):
        one = np.zeros(1, np.int64)
        samples = [core, np.zeros(len(core), np.uint64), one + len(core), one, np.zeros(1, np.uint8), one + len(core)]
        return suffix_dedup._packed([tuple(samples)], 1).to_pandas()

    rows = pd.concat([unit(np.arange(n, dtype=np.uint64)), unit(np.array([place], np.uint64))], ignore_index=True)
    got = suffix_dedup._rank(rows)
    found = sorted(p for proven in got["proven"].dropna() for p in np.frombuffer(proven, np.uint32).tolist())
    assert found == [0, place]


def test_contexts_are_resolved_a_few_cores_at_a_time(monkeypatch):
    """No call sees the windows of a whole bucket, no core is parted, and the runs are those of all contexts at once."""
    rng = np.random.default_rng(5)
    shared = [rng.integers(97, 123, 332, np.uint8).tobytes() for _ in range(300)]
    rows = pd.DataFrame({
        "core": np.repeat(np.arange(300), 20), "doc_id": pd.array(range(6000), "Int64"), "digest": np.arange(6000), "low": 0, "lead": 132,
        "context": [shared[k][:250] + rng.integers(97, 123, 82, np.uint8).tobytes() for k in range(300) for _ in range(20)],
    })
    seen, windows = [], suffix_dedup._windows
    monkeypatch.setattr(suffix_dedup, "_windows", lambda part: seen.append(set(part["core"])) or windows(part))
    got = suffix_dedup._resolve(rows.sample(frac=1, random_state=1))
    row, start, value = windows(rows)
    hit = suffix_dedup._repeated(value)
    expected = suffix_dedup._runs(rows, row[hit], start[hit])
    key = lambda df: sorted(map(tuple, df.astype("int64").to_numpy().tolist()))
    assert len(expected) == 6000 and key(got) == key(expected)
    assert len(seen) > 1 and sum(map(len, seen)) == 300
