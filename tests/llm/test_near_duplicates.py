from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from replaykit.llm import parity_join
from replaykit.llm.components import components

from .corpora import documents, edited, empty, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def expected(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets[:x]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(x)] = find(y)
    low = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            low[find(x)] = min(low.get(find(x), i), i)
    return Counter((i, len(s), low.get(find(x)) if s else i) for x, (i, s) in enumerate(sets))


def answer(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in parity_join.near_duplicates(df).collect())


def test_equals_brute_force_on_edge_cases(spark):
    df = documents(spark, extra=True)
    assert answer(df) == expected([(r.doc_id, r.text) for r in df.collect()])


def test_large_groups_and_a_shared_passage(spark, monkeypatch):
    monkeypatch.setattr(parity_join, "ALL_PAIRS", 3)
    monkeypatch.setattr(parity_join, "COMPARE_BLOCK", 4)
    base, passage = prose(5, 200), prose(6, 120)
    items = [edited(base, n, 0.02 * (n % 4)) for n in range(25)] + [passage + " " + prose(200 + n, 60) for n in range(20)]
    items += [edited(items[-1], n, 0.04) for n in range(5)]
    df = documents(spark, items=items)
    assert answer(df) == expected([(r.doc_id, r.text) for r in df.collect()])


def test_empty_table(spark):
    assert parity_join.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("n", (1, 2, 5, 31, 32, 60, 127, 300, 2000))
def test_pairs_at_the_limit_share_a_key(n):
    """Sets that just reach 3/4 share one of their keys, in whatever way their difference is spread."""
    rng = np.random.default_rng(n)
    for _ in range(30):
        larger = n + int(rng.integers(0, n // 3 + 1))
        shared = -(-3 * (n + larger) // 7)
        if shared > n:
            continue
        a = np.unique(rng.integers(0, 2**64 - 1, n + larger - shared, dtype=np.uint64))
        left, right = np.sort(a[:n]), np.sort(np.concatenate((a[n - shared : n], a[n:])))
        if 4 * shared < 3 * (len(left) + len(right) - shared):
            continue
        keys = [set().union(*[parity_join.block_keys(s, b, k, 0).tolist() for b, k in parity_join.bands(len(s))]) for s in (left, right)]
        assert keys[0] & keys[1]
        bits = [parity_join.parity_bits(x) for x in (left, right)]
        x, y = (parity_join.folded(b, min(map(len, bits))) for b in bits)
        apart = np.bitwise_count(x ^ y).sum()
        assert apart <= len(left) + len(right) - 2 * shared


def test_components_of_a_chain_a_star_and_a_pair(spark):
    links = [(n, n + 1) for n in range(10, 30)] + [(100, n) for n in range(101, 140)] + [(7, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{n: 10 for n in range(10, 31)}, **{n: 100 for n in range(100, 140)}, 5: 5, 7: 5}
