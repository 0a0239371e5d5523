from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from replaykit.llm import packing, poisson_mix

from .corpora import documents, empty, texts


def test_pieces_are_those_of_the_tokenizer_and_fill_sequences(spark):
    from tokenizers import Tokenizer

    items = [*texts(), "<|endoftext|> <|ENDOFTEXT|>, it's,, don't... x<|startoftext|>y. É. A B; …. 3.5% $9,"]
    df = documents(spark, items=items)
    rows = packing.packed(df).collect()
    encoder = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for r in df.collect():
        ids = encoder.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4").tobytes()
            want[(r.doc_id, k // 2048, k, len(part) // 4, zlib.crc32(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_table_packs_nothing(spark):
    assert packing.packed(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once_and_is_tight(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(5, 1.3, 3000).astype(int), 1, 2048)
    counts = Counter(lengths.tolist())
    fillings = packing.plan(dict(counts))
    used = Counter()
    for f in fillings:
        assert sum(f.lengths) <= 2048
        for length in f.lengths:
            used[length] += f.times
    assert used == counts
    assert sum(f.times for f in fillings) <= -(-int(lengths.sum()) // 2048) + 2


def test_two_pieces_replace_the_smallest_when_they_fit_better():
    # greedy: 1500 + 500 leaves 48; 500 goes for 300 + 248
    first = packing.plan({1500: 1, 500: 1, 300: 1, 248: 1})[0]
    assert first == packing.Filling(1, (1500, 300, 248))


def test_one_piece_is_not_used_twice():
    fillings = packing.plan({1000: 1, 900: 1, 550: 1})
    assert Counter(x for f in fillings for x in f.lengths for _ in range(f.times)) == {1000: 1, 900: 1, 550: 1}


def test_copies_follow_the_rates(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").alias("source"), F.lit("x").alias("copy")
    )
    rated = {r["_source"]: r["rate"] for r in poisson_mix.rates(docs).collect()}
    assert rated["sbig"] < rated["smid"] < rated["n"]
    out = poisson_mix.replicated(docs)
    assert out.columns == ["doc_id", "source", "copy", "shuffle_key"]
    got = {r[0]: r[1] for r in out.groupBy("source").count().collect()}
    sizes = {"big": 14_000, "mid": 4_000, None: 2_000}
    for source, n in sizes.items():
        want = n * rated["n" if source is None else f"s{source}"]
        assert abs(got[source] - want) < 5 * want**0.5
    keys = [r[0] for r in out.select("shuffle_key").collect()]
    assert keys == sorted(keys)


def test_large_rates_are_sums_of_draws(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    out = poisson_mix.replicated(docs, spark.createDataFrame([("sa", 2000.0)], "_source string, rate double"))
    assert abs(out.count() - 100_000) < 2000


def test_mixing_keeps_columns_nulls_and_empty_tables(spark):
    df = documents(spark, extra=True)
    out = poisson_mix.replicated(df)
    assert set(out.columns) == {*df.columns, "shuffle_key"} and out.count() > 0
    assert poisson_mix.replicated(empty(spark)).count() == 0
