"""Tokenizer alignment against whole-text encoding and plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from replaykit.llm import token_alignment as ta
from replaykit.llm.textbytes import Texts

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def vocabularies():
    return ta.Vocabularies(*ta.default_tokenizers())


def brute(docs, v):
    parts = []
    for doc_id, text in docs:
        row = [doc_id, 0, 0, 0, [], ""]
        parts.append(row)
        if not text:
            continue
        whole = (" " + text).encode()
        ids_a = v.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = v.b.encode(text)
        if b"".join(v.bytes_a[i] for i in ids_a) != whole or b"".join(v.bytes_b[i] for i in ids_b) != whole:
            continue
        spans = lambda ids, of: [(sum(len(of[x]) for x in ids[:k]), sum(len(of[x]) for x in ids[: k + 1])) for k in range(len(ids))]
        sa, sb = spans(ids_a, v.bytes_a), spans(ids_b, v.bytes_b)
        links = [(a, b) for a, (s, e) in zip(ids_a, sa) for b, (t, f) in zip(ids_b, sb) if s < f and t < e]
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, low = [], 0
        for cut in cuts:
            left = ",".join(str(a) for a, (s, e) in zip(ids_a, sa) if low <= s and e <= cut)
            right = ",".join(str(b) for b, (s, e) in zip(ids_b, sb) if low <= s and e <= cut)
            groups.append(f"{left}|{right}")
            low = cut
        row[1:] = [len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()]
    counts = Counter(x for row in parts for x in row[4])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return sorted(
        ((d, a, b, g, len(x), sum(counts[y] == best[y[1]] for y in x), sum(counts[y] for y in x), h) for d, a, b, g, x, h in parts),
        key=str,
    )


WEIRD = ["", " ", "  ", "a ", " a", "a\n", "\n", "\n\nb", " \n x", "x\n  b", "don't stop", "aaaa aaaa", "<s> </s> <|endoftext|> <0x0A>", "▁x", "x▁ y",
         "é é ﬁ y 　z", "日本語 text", "\t tab\r\nline", "\x00z \x1f q", "😀 smile😀", "word, word. word!", "1234 5678", "x" * 300, "  a  b"]


def random_text(rng):
    alphabet = ["a", "b", "the", " ", "  ", "\n", "\n ", "é", "ß", ".", ",", "'s", " ", "日", "\t", "9", "—", "😀", "A"]
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))


def test_units_give_the_tokens_of_whole_texts(vocabularies):
    v, rng = vocabularies, random.Random(4)
    for text in [t for t in WEIRD if t and "▁" not in t] + [t for t in (random_text(rng) for _ in range(1500)) if t]:
        data = text.encode()
        texts = ta.spaced(Texts(0, np.frombuffer(data, np.uint8), np.array([0, len(data)])))
        starts = ta.unit_starts(texts)
        raw = texts.data.tobytes()
        units = [raw[s:e] for s, e in zip(starts, [*starts[1:], len(raw)])]
        got = ta.align(units, v)
        ids_a, ids_b = v.a.encode(" " + text, add_special_tokens=False).ids, v.b.encode(text)
        assert got.valid.all() == (b"".join(v.bytes_b[i] for i in ids_b) == raw), text
        if got.valid.all():
            assert (got.n_a.sum(), got.n_b.sum()) == (len(ids_a), len(ids_b)), repr(text)
            shown = b"".join(got.shown).decode().rstrip(";").split(";")
            assert ",".join(g.split("|")[0] for g in shown) == ",".join(map(str, ids_a)), repr(text)
            assert ",".join(g.split("|")[1] for g in shown) == ",".join(map(str, ids_b)), repr(text)


def test_alignment_equals_brute_force(spark, vocabularies, monkeypatch):
    rng = random.Random(11)
    docs = [(i, t) for i, t in enumerate(WEIRD)] + [(100 + i, random_text(rng)) for i in range(80)]
    docs += [(7, "aaaa aaaa"), (7, "another text of the same id"), (None, "no id"), (500, None), (501, "one two three " * 400)]
    df = spark.createDataFrame([(d, t, 1, "x", -1) for d, t in docs], "doc_id bigint, text string, chunk int, code string, n_a int").repartition(3)
    got = sorted((tuple(r) for r in ta.aligned(df).select(*COLUMNS).collect()), key=str)
    assert got == brute(docs, vocabularies)


def test_alignment_of_no_rows(spark):
    out = ta.aligned(spark.createDataFrame([], "doc_id bigint, text string"))
    assert out.columns == COLUMNS and out.count() == 0
    out = ta.aligned(spark.createDataFrame([(1, ""), (2, None)], "doc_id bigint, text string"))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
