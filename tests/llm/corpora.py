"""Small documents with every edge case, shared by the tests."""

from __future__ import annotations

import random

DOCS_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = "an ber cho del eri fos gun hal ist jor kel lum mon nar ost pel qui ras".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(words):
        out.append("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) if rng.random() < 0.7 else rng.choice("the of and to in".split()))
        if i % 40 == 39:
            out[-1] += ".\n"
    return " ".join(out)


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join("xxyy" if rng.random() < share else w for w in text.split(" "))


def texts() -> list[str | None]:
    base = prose(1, 300)
    passage = prose(99, 60)
    out = [None, "", " \n\t ", "one", "a b c d", "a b c d", "a b c d e", "A B c d E", "ünïcödé ßtraße 漢字 😀 " * 12]
    out += [base, base, base + " tail", edited(base, 1, 0.01), edited(base, 2, 0.03), edited(base, 3, 0.2)]
    out += [prose(n, 120) + "\n" + passage + "\n" + prose(n + 50, 120) for n in range(10, 18)]
    out += ["spam " * 400, "x" * 5000, prose(7, 6000), "é" * 301, "é" * 301 + "!"]
    return out


def documents(spark, extra: bool = False, items=None):
    rows = [(i * 3 - 6, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t or "")) for i, t in enumerate(items if items is not None else texts())]
    rows.append((None, "a text without an id", None, None, None))
    rows.append(rows[9])  # a repeated row
    if not extra:
        return spark.createDataFrame(rows, DOCS_SCHEMA)
    clash = ", row string, kept string, copy string, _words string, rank string, digest string, bucket string, n string, component_id string"
    return spark.createDataFrame([(*r, *["z"] * 9) for r in rows], DOCS_SCHEMA + clash)


def empty(spark):
    return spark.createDataFrame([], DOCS_SCHEMA)
