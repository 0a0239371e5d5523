from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from replaykit.llm import divergence, html_text, language_id, license_scan, merkle

from replaykit.llm.textbytes import chunks

from .corpora import documents, empty, prose, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_quality_figures_equal_brute_force(spark):
    items = [*texts(), "a b c a b c a b c", "x\nx\n \ny # $$ &|\nx", "w " * 60, "a\r\nb\r\na\r\n"]
    df = documents(spark, extra=True, items=items)
    got = divergence.judged(df).selectExpr("row.doc_id", "row.text", "* EXCEPT (row)").collect()
    assert len(got) == df.count()
    for r in got:
        text = r.text or ""
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed,
        )
        assert not (r.kept and failed) and all(d is None or 0 <= d <= 1 for d in (r.char_distance, r.word_distance))


def test_repeated_words_are_exact_above_a_million_words(spark):
    words = [f"w{n}" for n in range(1_200_000)]
    df = spark.createDataFrame([(1, " ".join(words + words[:4])), (2, " ".join(words))], "doc_id bigint, text string")
    got = divergence.measured(df).selectExpr("row.doc_id", "n_words", "n_repeat_words").collect()
    assert {tuple(r) for r in got} == {(1, 1_200_004, 8), (2, 1_200_000, 0)}


def test_odd_symbols_are_rejected_and_prose_is_kept(spark):
    good = [prose(n, 200) for n in range(30)]
    bad = [" ".join(w + "%%$" for w in prose(n, 200).split()) for n in range(100, 103)]
    df = documents(spark, items=good + bad)
    kept = {r.text: r.kept for r in divergence.judged(df).selectExpr("row.text", "kept").collect()}
    assert all(kept[t] for t in good) and not any(kept[t] for t in bad)


CYRILLIC = str.maketrans("abcdefghijklmnoprstuvwy", "абцдефгхийклмнопрстувшы")


def test_languages_without_a_reference_are_left_alone(spark):
    """A few documents of a rare language, far from every reference, are judged by the base rules alone."""
    rows = [(n, prose(n, 300), "en") for n in range(40)] + [(100 + n, prose(n + 500, 300).translate(CYRILLIC), "ru") for n in range(3)]
    rows += [(200, " ".join(w + "%%$" for w in prose(900, 200).split()), "en"), (201, "а б в", "ru"), (202, prose(7, 300).translate(CYRILLIC), None)]
    got = {r.doc_id: r for r in divergence.judged(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).selectExpr("row.doc_id", "kept", "char_distance").collect()}
    assert all(got[n].kept for n in (*range(40), 100, 101, 102)) and got[100].char_distance is None
    assert not got[200].kept and not got[201].kept and got[202].char_distance is not None


def test_references_are_learned_per_language(spark):
    rows = [(n, " ".join(["alpha", "beta", f"w{n}"] * 20), "x") for n in range(35)] + [(n, "gamma delta", "y") for n in range(9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    common = divergence.common_words(docs)
    assert list(common) == ["x"] and common["x"][:2] == ["alpha", "beta"] and len(common["x"]) == divergence.COMMON


def test_common_words_are_counted_over_all_documents(spark):
    """Forty words of nearly equal frequency in more documents than any sample of them would hold."""
    words = [F.when(F.pmod(F.xxhash64("id", F.lit(j)), F.lit(1000)) < 500, f"word{j}") for j in range(40)]
    docs = spark.range(8000).select(F.concat_ws(" ", F.concat(F.lit("u"), "id"), *words, F.lit("averyveryverylongword")).alias("text"), F.lit("x").alias("lang"))
    counts = docs.select(F.explode(F.split("text", " ")).alias("word")).where("word LIKE 'word%'").groupBy("word").count().collect()
    expected = sorted(counts, key=lambda r: (-r["count"], r["word"]))[: divergence.COMMON]
    assert divergence.common_words(docs)["x"] == [r["word"] for r in expected]


def test_quality_of_an_empty_table_and_without_languages(spark):
    assert divergence.judged(empty(spark)).count() == 0
    df = documents(spark).drop("lang", "source", "n_chars")
    assert divergence.judged(df).where("kept").count() > 0


def test_fingerprints_follow_the_definition(spark):
    df = documents(spark, extra=True)
    rows = df.where("doc_id IS NOT NULL").collect()
    ids = sorted({r.doc_id for r in rows}, reverse=True)
    least = {i: min(r.text or "" for r in rows if r.doc_id == i) for i in ids}
    after = {i: least[ids[(k + 1) % len(ids)]] for k, i in enumerate(ids)}
    got = merkle.with_neighbour_edits(df).collect()
    assert len(got) == df.count()
    of = {r.doc_id: r.text or "" for r in rows}
    for r in got:
        if r.doc_id is None:
            continue
        text = of[r.doc_id]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[r.doc_id][:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (r.fingerprint == r.edited_fingerprint) == (text == changed)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(text) > 500 and " " in text and text != changed:
            assert 0.2 < r.near_edited < 1
    assert merkle.with_neighbour_edits(empty(spark)).count() == 0


def test_equal_texts_have_equal_fingerprints_and_edits_are_located(spark):
    lines = [f"line {n} " + prose(n, 30).replace("\n", " ") for n in range(40)]
    other = list(lines)
    other[19] = "changed"
    df = spark.createDataFrame([("\n".join(lines), "\n".join(other)), ("", ""), ("a", "a")], "a string, b string")
    df = merkle.fingerprints(merkle.fingerprints(df, "a", "fa"), "b", "fb")
    got = df.select("fa", "fb", merkle.likeness("fa", "fb"), merkle.edited_sections("fa", "fb")).collect()
    assert got[0][3] == [2] and 0.9 < got[0][2] < 1
    assert got[1][0] == got[1][1] and got[1][2] == 1 and got[2][2] == 1 and got[2][3] == []


def test_neighbours_of_far_and_negative_ids(spark):
    ids = [-(2**62), -5, -4, 0, 3, 1023, 1024, 2**20, 2**40, 2**62]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id bigint, text string")
    got = {r.doc_id: r.next_text for r in merkle.with_next_text(df).collect()}
    assert got == {i: f"t{ids[k - 1]}" for k, i in enumerate(ids)}


@pytest.fixture(scope="module")
def languages():
    words = {"aa": "lorem dolor magna sit amet erat nunc", "bb": "schtz keit über ungen lich heit ach"}
    return {lang: [" ".join((w.split()[(n * k) % 7]) + "aeiou"[(n + k) % 5] for k in range(1, 60)) for n in range(1, 60)] for lang, w in words.items()}


def test_languages_are_told_apart_on_held_out_rows(spark, languages):
    rows = [(n + 1000 * k, t, lang) for k, (lang, ts) in enumerate(languages.items()) for n, t in enumerate(ts)]
    rows += [(9001, None, "aa"), (9002, "", None), (9003, "123 !?", "bb"), (None, "lorem dolora", "aa"), (9004, "x" * 3000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.train(df)
    got = language_id.predicted(df, model).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 9000]
    assert len(held) > 10 and all(r.lang_pred == truth[r.doc_id] for r in held)
    assert not any(r.rejected for r in held) and np.isfinite(model.limits).all()
    by = {r.doc_id: r for r in got}
    for i in (9001, 9002, 9003):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[9004].lang_pred in ("aa", "bb") and by[9004].rejected
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(rows)


def test_character_models_are_distributions(languages):
    counted = {x: np.unique(np.concatenate([language_id.grams(language_id.symbols(t)) for t in ts]), return_counts=True) for x, ts in languages.items()}
    model = language_id.fit(counted)
    letters = np.unique(np.concatenate([k & np.uint64(0xFFFF) for k, _ in counted.values()]))
    for context in ("lor", "zzz", "   "):
        head = language_id.grams(language_id.symbols(context))[-1] << np.uint64(16)
        p = np.exp2(language_id.log_probabilities(model, head | letters)).sum(axis=0)
        assert np.all(p > 0.9) and np.all(p < 1.001)  # the rest is for unseen letters


def test_ties_between_languages_go_to_the_first():
    counted = np.unique(language_id.grams(language_id.symbols("lorem ipsum dolor sit amet " * 9)), return_counts=True)
    model = language_id.fit({"q": counted, "p": counted})
    h, _ = language_id.entropies(model, ["lorem", "zzz", ""])
    assert model.languages == ["p", "q"] and (h[:, 0] == h[:, 1]).all() and (np.argmin(h, axis=1) == 0).all()


def test_few_or_equal_texts_still_teach_a_language_and_reject_nothing(spark):
    rows = [(i, "lorem ipsum dolor sit amet", "aa") for i in range(40)] + [(100, "schtz keit über", "bb"), (101, None, "bb"), (102, None, "cc")]
    model = language_id.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert {"aa"} <= set(model.languages) <= {"aa", "bb", "cc"}
    assert not np.isfinite([x for lang, x in zip(model.languages, model.limits, strict=True) if lang != "aa"]).any()


def test_language_of_an_empty_table(spark):
    assert language_id.train(empty(spark)) is None
    assert language_id.predicted(documents(spark), None).where("lang_pred <> 'und'").count() == 0


def test_licenses_are_found_whole_split_and_not_elsewhere(spark):
    mit = license_scan.TEMPLATES[9][1]
    items = [
        None, "", "Released under", prose(1, 500) + "\nReleased under the MIT License.\n" + prose(2, 90), "released UNDER the mit\nlicense",
        "Licensed under CC BY-NC 4.0. Released under the MIT License.", mit, " ".join(mit.split()[:-2]), " ".join(mit.split()[:9]), prose(3, 4000),
    ]
    df = documents(spark, extra=True, items=items)
    got = {r.doc_id: r for r in license_scan.summary(license_scan.scanned(df)).collect()}
    want = ["", "", "", "MIT", "MIT", "CC-BY-NC-4.0,MIT", "MIT", "MIT", "", ""]
    assert [got[i * 3 - 6].licenses for i in range(len(want))] == want
    assert got[12].containment == 1 and 0.75 <= got[15].containment < 1
    assert license_scan.summary(license_scan.scanned(empty(spark))).count() == 0
    assert license_scan.collision_probability(0.25, license_scan.BANDS) > 0.9999


def test_whole_licenses_near_variants_and_tags_are_told_apart(spark):
    whole = dict(license_scan.TEMPLATES[21:38])
    items, want = [], []
    for name, text in whole.items():
        items += [prose(7, 3000) + "\n" + text + "\n" + prose(8, 900)]
        want += [name]
    items += ["\n".join(x for x in whole["MIT"].split("\n") if "hereby" not in x and "obtaining" not in x)]
    items += ["This work is licensed under the GNU Lesser General Public License, version 3.", "This work is licensed under the GNU General Public License, version 2."]
    items += ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."]
    items += ["// SPDX-License-Identifier: GPL-2.0-or-later", "# SPDX-License-Identifier: EPL-2.0", "SPDX-License-Identifier: MIT", "SPDX-License-Identifier: unknown"]
    want += ["MIT", "LGPL-3.0", "GPL-2.0", "CC-BY-SA-4.0", "CC-BY-SA-4.0", "GPL-2.0", "EPL-2.0", "MIT", ""]
    df = documents(spark, items=items)
    got = {r.text: r.licenses for r in license_scan.summary(license_scan.scanned(df)).join(df, "doc_id").collect()}
    assert [got[x] for x in items] == want


PAGE = '<html><head><title>T</title><script>if (a < b) x("</p>")</script></head><body><nav><ul><li>menu</ul></nav>{}<footer>foot</footer></body></html>'


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><h1>A &amp; B</h1><p>one\n two<br>three<p>f&uuml;r &lt;b&gt;</article>", "A & B\n\none two three\n\nfür <b>"),
        ('<div class="ad">x</div><article><p>t</p><aside>y</aside><div id="comments"><p>z</p></div></article>', "t"),
        ("<article><p>cut off <b>here</b> &am", "cut off here &am"),
        ("<main><form><p>f</p></form><p>m</p></main><p>outside</p>", "m"),
        ("<article><!-- <p>no</p> --><p>a &#8364; &#x41;</p></article>", "a € A"),
        ("<p>no mark</p><header>h</header><div class='sidebar left'>s</div>", "no mark"),
    ],
)
def test_blocks_of_a_page(html, text):
    page = html_text.Page(1, "u", "h", [], html_text.blocks(PAGE.format(html)))
    assert html_text.main_text(page, None, None) == text


def test_a_line_shared_with_the_nearest_page_goes(spark):
    rows = [
        (1, "http://h.example/a/1", "<p>Welcome to the site</p><p>first text</p><p>more of it</p><p>Terms</p>"),
        (2, "http://h.example/a/2", "<p>Welcome to the site</p><p>second text</p><p>and more</p><p>Terms</p>"),
        (3, "http://other.example/a/1", "<p>Welcome to the site</p><p>third</p>"),
        (4, None, None), (5, "", ""), (6, "http://h.example/z", "<article><p>Welcome to the site</p></article>"), (6, "http://h.example/z", "<article><p>Welcome to the site</p></article>"),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS text", "'y' AS host")
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in html_text.extracted(df.coalesce(1)).collect())
    want = {1: "first text\n\nmore of it", 2: "second text\n\nand more", 3: "Welcome to the site\n\nthird", 4: "", 5: "", 6: "Welcome to the site"}
    assert got == Counter((i, u, want[i], len(want[i])) for i, u, _ in rows)
    assert html_text.extracted(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_common_lines_are_a_longest_common_subsequence():
    import random

    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        places = html_text.common_lines(a, b)
        rest = iter(b)
        assert len(places) == table[-1][-1] and all(x in rest for x in (a[i] for i in sorted(places)))


def test_lines_that_pages_of_a_host_repeat_inside_marked_articles_go(spark):
    article = "<nav>menu</nav><article><p>Welcome to the site</p><p>{}</p><p>{} again</p><p>Terms</p></article>"
    rows = [(n, f"http://h.example/a/{n}", article.format(f"text {n // 3}", f"text {n // 3}")) for n in range(9)]  # three copies of each
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_text.extracted(df.coalesce(1)).collect()}
    plain = {n: f"text {n // 3}\n\ntext {n // 3} again" for n in range(9)}
    # the first and the last article have a page of another content on one side only, and one witness is not enough
    assert got == {n: t if n in (3, 4, 5) else f"Welcome to the site\n\n{t}\n\nTerms" for n, t in plain.items()}


def test_an_edited_article_beside_its_original_loses_nothing(spark):
    body = "".join(f"<p>paragraph {k}</p>" for k in range(10))
    page = "<main><h1>The title</h1>{}</main>".format
    other = "<main><h1>The title</h1><p>Terms</p>" + "".join(f"<p>{{0}} {k}</p>" for k in range(4)) + "</main>"
    bodies = [page(body), page(body + "<p>Update: more</p>"), other.format("one"), other.format("two"), other.format("three")]
    rows = [(n, f"http://h.example/a/{n}", b) for n, b in enumerate(bodies)]
    got = {r.page_id: r.text.split("\n\n") for r in html_text.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert len(got[0]) == 11 and len(got[1]) == 12  # editions of each other
    assert got[3] == ["The title", "two 0", "two 1", "two 2", "two 3"]  # headings stay, the line of both neighbours goes
    assert "Terms" in got[2] and "Terms" in got[4]


def test_short_articles_copies_and_edges_of_ranges_equal_brute_force(spark):
    import random

    rng = random.Random(5)
    site = [f"<p>menu {k}</p>" for k in range(4)], [f"<p>notice {k}</p>" for k in range(4)]
    rows = []
    for n in range(160):
        k = rng.choice([n, n, 7, 8])  # 7 and 8 stand on many pages
        own = "".join(f"<p>own {k} {j}</p>" for j in range(4))
        body = "".join(site[0]) + own + "".join(site[1])
        host = rng.choice(["h", "h", "h", "g", f"x{n}"])
        rows.append((n, f"http://{host}.example/{rng.choice('ab')}/{rng.randint(100, 140)}", f"<article>{body}</article>" if rng.random() < 0.5 else body))
    pages = []
    for n, url, body in rows:
        host, path = re.match(r"http://([^/]*)(.*)", url).groups()
        pages.append((host, path, url, n, html_text.Page(n, url, host, path.strip("/").split("/"), html_text.blocks(body))))
    pages.sort(key=lambda p: p[:4])
    lines = [[b.text for b in p[4].blocks] for p in pages]
    marked = [p[4].blocks[0].main for p in pages]
    want = {}
    for i, p in enumerate(pages):
        fits = [j for j, q in enumerate(pages) if q[0] == p[0] and lines[j] != lines[i] and (marked[j] or not marked[i])]
        before = max((j for j in fits if j < i), default=None)
        after = min((j for j in fits if j > i), default=None)
        want[p[3]] = html_text.main_text(p[4], pages[before][4] if before is not None else None, pages[after][4] if after is not None else None)
    assert sum(t.count("own") == 4 and "menu" not in t for t in want.values()) > 100
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for ranges in ("1", "5", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            out = html_text.extracted(df).collect()
            assert len(out) == len(rows) and {r.page_id: r.text for r in out} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


@pytest.mark.parametrize(
    ("text", "licenses"),
    [
        ("This work is licensed under the Mozilla Public License, version 1.1.", "MPL-1.1"),
        ("This work is licensed under the GNU General Public License, version 1.", "GPL-1.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 2.", ""),
        ("it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 2 of the License", ""),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 2.0 Unported License.", ""),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        ("it under some terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "GPL-3.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ],
)
def test_names_and_versions_of_licenses_are_held_exactly(text, licenses):
    known = license_scan.Templates(license_scan.TEMPLATES)
    padded = f"{prose(3, 40)} . {text} {prose(4, 40)}"
    column = pa.array([padded])
    found = {name for texts_ in chunks(column) for _, name, _, _ in known.best(*license_scan.shingles(texts_))}
    assert found == ({licenses} if licenses else set())
