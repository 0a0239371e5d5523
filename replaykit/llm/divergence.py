"""Quality rules: distance of a document's histograms from references of its language.

Two histograms describe a text: character classes, and the common words of a language beside all other words.  The common words
of a language are its most frequent ones over all its documents; a reference is the sum of the histograms of all
documents of a language that pass the base rules.  Both are counted over the whole table.  A document is judged by its Jensen-Shannon distance (square root
of the divergence in bits, 0 to 1) from the reference of its own language, or from the nearest one where its language is unknown.  A language of fewer than
LEAST_DOCUMENTS documents has no reference, and its documents are judged by the base rules alone.  Short texts have noisy histograms, so each
distance has a least length below which it decides nothing.  DataFrame functions only.

Null text has no words and fails the base rules.  Rows are judged one by one, so ties and repeated rows need no
rule; common words that are equally frequent go by their order.  The columns of the input travel in the struct ``row``, so their names cannot clash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replaykit.session import written_table

WORD_GAP = r"[\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CLASSES = (r"\p{Ll}", r"\p{Lu}", r"\p{Nd}", r"[\x20\x09-\x0D]", r"[.,;:'\-]", r"[!?]", rf"[{SYMBOLS}]")
BLANKS, MARKS = 3, 6
PUNCTUATION = r"[.,;:!?#*$%&|<>]+"
COMMON = 20  # words of a language that its histogram tells apart
LONGEST = 12
LEAST_DOCUMENTS = 10  # a language with fewer has no reference
LANGUAGES = 200  # with references at most, the most frequent ones


class Limits(NamedTuple):
    """Farthest distances from the nearest reference, and the least lengths at which they count."""

    characters: float = 0.20
    character_guard: int = 300
    words: float = 0.28
    word_guard: int = 120


def measured(docs: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """Each row as ``row``, of its ``carried`` columns or of all, with its text, lang, base figures and character classes."""
    lang = docs["lang"] if "lang" in docs.columns else F.lit(None).cast("string")
    docs = docs.select(F.struct(*[docs[c] for c in carried or docs.columns]).alias("row"), docs["text"].alias("text"), lang.alias("lang"))
    text = F.coalesce("text", F.lit(""))
    trimmed = F.trim(text, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP, -1))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(WHITE)) != "")
    # each class is counted as what its removal takes away, and the next ones are looked for in what is left
    lefts = [text]
    for c in CLASSES:
        lefts.append(F.regexp_replace(f"_left{len(lefts) - 1}", c + "+", ""))
    for n, left in enumerate(lefts):
        docs = docs.withColumn(f"_left{n}", left)
    counted = [(F.length(f"_left{n}") - F.length(f"_left{n + 1}")).cast("double") for n in range(len(CLASSES))]
    step = (
        docs.withColumn("_words", words)
        .withColumn("_lines", lines)
        .withColumn("n_words", F.size("_words").cast("bigint"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"))
        .withColumn("_classes", F.array(*counted))
        .drop(*[f"_left{n}" for n in range(len(CLASSES) + 1)])
        .withColumn("word_chars", (F.length(text) - F.get("_classes", F.lit(BLANKS))).cast("bigint"))
        .withColumn("n_symbols", F.get("_classes", F.lit(MARKS)).cast("bigint"))
    )
    return _repeats(step).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    ).drop("_lines")


def _repeats(df: DataFrame) -> DataFrame:
    """Words inside three-word windows that occur twice or more in the text.

    A window's number is a 64-bit hash of its words' hashes.  Where all numbers of a text differ, nothing repeats.  Otherwise numbers that
    are not alone are found in sorted order, and their places are sorted by the words themselves, which decide.
    """
    count = F.greatest(F.col("n_words").cast("int") - 2, F.lit(0))
    windows = F.zip_with(
        F.zip_with(F.slice("_hashes", F.lit(1), count), F.slice("_hashes", F.lit(2), count), lambda a, b: F.xxhash64(a, b)),
        F.slice("_hashes", F.lit(3), count),
        lambda a, b: F.xxhash64(a, b),
    )
    none = F.array().cast("array<bigint>")

    def window(at: Column) -> Column:
        words = [F.get("_words", at.cast("int") + k).alias(f"w{k}") for k in range(3)]
        return F.struct(F.struct(*words).alias("words"), at.alias("at"))

    twin = lambda array, x, j, of: F.coalesce((of(F.get(array, j - 1)) == of(x)) | (of(F.get(array, j + 1)) == of(x)), F.lit(False))
    alike = lambda array, of: F.filter(array, lambda x, j: twin(array, x, j, of))
    some = F.size("_windows") > F.size(F.array_distinct("_windows"))
    numbered = F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("hash"), i.cast("bigint").alias("at"))))
    found = F.sort_array(F.transform(alike("_sorted", lambda x: x["hash"]), lambda x: window(x["at"])))
    at = F.sort_array(F.transform(alike("_found", lambda x: x["words"]), lambda x: x["at"]))
    covered = F.aggregate(
        F.transform("_at", lambda p, j: F.least(F.lit(3).cast("bigint"), F.coalesce(F.get("_at", j + 1), p + 3) - p)),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    return (
        df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn("_windows", F.when(count > 0, windows).otherwise(none))
        .withColumn("_sorted", F.when(some, numbered))
        .withColumn("_found", F.when(F.col("_sorted").isNotNull(), found))
        .withColumn("_at", F.when(F.col("_found").isNotNull(), at))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))
        .drop("_hashes", "_windows", "_sorted", "_found", "_at")
    )


def plain_word(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), PUNCTUATION, "")


def common_words(docs: DataFrame) -> dict[str, list[str]]:
    """The most frequent words of each language over all its documents, most frequent language first.

    Words are counted as they stand, so that each different one is made plain once.  At most COMMON words of LANGUAGES languages come to
    the driver.
    """
    named = docs.where("lang IS NOT NULL")
    sizes = named.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_DOCUMENTS)
    rows = sizes.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not rows:
        return {}
    standing = named.where(F.col("lang").isin([r["lang"] for r in rows])).select("lang", F.explode(F.split("text", WORD_GAP)).alias("word"))
    # what is too long and has nothing to lose stays too long
    short = standing.where((F.length("word") <= LONGEST) | F.col("word").rlike(PUNCTUATION))
    words = short.groupBy("lang", "word").agg(F.count("*").alias("n")).select("lang", plain_word(F.col("word")).alias("word"), "n")
    # the length is an aggregate, as a filter on the word itself would be applied to every word before the first count
    counts = words.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.max(F.length("word")).alias("length")).where(F.col("length").between(1, LONGEST))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("rank") <= COMMON)
    out: dict[str, list[str]] = {r["lang"]: [] for r in rows}
    for r in sorted(ranked.collect(), key=lambda r: (r["lang"], r["rank"])):
        out[r["lang"]].append(r["word"])
    return {lang: words for lang, words in out.items() if words}


def _mine(known: Column) -> Column:
    """Of the languages in ``known`` that of the row; all of them where it has none, and no one where it is not among them."""
    return F.when(F.col("lang").isNull(), known).otherwise(F.filter(known, lambda r: r["lang"] == F.col("lang")))


def histograms(df: DataFrame, common: dict[str, list[str]]) -> DataFrame:
    """Add, for each language that the row is judged by, how often each of its common words stands in the text, and last the number of all other words."""
    vocabulary = F.array(*[F.struct(F.lit(lang).alias("lang"), F.array(*map(F.lit, words)).alias("words")) for lang, words in common.items()])
    plain = F.split(F.regexp_replace(F.lower(F.array_join("_words", " ")), PUNCTUATION, ""), " ", -1)
    places = lambda words: F.filter(F.transform("_plain", lambda x: F.array_position(words, x)), lambda at: at > 0)
    times = lambda found, words: F.transform(words, lambda w, i: (F.size(found) - F.size(F.array_remove(found, i.cast("bigint") + 1))).cast("double"))
    # the inner array of one element names the places, which are looked up once for all words
    hits = lambda words: F.get(F.transform(F.array(places(words)), lambda found: times(found, words)), F.lit(0))
    with_rest = lambda h: F.concat(h, F.array(F.col("n_words") - _total(h)))
    counted = F.transform(F.transform(_mine(vocabulary), lambda r: hits(r["words"])), with_rest)
    none = F.array().cast("array<array<double>>")
    return df.withColumn("_plain", plain).withColumn("_hits", counted if common else none).drop("_plain", "_words")


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)


def _scaled(counts: Column) -> Column:
    return F.transform(counts, lambda x: x / F.greatest(_total(counts), F.lit(1.0)))


def references(figures: DataFrame, common: dict[str, list[str]]) -> dict[str, tuple[list[float], list[float]]]:
    """Per language the shares of character classes and of common words over all its documents that pass the base rules."""
    if not common:
        return {}
    known = figures.where(~F.col("base_failed") & F.col("lang").isin(*common))
    first = F.get("_hits", F.lit(0))
    sums = lambda c, n: F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(n)])
    rows = known.groupBy("lang").agg(sums("_classes", len(CLASSES)).alias("classes"), sums(first, COMMON + 1).alias("hits")).collect()
    return {r["lang"]: (_shares(r["classes"]), _shares([x for x in r["hits"] if x is not None])) for r in rows}


def _shares(counts: list[float]) -> list[float]:
    whole = sum(counts)
    return [c / whole if whole else 0.0 for c in counts]


def _entropy(shares: Column) -> Column:
    return F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0)))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    middle = F.zip_with(p, q, lambda x, y: (x + y) / 2)
    return F.sqrt(F.greatest(_entropy(middle) - (_entropy(p) + _entropy(q)) / 2, F.lit(0.0)))


def judged(docs: DataFrame, limits: Limits = Limits(), carried: list[str] | None = None) -> DataFrame:
    """``row`` with base figures, both distances (null where no reference is at hand) and ``kept``.

    ``carried`` names the columns that ``row`` needs, so that a caller without use for the texts does not have them written.  The figures are written once: the references are sums over all of them.
    """
    step = measured(docs, carried)
    common = common_words(step.select("lang", "text"))
    figures = written_table(histograms(step, common).drop("text"), "quality-figures")
    fitted = references(figures, common)
    # a language none of whose documents passes keeps its place, so that histograms and references stay aligned
    shares = lambda lang, k: F.array(*map(F.lit, fitted[lang][k])) if lang in fitted else F.lit(None).cast("array<double>")
    known = F.array(*[F.struct(F.lit(x).alias("lang"), shares(x, 0).alias("classes"), shares(x, 1).alias("hits")) for x in common])
    nearest = lambda c: F.array_min(c) if fitted else F.lit(None).cast("double")
    scaled = figures.withColumn("_known", _mine(known) if fitted else F.lit(None)).withColumn("_scaled", _scaled(F.col("_classes")))
    characters = nearest(F.transform("_known", lambda r: distance(F.col("_scaled"), r["classes"])))
    words = nearest(F.zip_with("_hits", "_known", lambda h, r: distance(_scaled(h), r["hits"])))
    far = lambda c, limit, length, guard: F.coalesce((F.col(c) > limit) & (F.col(length) >= guard), F.lit(False))
    odd = far("char_distance", limits.characters, "word_chars", limits.character_guard) | far("word_distance", limits.words, "n_words", limits.word_guard)
    return (
        scaled.withColumn("char_distance", characters)
        .withColumn("word_distance", words)
        .withColumn("kept", ~F.col("base_failed") & ~odd)
        .select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept")
    )
