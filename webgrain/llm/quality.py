"""Quality rules by distribution divergence.

A document is described by two histograms: its characters by class, and its words by the common
words of its language. Both are compared with the reference of the language, which is the sum of
the histograms of all its documents, by the Jensen-Shannon distance. Short documents are guarded:
a histogram of too few characters or words says nothing and passes. Built-in functions only.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrain.functions.binding import let
from webgrain.llm.common import packed, stored, unpacked, words

# Frequent words of each language, most frequent first.
COMMON_WORDS = {
    "en": "the of and to a in is that it for on was with be this as by at are from".split(),
    "de": "der die und in den von zu das des mit sich auf für ist im nicht dem ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour dans qui au sur pas par avec".split(),
    "es": "de la que el en y los se del un las por para una con no su es al lo".split(),
}
CLASSES = ["upper", "digit", "blank", "punctuation", "symbol", "other"]
OUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
       "class_distance", "word_distance", "kept"]
FEW = 4096  # languages whose references are broadcast: 27 counts each
SLOTS = max(map(len, COMMON_WORDS.values()))
# one character per place in a list of common words, the first for all other words
CODES = "".join(chr(ord("A") + i) for i in range(SLOTS + 1))


# characters of the classes, as inside a pattern
SYMBOLS, UPPER, DIGITS, PUNCTUATION = "#*$%&|<>", "A-Z", "0-9", ".,;:!?\"'()\\-"


def _count(text: Column, chars: str) -> Column:
    """Characters of a class: what is left when the runs of all others are taken out."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def _repeated_words(grams: Column) -> Column:
    """Words covered by a 3-word window found twice or more. ``grams`` has one hash per window."""

    def covered(ranked):
        twice = F.filter(ranked, lambda x, i: (
            (F.get(ranked, i - 1)["h"] == x["h"]) | (F.get(ranked, i + 1)["h"] == x["h"])))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return let(starts, lambda s: F.aggregate(
            F.transform(s, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(s, i + 1) - p, F.lit(3)))),
            F.lit(0), lambda a, b: a + b).cast("long"))

    ranked = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(
        let(ranked, covered))


def text_statistics(docs: DataFrame, text: str = "text", lang: str = "lang", columns=None) -> DataFrame:
    """The given columns of ``docs`` (all) packed in ``_row``, ``_lang``, and ``_stat`` (struct) with the
    base counts and the two histograms. A null text counts as empty; an unknown or null language has
    no common words."""
    listed = F.array().cast("array<string>")
    for code, entries in COMMON_WORDS.items():
        listed = F.when(F.col("_lang") == code, F.array(*[F.lit(w) for w in entries])).otherwise(listed)
    base = docs.select(
        packed(docs.columns if columns is None else columns), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("_lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"),
    ).withColumn("_w", words(F.col("_t")))
    w, t = F.col("_w"), F.col("_t")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    grams = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    codes = let(listed, lambda entries: F.array_join(F.transform(
        w, lambda x: F.substring(
            F.lit(CODES), F.array_position(entries, F.lower(x)).cast("int") + 1, F.lit(1))), ""))
    base = base.select(
        "_row", "_lang",
        F.size(w).cast("long").alias("_n"),
        F.length(t).cast("long").alias("_chars"),
        F.length(F.array_join(w, "")).cast("long").alias("_wc"),
        # "!" to "Z" and "|" hold all of the counted classes
        F.regexp_replace(t, "[^!-Z|]+", "").alias("_marks"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("_dup"),
        grams.alias("_g"),
        codes.alias("_codes"),
    )
    c, m = F.col("_codes"), F.col("_marks")
    base = base.select(
        "*", _count(m, SYMBOLS).alias("_sym"), _count(m, UPPER).alias("_up"),
        _count(m, DIGITS).alias("_dig"), _count(m, PUNCTUATION).alias("_pun"))
    return base.select("_row", "_lang", F.struct(
        F.col("_n").alias("n_words"),
        F.col("_wc").alias("word_chars"),
        F.col("_sym").alias("n_symbols"),
        F.col("_dup").alias("n_dup_lines"),
        let(F.col("_g"), _repeated_words).alias("n_repeat_words"),
        F.col("_chars").alias("n_chars"),
        F.array(
            F.col("_up"), F.col("_dig"), F.col("_chars") - F.col("_wc"), F.col("_pun"), F.col("_sym"),
            F.col("_wc") - F.col("_up") - F.col("_dig") - F.col("_pun") - F.col("_sym"),
        ).alias("classes"),
        F.array(*[
            (F.length(c) - F.length(F.replace(c, F.lit(k), F.lit("")))).cast("long") for k in CODES
        ]).alias("common"),
    ).alias("_stat"))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (0 to 1, base 2) of two arrays of counts; null if one is all zero."""

    def shares(counts):
        total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return let(total, lambda n: F.transform(counts, lambda x: x / n))

    def half(x, y):
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    def distance(a, b):
        terms = F.zip_with(a, b, lambda x, y: half(x, y) + half(y, x))
        total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
        return F.sqrt(F.greatest(total / 2, F.lit(0.0)))

    some = lambda c: F.exists(c, lambda x: x > 0)
    return F.when(some(p) & some(q), let(F.struct(shares(p).alias("a"), shares(q).alias("b")),
                                         lambda s: distance(s["a"], s["b"])))


def rate(docs: DataFrame, text: str = "text", lang: str = "lang", min_words: int = 50,
         max_class_distance: float = 0.25, max_word_distance: float = 0.31,
         guard_chars: int = 200, guard_words: int = 100, columns: list[str] | None = None) -> DataFrame:
    """The given ``columns`` of ``docs`` (all of them if None) and: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept.

    ``base_failed``: under ``min_words`` words, or more than half of the words in repeated 3-word
    windows. ``kept``: not failed and, where the text is long enough to tell (``guard_chars``,
    ``guard_words``), within the two distances of its language. Null and empty texts fail. Ties
    and repeated rows are rated alike, row by row; an empty table gives an empty result. Columns of
    ``docs`` named like an output are replaced.

    The counts are stored once with the wanted columns, so that the texts are read once: the
    references are sums over these rows, one row per language. They are broadcast where there are few
    languages; a table of more than ``FEW`` languages is joined by language.
    """
    rows = judged(docs, text, lang, min_words, max_class_distance, max_word_distance, guard_chars, guard_words, columns)
    keep = [c for c in (docs.columns if columns is None else columns) if c not in OUT]
    return rows.select(*unpacked(keep), "_out.*")


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", min_words: int = 50,
           max_class_distance: float = 0.25, max_word_distance: float = 0.31,
           guard_chars: int = 200, guard_words: int = 100, columns: list[str] | None = None) -> DataFrame:
    """As ``rate``, but in two structs: ``_row`` with the columns of ``docs``, whatever their names, and
    ``_out`` with the results."""
    rated = stored(text_statistics(docs, text, lang, columns), "quality")

    def summed(name, n):
        return F.array(*[F.sum(F.col(f"_stat.{name}")[i]) for i in range(n)])

    reference = stored(rated.groupBy(F.col("_lang").alias("_ref")).agg(
        summed("classes", len(CLASSES)).alias("_classes"), summed("common", len(CODES)).alias("_common")), "languages")
    if reference.count() <= FEW:
        reference = F.broadcast(reference)
    s, out = F.col("_stat"), {}
    out["class_distance"] = jensen_shannon(s["classes"], F.col("_classes"))
    out["word_distance"] = jensen_shannon(s["common"], F.col("_common"))
    failed = (s["n_words"] < min_words) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
    near = F.coalesce(F.col("_d.class_distance") <= max_class_distance, F.lit(True))
    usual = F.coalesce(F.col("_d.word_distance") <= max_word_distance, F.lit(True))
    kept = ~failed & ((s["n_chars"] < guard_chars) | near) & ((s["n_words"] < guard_words) | usual)
    counts = [s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return (
        rated.join(reference, F.col("_lang") == F.col("_ref"))
        .select("_row", "_stat", F.struct(*[c.alias(n) for n, c in out.items()]).alias("_d"))
        .select("_row", F.struct(
            *counts, failed.alias("base_failed"), *[F.col("_d")[n].alias(n) for n in out], kept.alias("kept")).alias("_out")))
