"""Quality rules: how far a text's histograms are from those of its language."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import words_column
from tidemark.session import materialise

COMMON_WORDS: Mapping[str, Sequence[str]] = {
    "en": "the of and to in a is that for it was on with as be this".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par".split(),
    "es": "de la que el en y a los del se las por un para con no".split(),
}
OTHER_WORDS = "the of and to der die und in de la le et que el en y".split()
MIN_WORDS, MIN_CHARS = 150, 500
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.27, 0.295


def bound_once(value: Column, body) -> Column:
    """body(value), with `value` computed once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


FEW = 16


def repeated_words(words: Column) -> Column:
    """How many words lie in a 3-word window that stands twice or more in the text.

    Windows are compared by 64-bit hashes. Texts without a repeated window need
    no more than the set of them. Where few windows repeat, their places are
    looked up; where many do, windows are sorted together with their places.
    """

    def hashes_of(w: Column) -> Column:
        # The last two hashes lack words, so they equal no window.
        return F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def of(h: Column) -> Column:
        many = bound_once(F.array_sort(h), lambda s: F.array_distinct(F.filter(s, lambda x, k: x == F.get(s, k + 1))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            bound_once(many, lambda again: F.when(F.size(again) <= FEW, covered(looked_up(h, again))).otherwise(covered(sorted_out(h))))
        )

    def looked_up(h: Column, again: Column) -> Column:
        return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(again, x), i)), lambda i: i.isNotNull())

    def sorted_out(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twins = lambda s: F.filter(s, lambda x, k: (
            (x["h"] == F.when(k > 0, F.get(s, k - 1)["h"])) | (x["h"] == F.get(s, k + 1)["h"])
        ))
        return F.array_sort(F.transform(bound_once(pairs, twins), lambda x: x["i"]))

    def covered(places: Column) -> Column:
        zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            places, zero,
            lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    return F.when(F.size(words) >= 3, bound_once(bound_once(words, hashes_of), of)).otherwise(F.lit(0).cast("long"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts; null if either is all 0."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    term = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    sp, sq = total(p), total(q)
    shares = F.zip_with(p, q, lambda a, b: F.struct((a / sp).alias("a"), (b / sq).alias("b")))
    parts = F.transform(shares, lambda s: (term(s["a"], (s["a"] + s["b"]) / 2) + term(s["b"], (s["a"] + s["b"]) / 2)) / 2)
    return F.when((sp > 0) & (sq > 0), F.sqrt(F.greatest(total(parts), F.lit(0.0))))


def histograms(docs: DataFrame) -> DataFrame:
    """doc_id, lang, base counts, and the two histograms of every whole text."""
    text = F.coalesce(F.col("`text`"), F.lit(""))
    rows = docs.select("doc_id", "lang", text.alias("text"), words_column(text).alias("words"))
    lists = F.create_map(*[x for lang, words in COMMON_WORDS.items() for x in (F.lit(lang), F.array(*map(F.lit, words)))])
    common = F.coalesce(lists[F.col("lang")], F.array(*map(F.lit, OTHER_WORDS)))
    # Only the common words of any language, with two spaces between them so that neighbours don't share one.
    known = sorted({w for words in COMMON_WORDS.values() for w in words})
    few = F.filter(F.transform("words", F.lower), lambda w: w.isin(known))
    padded = F.concat(F.lit(" "), F.array_join(few, "  "), F.lit(" "))
    counts = lambda s: F.transform(common, lambda w: (
        (F.octet_length(s) - F.octet_length(F.replace(s, F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))) / (F.octet_length(w) + 2)
    ))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = lambda pattern: F.regexp_count("text", F.lit(pattern)).cast("double")
    rows = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "n_chars": F.char_length("text").cast("long"),
        "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
        "n_symbols": n(r"[#*$%&|<>]").cast("long"),
        "n_dup_lines": bound_once(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": repeated_words(F.col("words")),
        "of_words": bound_once(padded, counts),
        "upper": n(r"[A-Z]"), "ascii_marks": n(r"[!-@\[-`{-~]"),
        "wide": (F.octet_length("text") - F.char_length("text")).cast("double"),
    })
    spaces, symbols = (F.col("n_chars") - F.col("word_chars")).cast("double"), F.col("n_symbols").cast("double")
    marks = F.col("ascii_marks") - symbols
    plain = F.greatest(F.lit(0.0), F.col("word_chars") - F.col("upper") - F.col("ascii_marks") - F.col("wide"))
    total = F.aggregate("of_words", F.lit(0.0), lambda a, v: a + v)
    return rows.select(
        "doc_id", "lang", "n_words", "n_chars", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.array(plain, F.col("upper"), marks, F.col("wide"), symbols, spaces).alias("char_counts"),
        F.concat(F.col("of_words"), F.array(F.greatest(F.lit(0.0), F.col("n_words") - total))).alias("word_counts"),
    )


def judged_texts(
    docs: DataFrame, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE,
    min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS,
) -> DataFrame:
    """Per row of `docs` (doc_id, text, lang): base counts, base_failed, distances and kept.

    The reference of a language is the sum of its documents' histograms, all of
    them: character classes, and the language's common words against the rest
    (languages without a list take a mixed one). A text that passes the base rules
    is dropped if its character classes are further than `max_char` from the
    reference, or its words further than `max_word`. A text below `min_chars`
    characters is not held against the one, below `min_words` words against the
    other: short texts are far from anything by chance.

    Null and empty texts have no words and fail the base rules. A null lang is a
    language of its own. Repeated rows are judged alike; other columns are ignored.
    """
    rows = materialise(histograms(docs), "histograms")
    sums = lambda c, n: [F.sum(F.col(c)[k]).alias(f"{c}{k}") for k in range(n)]
    n_chars, n_common = 6, 17
    reference = rows.groupBy("lang").agg(*sums("char_counts", n_chars), *sums("word_counts", n_common)).select(
        F.col("lang").alias("_lang"),
        F.array(*[F.col(f"char_counts{k}") for k in range(n_chars)]).alias("lang_chars"),
        F.array(*[F.col(f"word_counts{k}") for k in range(n_common)]).alias("lang_words"),
    )
    joined = rows.join(reference, F.col("lang").eqNullSafe(F.col("_lang"))).withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "char_distance": distance(F.col("char_counts"), F.col("lang_chars")),
        "word_distance": distance(F.col("word_counts"), F.col("lang_words")),
    })
    far = ((F.col("n_chars") >= min_chars) & (F.col("char_distance") > max_char)) | (
        (F.col("n_words") >= min_words) & (F.col("word_distance") > max_word)
    )
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"), "char_distance", "word_distance",
    )
