"""Quality rules: word and line repetition, and the distance of a text from its language's usual profile.

Only DataFrame functions. ``text_features`` makes one row of counts per document; ``quality_rules`` judges.

Base rules: a text fails with fewer than 20 words, or when more than 30 % of its words lie in 8-word
sequences that the text has twice or more.

Distribution divergence. Two histograms describe a text: its non-space characters by class (lower-case
letters, upper-case letters, digits, sentence punctuation, symbols, everything else) and its words over the common
words of its language (one bin for each, one for all others). A language's references are the same
histograms summed over all documents of that language that pass the base rules and, in a second round, are
not far from the first round's references, so that junk does not blur them; texts in a language without
a list of common words use the sum over all languages and the character classes only. The Jensen-Shannon
distance (base 2, so between 0 and 1) of a histogram and its reference must not exceed a threshold. Guards:
short texts have noisy histograms, so the distance is only judged from ``MIN_CHARS`` characters and
``MIN_WORDS`` words on. The character threshold widens by ``NOISE`` times the expected sampling distance,
``sqrt(bins / (8 ln 2 * count))``.

The word threshold is ``WORD_SHARE`` of the distance that a text without a common word has in this language. Its square
widens by the squared sampling distance, which is ``chi-square / (8 ln 2 * words)`` with one degree of freedom less than
bins, taken ``NOISE`` standard deviations up. 17 bins tell such a text from about 80 words on, so the two bins common and
other are judged as well (only texts with too few common words), which takes about 20. The references' first round
judges words by these two bins alone: a reference that junk fills to more than a half is far from good texts, too.

Nothing here joins by a key with hot values: references are one row per listed language (a fixed number),
which is broadcast. Windows are hashed to 64 bits and compared within one text only.

Defined cases: null text counts as empty (and fails); null ids and repeated rows are judged row by row;
an empty table gives an empty result; other columns are ignored, or kept by ``keep_quality``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.llm.frames import cut_lineage, forget, fresh, read

#: Frequent function words, in lower case.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as", "are", "by"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "des", "auf", "ist", "im", "dem", "nicht", "ein"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su"],
}
N_CLASSES = 6
N_COMMON = 16
MIN_CHARS = 40
MIN_WORDS = 20
MAX_CHAR_DISTANCE = 0.12
WORD_SHARE = 0.5
#: Sampling distances added to a threshold.
NOISE = 3.0
#: Java regular expressions.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (a column used inside a lambda is computed for every element)."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _repeat_words(words: Column, n: int = 8) -> Column:
    """Words inside n-word windows that occur twice or more."""
    def marked(windows: Column) -> Column:
        def covered(order: Column) -> Column:
            same = lambda e, i, d: F.coalesce(F.get(order, i + d)["h"] == e["h"], F.lit(False))
            at = F.array_sort(F.transform(F.filter(order, lambda e, i: same(e, i, -1) | same(e, i, 1)), lambda e: e["i"]))
            return let(at, lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(p, i + 1) - x, F.lit(n)))), F.lit(0), lambda a, x: a + x))
        order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(order, covered))

    def hashed(h: Column) -> Column:
        windows = F.transform(F.slice(h, 1, F.greatest(F.size(h) - (n - 1), F.lit(0))),
                              lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, n)]))
        return let(windows, marked)

    return F.when(F.size(words) < n + 1, F.lit(0)).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), hashed))


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, char_classes, common_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    only = lambda keep: F.length(F.regexp_replace(text, f"[^{keep}]+", "")).cast("long")
    lists = F.create_map(*[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])

    def counted(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        common = let(F.coalesce(F.element_at(lists, lang), F.array().cast("array<string>")), lambda names: let(
            F.filter(F.transform(words, lambda w: F.lower(w)), lambda w: F.array_contains(names, w)),
            lambda seen: F.transform(names, lambda x: F.size(F.filter(seen, lambda w: w == x)).cast("long"))))
        return F.struct(
            F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            only("#*$%&|<>").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"), common.alias("common"))

    out = docs.select(F.col(id_col).alias("doc_id"), lang.alias("lang"), let(words_of(text), counted).alias("f"),
                      only(r"\p{Ll}").alias("lower"), only(r"\p{Lu}").alias("upper"), only("0-9").alias("digits"),
                      only(r".,;:?!'\"()\-").alias("marks"))
    rest = F.col("f.word_chars") - F.col("lower") - F.col("upper") - F.col("digits") - F.col("marks") - F.col("f.n_symbols")
    return out.select("doc_id", "lang", "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines", "f.n_repeat_words",
                      F.array("lower", "upper", "digits", "marks", "f.n_symbols", rest).alias("char_classes"), F.col("f.common").alias("common"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms of counts; null when one of them is empty."""
    total = lambda x: F.aggregate(x, F.lit(0).cast("double"), lambda a, v: a + v.cast("double"))
    plogp = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def distance(t: Column) -> Column:
        def term(x: Column, y: Column) -> Column:
            p, q = x / t["p"], y / t["q"]
            m = (p + q) / 2
            return (plogp(p, m) + plogp(q, m)) / 2
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(F.zip_with(counts, reference, term), F.lit(0.0), lambda a, v: a + v)))

    return let(F.struct(total(counts).alias("p"), total(reference).alias("q")),
               lambda t: F.when((t["p"] > 0) & (t["q"] > 0), distance(t)))


def language_references(features: DataFrame) -> DataFrame:
    """One row per listed language and one (lang = '') for all: histograms summed over documents that pass the
    base rules, then again over those of them that are within the thresholds of the first sums."""
    first = _judged(features, _references(features)).filter("not (base_failed or far or few)").select(features.columns)
    return _references(first)


def _references(features: DataFrame) -> DataFrame:
    known = F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang"))
    sums = [F.coalesce(F.sum(F.get("char_classes", F.lit(i))), F.lit(0)) for i in range(N_CLASSES)]
    sums += [F.coalesce(F.sum(F.get("common", F.lit(i))), F.lit(0)) for i in range(N_COMMON)] + [F.coalesce(F.sum("n_words"), F.lit(0))]
    names = [f"s{i}" for i in range(len(sums))]
    per = features.filter(~base_failed()).withColumn("lang", known).groupBy("lang").agg(*[s.alias(n) for s, n in zip(sums, names)])
    every = per.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).withColumn("lang", F.lit(""))
    out = per.filter("lang is not null").unionByName(every)
    return out.select(F.col("lang").alias("ref_lang"), F.array(*names[:N_CLASSES]).alias("ref_chars"),
                      F.array(*names[N_CLASSES:N_CLASSES + N_COMMON]).alias("ref_common"), F.col(names[-1]).alias("ref_words"))


def _with_rest(common: Column, words: Column) -> Column:
    return let(common, lambda c: F.concat(c, F.array(words - F.aggregate(c, F.lit(0).cast("long"), lambda a, v: a + v))))


def _judged(features: DataFrame, references: DataFrame) -> DataFrame:
    """``features`` with char_distance, word_distance, base_failed and what speaks against a text: far (characters),
    odd (words) and few (too few common words)."""
    known = F.col("lang").isin(*COMMON_WORDS)
    out = features.withColumn("ref_lang", F.when(known, F.col("lang")).otherwise("")).join(F.broadcast(references), "ref_lang", "left")
    noise = lambda bins, n: NOISE * F.sqrt(F.lit(bins / (8 * 0.6931471805599453)) / F.greatest(n, F.lit(1)))
    # Fisher's approximation of the chi-square quantile.
    most = lambda bins, n: F.lit((math.sqrt(2 * bins - 3) + NOISE) ** 2 / 2 / (8 * math.log(2))) / F.greatest(n, F.lit(1))
    two = lambda common, n: let(F.aggregate(common, F.lit(0).cast("long"), lambda a, v: a + v), lambda c: F.array(c, n - c))
    ref_two = two(F.col("ref_common"), F.col("ref_words"))
    out = out.withColumns({
        "char_distance": js_distance(F.col("char_classes"), F.col("ref_chars")),
        "word_distance": F.when(known, js_distance(_with_rest(F.col("common"), F.col("n_words")), _with_rest(F.col("ref_common"), F.col("ref_words")))),
        "__two": F.when(known, two(F.col("common"), F.col("n_words"))), "__ref_two": F.when(known, ref_two),
        "__limit": F.when(known, WORD_SHARE * js_distance(F.array(F.lit(0), F.lit(1)), ref_two)),
        "base_failed": base_failed()})
    far = (F.col("word_chars") >= MIN_CHARS) & (F.col("char_distance") > MAX_CHAR_DISTANCE + noise(N_CLASSES, F.col("word_chars")))
    beyond = lambda d, bins: (F.col("n_words") >= MIN_WORDS) & (d * d > F.pow("__limit", F.lit(2)) + most(bins, F.col("n_words")))
    fewer = F.get("__two", F.lit(0)) * F.col("ref_words") < F.get("__ref_two", F.lit(0)) * F.col("n_words").cast("double")
    judged = {"far": far, "odd": beyond(F.col("word_distance"), N_COMMON + 1), "few": fewer & beyond(js_distance(F.col("__two"), F.col("__ref_two")), 2)}
    return out.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in judged.items()}).drop("__two", "__ref_two", "__limit")


def judge(features: DataFrame, references: DataFrame) -> DataFrame:
    """``features`` with char_distance, word_distance, base_failed and kept."""
    return _judged(features, references).withColumn("kept", F.expr("not (base_failed or far or odd or few)")).drop("far", "odd", "few")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """Per row of ``docs``: the features, the two distances, base_failed and kept."""
    features = cut_lineage(text_features(docs, id_col, text_col, lang_col))
    return judge(features, language_references(features))


def keep_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are."""
    # The verdict depends on text and language alone. Features are written without the text, so nothing large stays behind.
    one, two, both = (fresh(docs, c) for c in ("__key_1", "__key_2", "__keys"))
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    keyed = docs.withColumns({one: F.xxhash64(F.lit(1), text, lang), two: F.xxhash64(F.lit(2), lang, text)})
    features = cut_lineage(text_features(keyed.withColumn(both, F.struct(F.col(one).alias(one), F.col(two).alias(two))), both, text_col, lang_col))
    rejected = cut_lineage(judge(features, language_references(features.drop("doc_id"))).filter("not kept").select("doc_id.*").distinct())
    forget(docs.sparkSession, features)
    return keyed.join(rejected, [one, two], "left_anti").select(*docs.columns)


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = quality_rules(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))
