"""Quality rules by distribution divergence, in Spark's own functions only.

A document's histogram of character classes and its histogram of common words are compared with references of its
language by Jensen-Shannon distance. References are sums over all documents of the language that pass the base rules,
for every language that the table holds. Common words are fixed for four languages and counted for the others.
Short texts say too little about their distribution and are guarded by least lengths.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aforo.llm.common import Staging
from aforo.operators.joins import lookup_join

# Frequent words of some languages.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "que"],
}
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})
# Of a language without a fixed list, so many of its most frequent words.
OWN_WORDS = 10
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# White space between words, as a pattern and as characters.
GAPS = r"[\x20\x09-\x0D]+"
SPACE, MARKS, SYMBOLS = " \t\n\v\f\r", ".,;:!?'\"()-", "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "mark", "symbol", "other")
SPAN = 5
# Bits of a window's place: more than a text can have words.
PLACE = (1 << 28) - 1
LEAST_WORDS = 10
REPEATED_PERCENT = 20
# Guards: shorter texts pass that comparison.
LEAST_CHARS = 120
LEAST_COMMON = 40
# Greatest distances of a long text, and what a short one may differ more by chance.
MOST_CHARS, CHARS_NOISE = 0.08, 2.6
MOST_COMMON, COMMON_NOISE = 0.11, 0.85


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(words: Column) -> Column:
    """Number of words in windows of five that occur twice or more."""

    def covered(h: Column) -> Column:
        # The hash's upper bits with the place below them, so that sorting longs brings equal windows together.
        place = lambda x: x.bitwiseAND(PLACE)
        packed = F.transform(h, lambda x, i: x.bitwiseAND(~PLACE).bitwiseOR(i.cast("long")))

        def again(s: Column) -> Column:
            full = lambda j: F.get(h, place(F.get(s, j)).cast("int"))
            same = lambda x, j: F.when(j >= 0, F.coalesce(full(j) == x, F.lit(False))).otherwise(F.lit(False))
            near = lambda x, j: reduce(lambda a, b: a | b, [same(x, j + d) for d in (-1, 1, -2, 2)])
            twice = F.filter(s, lambda x, j: near(F.get(h, place(x).cast("int")), j))
            places = F.sort_array(F.transform(twice, place))
            start = F.struct(F.lit(-SPAN).cast("long").alias("before"), F.lit(0).cast("long").alias("n"))
            step = lambda a, i: F.struct(
                i.alias("before"), (a["n"] + F.least(F.lit(SPAN).cast("long"), i - a["before"])).alias("n")
            )
            return F.aggregate(places, start, step, lambda a: a["n"])

        return let(F.sort_array(packed), again)

    def windows(h: Column) -> Column:
        run = lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SPAN)])
        return F.transform(F.sequence(F.lit(0), F.size(h) - SPAN), run)

    none = F.lit(0).cast("long")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    counted = let(
        let(hashes, windows), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h))
    )
    return F.when(F.size(words) <= SPAN, none).otherwise(counted)


def measured(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: the counts that the rules use, with ``classes`` and ``common`` as arrays of counts.

    ``own`` are the lower-cased words where the language has no fixed list of common ones, else NULL.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{lang}`").alias("lang"), body.alias("t"))
    rows = rows.select(
        key,
        "lang",
        F.array_remove(F.split("t", GAPS), "").alias("words"),
        F.length("t").alias("chars"),
        _without(F.col("t"), LOWER).alias("rest"),
        F.filter(F.split("t", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0).alias("lines"),
    )
    rest, size = F.col("rest"), lambda c: F.length(_without(F.col("rest"), c))
    known = {c: F.length(rest) - size(c) for c in (UPPER, DIGITS, SPACE, MARKS, SYMBOLS)}
    numbers = F.create_map(*[F.lit(x) for i, w in enumerate(VOCABULARY) for x in (w, i)])
    common = F.filter(
        F.transform("words", lambda w: F.when(F.length(w) <= 4, F.element_at(numbers, F.lower(w)))),
        lambda i: i.isNotNull(),
    )
    counted = lambda i: [F.size(i) - F.size(F.array_remove(i, n)) for n in range(len(VOCABULARY))]
    return rows.select(
        key,
        "lang",
        F.size("words").cast("long").alias("n_words"),
        (F.col("chars") - known[SPACE]).cast("long").alias("word_chars"),
        known[SYMBOLS].cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.array(F.col("chars") - F.length(rest), *known.values(), F.length(rest) - sum(known.values())).cast("array<long>").alias("classes"),
        let(common, lambda i: F.array(*counted(i)).cast("array<long>")).alias("common"),
        F.when(~F.col("lang").isin(*COMMON_WORDS), F.transform("words", F.lower)).alias("own"),
    )


def _distance(counts: Column, reference: Column | list[int]) -> Column:
    """Jensen-Shannon distance of an array of counts to a reference; NULL where either is empty or missing."""
    if isinstance(reference, list):
        reference = F.array(*[F.lit(n) for n in reference]).cast("array<long>")
    part = lambda p, m: F.when(p > 0, p * F.log(p / m)).otherwise(F.lit(0.0))
    both = lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, n: a + n)
    shares = lambda c: let(total(c), lambda t: F.transform(c, lambda n: n / t))
    terms = F.zip_with(shares(counts), shares(reference), both)
    distance = F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))
    return F.when((total(counts) > 0) & (total(reference) > 0), distance)


def _own_words(sound: DataFrame) -> DataFrame:
    """(own_lang, top): of each language without a fixed list its most frequent words that have a letter."""
    words = sound.where("own IS NOT NULL").select("lang", F.explode("own").alias("word")).where(F.col("word").rlike(r"\p{L}"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))
    first = words.groupBy("lang", "word").count().withColumn("place", place).where(F.col("place") <= OWN_WORDS)
    return first.groupBy(F.col("lang").alias("own_lang")).agg(F.sort_array(F.collect_list("word")).alias("top"))


def _with_histogram(rows: DataFrame, stage: Staging) -> DataFrame:
    """``histogram`` for ``own``: counts by common word of the row's language with all other words as the last."""
    fixed = lambda words: F.array(*[F.get("common", F.lit(VOCABULARY.index(w))) for w in words])
    counts = reduce(lambda c, n: c.when(F.col("lang") == n, fixed(COMMON_WORDS[n])), COMMON_WORDS, F)
    if not rows.where("own IS NOT NULL").isEmpty():
        top = stage.table(_own_words(rows.where("NOT base_failed")), "words")
        rows = lookup_join(rows, top, [("lang", "own_lang")], "left")
        of = lambda w: (F.size("own") - F.size(F.array_remove("own", w))).cast("long")
        counts = counts.otherwise(F.transform("top", of))
    rest = lambda n: F.col("n_words") - F.aggregate(n, F.lit(0).cast("long"), lambda a, x: a + x)
    made = let(counts, lambda n: F.concat(n, F.array(rest(n))))
    return rows.withColumn("histogram", made).drop("own", "common", "top")


def _references(rows: DataFrame) -> DataFrame:
    """(ref_lang, ref_classes, ref_histogram): sums of both histograms by language; a row without one has no reference."""
    most = max(OWN_WORDS, *map(len, COMMON_WORDS.values())) + 1
    # A shorter list of words has NULL sums at its end.
    summed = lambda c, n: F.array_compact(F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(n)]))
    return (
        rows.where("lang IS NOT NULL")
        .groupBy(F.col("lang").alias("ref_lang"))
        .agg(summed("classes", len(CLASSES)).alias("ref_classes"), summed("histogram", most).alias("ref_histogram"))
    )


def _compared(rows: DataFrame, references: DataFrame, most_chars: float, most_common: float) -> DataFrame:
    """The distances to the row's language and whether one is too great for the text's length."""
    rows = lookup_join(rows, references, [("lang", "ref_lang")], "left")
    out = {
        "js_chars": _distance(F.col("classes"), F.col("ref_classes")),
        "js_common": _distance(F.col("histogram"), F.col("ref_histogram")),
    }
    chars = F.col("word_chars") + F.get("classes", F.lit(CLASSES.index("space")))
    by_chars = F.col("js_chars") > most_chars + CHARS_NOISE / F.sqrt(chars)
    by_common = F.col("js_common") > most_common + COMMON_NOISE / F.sqrt("n_words")
    long_chars, long_words = chars >= LEAST_CHARS, F.col("n_words") >= LEAST_COMMON
    diverges = F.coalesce(long_chars & by_chars, F.lit(False)) | F.coalesce(long_words & by_common, F.lit(False))
    return rows.withColumns(out).withColumn("diverges", diverges).drop("ref_classes", "ref_histogram")


def judged(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    most_chars: float = MOST_CHARS,
    most_common: float = MOST_COMMON,
) -> DataFrame:
    """Per row: the key, the counts, ``base_failed``, the distances ``js_chars`` and ``js_common`` and ``kept``.

    The reference is that of the row's language, whichever languages the table holds; a row without a language has none.
    Texts below the guards, and comparisons without a reference, pass. A NULL or empty text has no words and fails
    the base rules. Equal rows get equal results; other columns are not read.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    rows = measured(df, key, text, lang).withColumn("base_failed", failed)
    stage = Staging(df.sparkSession, "rules")
    rows = _with_histogram(stage.table(rows, "measured"), stage)
    sound = rows.where("NOT base_failed")
    # Junk that passes the base rules would be part of its own reference; the second one is without it.
    first = _compared(sound, stage.table(_references(sound), "first"), most_chars, most_common)
    second = stage.table(_references(first.where("NOT diverges")), "second")
    out = _compared(rows, second, most_chars, most_common)
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("diverges")).drop("classes", "histogram", "lang", "diverges")
