"""Quality rules: divergence of a text's histograms from those of known languages.

Two histograms describe a text: shares of character classes, and shares of common function
words with everything else in one further bin. Language references are the same histograms
summed over all documents that carry the language's label. A text is rejected if it is long
enough for its histogram to mean something and its Jensen-Shannon distance to the nearest
reference exceeds a bound. All of it is Spark SQL expressions on one row at a time; the only
shuffle adds up the references, a few numbers a language.

Defined results: null text counts as empty and has no words. Base failures are rejected
whatever the distances. Rows with null or repeated ids are kept as they are. Without any
labelled document there is no reference, and the method rejects nothing. An empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import WORD

# Common function words of four languages.
COMMON_WORDS = {
    "en": "the of and to in is that it for was on with as be by at are this from or an a",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur",
    "es": "de la que el en y a los se del las un por con no una su para es al",
}
BINS = sorted({w for line in COMMON_WORDS.values() for w in line.split()})
LONGEST_BIN = max(map(len, BINS))
CLASSES = ["lower", "upper", "digit", "space", "point", "sign"]

MIN_WORDS, MAX_WORD_DISTANCE = 200, 0.30
MIN_CHARS, MAX_CLASS_DISTANCE = 300, 0.26
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

SPACE_RUN = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Reference:
    """Shares of a language's words (one a bin, the rest is other words) and character classes."""

    language: str
    words: list[float]
    classes: list[float]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Windows are compared by a 64-bit hash chained over their words, sorted with their places.
    """
    def covered(places):
        return F.aggregate(F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)

    def places(pairs):
        def again(e, i):
            return F.coalesce(F.get(pairs, i - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(pairs, i + 1)["h"] == e["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(pairs, again), lambda e: e["i"]))

    def count(hashes):
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(let(pairs, places), covered))

    hashes = let(words, lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    return F.when(F.size(words) >= 3, let(hashes, count)).otherwise(F.lit(0))


def _duplicate_lines(text: Column) -> Column:
    def count(lines):
        return F.size(lines) - F.size(F.array_distinct(lines))
    return let(F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)), count)


def histograms(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id, text (never null), words, bare (without white space), common (counts by bin), classes (counts)."""
    df = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *extra)
    df = df.withColumns({"words": F.array_remove(F.split("text", SPACE_RUN), ""), "bare": F.regexp_replace("text", SPACE_RUN, "")})
    df = df.withColumns({"rest": F.regexp_replace("bare", r"[\p{Ll}\p{Lo}\p{M}]+", ""), "small": F.sort_array(F.filter(F.transform(F.filter("words", lambda w: F.length(w) <= LONGEST_BIN), lambda w: F.lower(w)), lambda w: w.isin(BINS)))})
    df = df.withColumn("letters", F.length("bare") - F.length("rest"))
    upper = F.length(F.regexp_replace("rest", r"[^\p{Lu}\p{Lt}]+", ""))
    digit = F.length(F.regexp_replace("rest", r"[^\p{N}]+", ""))
    point = F.length(F.regexp_replace("rest", r"[^.,;:!?'\"()\-]+", ""))
    sign = F.length(F.regexp_replace("rest", r"[\p{Lu}\p{Lt}\p{N}.,;:!?'\"()\-]+", ""))
    places = F.lit(BINS)
    return df.withColumn("classes", F.array(F.col("letters"), upper, digit, F.length("text") - F.length("bare"), point, sign)).withColumn(
        "common",
        let(F.struct(F.col("small").alias("all"), F.array_distinct("small").alias("some")), lambda s: F.transform(s["some"], lambda w, i: F.struct(
            (F.array_position(places, w) - 1).cast("int").alias("bin"),
            (F.coalesce(F.array_position(s["all"], F.get(s["some"], i + 1)), F.size(s["all"]) + 1) - F.array_position(s["all"], w)).cast("long").alias("n")))),
    )


def language_references(docs: DataFrame) -> list[Reference]:
    """References from all documents with a language label; two rows of numbers a language reach the driver."""
    counts = histograms(docs.where("lang is not null"), "lang")
    rows = counts.select("lang", F.explode(F.concat(
        F.transform("common", lambda c: F.struct(c["bin"].alias("bin"), c["n"].alias("n"))),
        F.transform("classes", lambda n, i: F.struct((i + len(BINS)).alias("bin"), n.cast("long").alias("n"))),
        F.array(F.struct(F.lit(len(BINS) + len(CLASSES)).alias("bin"), F.size("words").cast("long").alias("n"))),
    )).alias("c"))
    sums: dict[str, dict[int, int]] = {}
    for lang, place, n in rows.groupBy("lang", "c.bin").agg(F.sum("c.n")).collect():
        sums.setdefault(lang, {})[place] = n
    out = []
    for lang in sorted(sums):
        found = sums[lang]
        words, chars = found[len(BINS) + len(CLASSES)], sum(found.get(len(BINS) + i, 0) for i in range(len(CLASSES)))
        if words and chars:
            out.append(Reference(lang, [found.get(i, 0) / words for i in range(len(BINS))], [found.get(len(BINS) + i, 0) / chars for i in range(len(CLASSES))]))
    return out


def _part(p: Column, q: Column) -> Column:
    """What one bin adds to twice the Jensen-Shannon divergence in bits."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0)) + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(F.lit(0.0))


def _distance(parts: Column) -> Column:
    return F.sqrt(F.greatest(parts, F.lit(0.0)) / 2)


def word_distance(common: Column, counted: Column, words: Column, reference: Reference) -> Column:
    """Jensen-Shannon distance of common-word shares; bins the text lacks add half their reference share.

    ``counted`` is the number of common words in all bins of the text.
    """
    shares = F.lit(reference.words)

    def add(total, c):
        # what the bin adds, instead of the whole reference share it would add if the text lacked it
        return let(F.struct((c["n"] / words).alias("p"), F.get(shares, c["bin"]).alias("q")), lambda s: total + _part(s["p"], s["q"]) - s["q"])
    others = _part(F.greatest(1 - counted / words, F.lit(0.0)), F.lit(1.0 - sum(reference.words)))
    return _distance(F.aggregate(common, F.lit(sum(reference.words)), add) + others)


def class_distance(classes: Column, chars: Column, reference: Reference) -> Column:
    """Jensen-Shannon distance of the shares of character classes."""
    return _distance(sum((_part(classes[i] / chars, F.lit(q)) for i, q in enumerate(reference.classes)), F.lit(0.0)))


def judged(docs: DataFrame, references: list[Reference], *extra: str) -> DataFrame:
    """Base counts, distances to the nearest reference, and the verdict of every row."""
    df = histograms(docs, *extra).select(
        "doc_id", *extra, "common", "classes", F.size("small").cast("double").alias("_counted"), F.size("words").cast("long").alias("n_words"), F.length("bare").cast("long").alias("word_chars"), F.length("text").alias("_chars"),
        (F.length("rest") - F.length(F.translate("rest", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        _duplicate_lines(F.col("text")).cast("long").alias("n_dup_lines"), _repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )
    words, chars = F.col("n_words").cast("double"), F.col("_chars").cast("double")
    near = {"word_distance": [word_distance(F.col("common"), F.col("_counted"), words, r) for r in references], "class_distance": [class_distance(F.col("classes"), chars, r) for r in references]}
    near = {k: F.least(*v) if len(v) > 1 else v[0] if v else F.lit(None).cast("double") for k, v in near.items()}
    df = df.withColumns({"word_distance": F.when(F.col("n_words") >= MIN_WORDS, near["word_distance"]), "class_distance": F.when(F.col("_chars") >= MIN_CHARS, near["class_distance"])})
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    odd = F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False)) | F.coalesce(F.col("class_distance") > MAX_CLASS_DISTANCE, F.lit(False))
    # A filter on the verdict would be pushed below the projections, and every histogram in it computed
    # anew for each place that names it. Spark leaves filters above a column that is not deterministic.
    stay = F.monotonically_increasing_id() >= 0
    return df.select("doc_id", *extra, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~odd & stay).alias("kept"), "word_distance", "class_distance")


def quality(docs: DataFrame) -> DataFrame:
    """:func:`judged` against references from ``docs`` itself."""
    return judged(docs.withColumn("doc_id", F.col("doc_id").cast("long")), language_references(docs))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep; all columns stay as they are."""
    references = language_references(docs) if "lang" in docs.columns else []
    rows = judged(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_rest")), references, "_rest")
    return rows.where("kept").select("_rest.*")
