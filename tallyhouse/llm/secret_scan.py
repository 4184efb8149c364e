"""Secrets in texts: fixed patterns, and strings that look more random than an identifier.

Two character Markov models are trained from labelled strings, one on random strings (keys,
digests, passwords), one on ordinary identifiers and words. A long run of key characters is
reported if its log-likelihood ratio between the models exceeds a bound. Scanning is Spark SQL
expressions on one row at a time, without a shuffle; the trained model, a table of a fixed
size, is a constant of the plan.

Defined results: null text counts as empty and has no spans. Equal rows are scanned one by
one; ids may be null or repeat. Without labelled strings of both kinds the models are flat and
nothing is added to the fixed patterns. An empty table gives an empty result; other columns
are ignored. Positions count code points from 0, the end is exclusive.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.quality_rules import let

# The patterns of the base kinds. A match that fails its length is dropped but has used up its text.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{8,}"
MIN_RATIO = 12.0  # nats; a random string would have to be expected in one of e**12 runs
SAMPLE_DOCUMENTS = 20000  # documents that labelled strings are taken from, those with the smallest hashed ids

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: int, least_value: int = 0) -> Column:
    """Leftmost non-overlapping matches of a pattern as (start, kind, end).

    What lies between matches and the matches themselves, added up, give the places. With
    ``least_value``, matches whose second group is shorter are left out.
    """
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if least_value else 0)).alias("values"),
    )

    def placed(m):
        steps = F.transform(m["all"], lambda x, i: F.struct(F.length(F.get(m["gaps"], i)).alias("gap"), F.length(x).alias("size"), F.length(F.get(m["values"], i)).alias("value")))
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,value:int>>").alias("out"))

        def add(state, s):
            start = state["at"] + s["gap"]
            one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + s["size"]).alias("end"), s["value"].alias("value"))
            return F.struct((start + s["size"]).alias("at"), F.concat(state["out"], F.array(one)).alias("out"))
        out = F.aggregate(steps, empty, add, lambda state: state["out"])
        return F.transform(F.filter(out, lambda s: s["value"] >= least_value), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.when(text.rlike(pattern), let(found, placed)).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    return {
        "assign": _spans(text, ASSIGN, 0, ASSIGN_VALUE),
        "access": F.when(text.contains("AKIA"), _spans(text, ACCESS, 1)).otherwise(F.array().cast(_SPAN)),
        "hex": _spans(text, HEX, 2),
    }


def _values(text: Column) -> Column:
    """Strings that the fixed patterns find, without the names they are assigned to."""
    assigned = F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_VALUE)
    return F.concat(assigned, F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)), F.regexp_extract_all(text, F.lit(HEX), F.lit(0)))


def labelled_strings(docs: DataFrame) -> DataFrame:
    """``string``, ``random`` from at most ``SAMPLE_DOCUMENTS`` documents.

    Found values are random strings; long runs of key characters in documents where the
    patterns find nothing are identifiers.
    """
    ids = docs.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct().orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCUMENTS)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi").select(text.alias("text"))
    values = some.withColumn("values", _values(F.col("text")))
    plain = F.when(F.size("values") == 0, F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0)))
    strings = F.concat(
        F.transform("values", lambda v: F.struct(v.alias("string"), F.lit(True).alias("random"))),
        F.transform(F.coalesce(plain, F.array().cast("array<string>")), lambda v: F.struct(v.alias("string"), F.lit(False).alias("random"))),
    )
    return values.select(F.explode(strings).alias("s")).select("s.*")


def train(strings: DataFrame) -> list[float]:
    """Log ratios of two first-order models for every pair of characters, the start of a string included.

    Pairs are counted by Spark; the counts of at most two tables over the alphabet reach the
    driver. Each transition count starts at one half.
    """
    pairs = strings.where("string is not null and random is not null").select("random", F.explode(_pairs(F.col("string"))).alias("pair"))
    size = len(ALPHABET) + 1
    counts = {kind: [[0.5] * size for _ in range(size)] for kind in (True, False)}
    for kind, pair, n in pairs.where("pair is not null").groupBy("random", "pair").count().collect():
        counts[kind][pair // size][pair % size] += n
    out = []
    for first in range(size):
        sums = {kind: sum(counts[kind][first][1:]) for kind in counts}
        out += [0.0] + [math.log(counts[True][first][c] / sums[True]) - math.log(counts[False][first][c] / sums[False]) for c in range(1, size)]
    return out


def _pairs(string: Column) -> Column:
    """Numbers of a string's character pairs, the first from the start; null where a character is foreign."""
    size = len(ALPHABET) + 1

    def numbers(chars):
        def code(c):
            place = F.instr(F.lit(ALPHABET), c)
            return F.when(place > 0, place)
        return F.transform(chars, lambda c, i: F.when(i == 0, code(c)).otherwise(size * code(F.get(chars, i - 1)) + code(c)))
    return let(F.split(string, ""), numbers)


def log_ratio(string: Column, model: Column) -> Column:
    """Sum of the log ratios of a string's character pairs."""
    return F.aggregate(_pairs(string), F.lit(0.0), lambda a, p: a + F.coalesce(F.get(model, p), F.lit(0.0)))


def random_spans(text: Column, ratios: list[float]) -> Column:
    """Runs of key characters that the models take for random strings."""
    model = F.from_json(F.lit(json.dumps(ratios)), "array<double>")

    def chosen(runs):
        return F.filter(runs, lambda s: log_ratio(F.substring(text, s["start"] + 1, s["end"] - s["start"]), model) > MIN_RATIO)
    return F.when(text.rlike(RUN), let(_spans(text, RUN, 3), chosen)).otherwise(F.array().cast(_SPAN))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def with_spans(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """``docs`` and ``_base`` (three arrays) and ``_spans``: all spans by start, then kind."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.withColumn("_text", text)
    df = df.withColumns({f"_{k}": v for k, v in base_spans(F.col("_text")).items()} | {"_random": random_spans(F.col("_text"), ratios)})
    df = df.withColumn("_base", F.sort_array(F.concat("_assign", "_access", "_hex")))

    def alone(s):
        return ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return df.withColumn("_spans", F.sort_array(F.concat("_base", F.filter("_random", alone))))


def scan(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """Counts and spans of every row; the models are trained on ``docs`` itself unless given."""
    ratios = train(labelled_strings(docs)) if ratios is None else ratios
    rows = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ratios)
    counts = [F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return rows.select("doc_id", *counts, F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"), _listed(F.col("_spans")).alias("spans"), (F.size("_spans") - F.size("_base")).cast("long").alias("n_random"))


def redact(docs: DataFrame, mark: str = "[secret]", ratios: list[float] | None = None) -> DataFrame:
    """The rows of ``docs`` with every span replaced by ``mark``; overlapping spans become one mark.

    All columns stay; ``n_chars``, where there is such a column, counts the new text. Null texts stay null.
    """
    ratios = train(labelled_strings(docs)) if ratios is None else ratios
    rows = with_spans(docs.select(F.struct(*docs.columns).alias("_rest"), F.col("text")), ratios)

    def add(state, s):
        between = F.substring(F.col("_text"), state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        fresh = F.when(s["start"] >= state["at"], F.concat(state["out"], between, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), fresh.alias("out"))
    begun = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("_spans", begun, add, lambda s: F.concat(s["out"], F.substring(F.col("_text"), s["at"] + 1, F.length("_text"))))
    text = F.when(F.size("_spans") > 0, clean).otherwise(F.col("_rest.text").cast("string"))
    rows = rows.select("_rest.*", text.alias("_clean"))
    return rows.select(*[{"text": F.col("_clean").alias("text"), "n_chars": F.length("_clean").cast(t).alias("n_chars")}.get(c, F.col(c)) for c, t in docs.dtypes])
