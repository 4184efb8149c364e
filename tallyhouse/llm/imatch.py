"""Document fingerprints by I-Match over randomised lexicons.

Terms are lower-cased words. Terms whose document frequency lies in a band form the lexicon:
neither so common that they say nothing nor so rare that they are noise. A text's distinct
lexicon terms are sorted and hashed, once for every subset of the lexicon; a subset takes each
term by a hash, with probability 1, 1/8, 1/64, 1/256 or 1/1024, so that texts of every length
have subsets that hold only a few of their terms and survive an edit elsewhere.

Frequencies are counted over all distinct texts, by hashed term, so exact copies count once. The table of buckets has a fixed
size whatever the vocabulary, and the band a lower end that is a share of the documents:
rare terms that fall into one bucket add up to (rare terms of a mean document) / buckets of
the documents, some thousandths of a percent, at any number of documents. The lexicon is
therefore a bit map of constant size, a constant of the plan; nothing is joined.

Defined results: null text counts as empty. A text with fewer than one lexicon term in ``FEW``
of its terms, as in a large group of near copies whose shared terms are all too common, takes
the same subsets of all of its terms instead. The likeness at one
probability is the share of equal hashes among the subsets that at least one of two texts has
terms in; the likeness of two texts is the largest of these, and 1 if there are none. Rows with equal or null ids are ordered by text, null ids first. A single
row is its own next document. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept_table, keyed, text_bytes
from tallyhouse.llm.quality_rules import SPACE_RUN, let

BUCKETS = 1 << 18
LEAST_SHARE, MOST_SHARE = 0.002, 0.2  # document frequency of lexicon terms
FEW = 8  # texts with a smaller share of lexicon terms hash all of their terms
SCALES = {1: 1, 8: 3, 64: 8, 256: 12, 1024: 12}  # one in so many terms: number of such subsets
SUBSETS = [every for every, number in SCALES.items() for _ in range(number)]
BLOCK_BYTES = 32 << 20
QUANTILES = 256


def _terms(text: Column) -> Column:
    """Sorted distinct buckets of the terms of a text."""
    words = F.array_remove(F.split(F.lower(text), SPACE_RUN), "")
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))))


def lexicon(docs: DataFrame) -> bytes:
    """Bit map, seven bits a byte, of the buckets whose document frequency lies in the band."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("_name", F.xxhash64("text"))
    copies = kept_table(texts.groupBy("_name").agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1"))  # narrow; broadcast where it is small
    total = docs.count() - (copies.agg(F.sum(F.col("_copies") - 1)).first()[0] or 0)
    share = 1 / F.coalesce("_copies", F.lit(1))
    terms = texts.join(copies, "_name", "left").select(share.alias("_share"), F.explode(_terms(F.col("text"))).alias("bucket"))
    frequency = terms.groupBy("bucket").agg(F.round(F.sum("_share")).alias("count"))
    chosen = frequency.where((F.col("count") >= LEAST_SHARE * total) & (F.col("count") <= MOST_SHARE * total) & (F.col("count") > 1))
    bits = bytearray(BUCKETS // 7 + 1)
    for (bucket,) in chosen.select("bucket").collect():
        bits[bucket // 7] |= 1 << bucket % 7
    return bytes(bits)


def fingerprint(text: Column, bits: bytes) -> Column:
    """Hashes of a text's terms in every subset, as hexadecimal text; ``-`` where it has none."""
    table = F.lit(bits)

    def listed(b):
        byte = F.ascii(F.substring(table, F.floor(b / 7).cast("int") + 1, F.lit(1)).cast("string"))
        return F.getbit(byte, b % 7) == 1

    def subset(terms, k, every):
        if every == 1:
            return terms
        return F.filter(terms, lambda b: F.pmod(F.xxhash64(b, F.lit(k)), F.lit(every)) == 0)

    def hashed(terms):
        return F.when(F.size(terms) == 0, F.lit("-")).otherwise(F.lower(F.lpad(F.hex(F.xxhash64(terms).bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")))

    def of(found):
        def hashes(terms):
            return F.array(*[let(subset(terms, k, every), hashed) for k, every in enumerate(SUBSETS)])
        enough = let(F.filter(found, listed), lambda terms: F.when(F.size(terms) * FEW < F.size(found), found).otherwise(terms))
        return let(enough, hashes)
    return F.array_join(let(_terms(text), of), ".")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes of two fingerprints at the scale where it is largest."""
    def share(found):
        return F.when(F.size(found) > 0, F.size(F.filter(found, lambda p: p["a"] == p["b"])) / F.size(found))

    def largest(pairs):
        out, first = [], 1
        for number in SCALES.values():
            out.append(let(F.filter(F.slice(pairs, first, number), lambda p: (p["a"] != "-") | (p["b"] != "-")), share))
            first += number
        return F.coalesce(F.greatest(*out), F.lit(1.0))
    return let(F.arrays_zip(F.split(a, "[.]").alias("a"), F.split(b, "[.]").alias("b")), largest)


def with_next(rows: DataFrame, carried: str, inside_only: str) -> DataFrame:
    """Keyed ``rows`` with ``next_<c>`` of the next row by ``_row``; the last one's is the first.

    ``inside_only`` is left null for the last row of a block. Rows are cut into blocks of ids by quantiles and, within those, by equal widths, so that
    no task sorts all rows. Only the first row of each block crosses a border.
    """
    blocks = max(1, -(-text_bytes(rows) // BLOCK_BYTES))
    cuts = min(blocks, QUANTILES)
    edges = rows.agg(F.percentile_approx("_row", [i / cuts for i in range(1, cuts)] or [0.5], 10000)).first()[0] or [0]
    edges = sorted(set(edges if blocks > 1 else []))
    least, most = rows.agg(F.min("_row"), F.max("_row")).first()
    bounds = [least or 0, *(e for e in edges if (least or 0) < e), (most or 0) + 1]
    at = F.size(F.filter(F.lit(bounds), lambda e: e <= F.col("_row"))) - 1
    inner = -(-blocks // max(1, len(bounds) - 1))
    low, high = F.get(F.lit(bounds), F.col("_cut")), F.get(F.lit(bounds), F.col("_cut") + 1)
    part = F.floor((F.col("_row") - low) / (high - low) * inner)
    rows = rows.withColumn("_cut", at).withColumn("_block", F.col("_cut").cast("long") * inner + part)
    window = Window.partitionBy("_block").orderBy("_row")
    inside = rows.withColumns({f"next_{c}": F.lead(c).over(window) for c in (carried, inside_only)} | {"_last": F.lead("_row").over(window).isNull()})
    firsts = rows.groupBy("_block").agg(F.min_by(carried, "_row").alias("_first"))
    order = Window.orderBy("_block")  # one number a block
    numbers = rows.select("_block").distinct()
    after = numbers.select(F.col("_block").alias("_before"), F.lead("_block").over(order).alias("_block"))
    after = after.select("_before", F.coalesce("_block", F.min("_before").over(Window.partitionBy())).alias("_block"))
    firsts = firsts.join(after, "_block").drop("_block").withColumnRenamed("_before", "_block").withColumn("_last", F.lit(True))
    joined = inside.join(firsts, ["_block", "_last"], "left")
    return joined.select(*[c for c in rows.columns if c not in ("_cut", "_block")], F.when(F.col("_last"), F.col("_first")).otherwise(F.col(f"next_{carried}")).alias(f"next_{carried}"), f"next_{inside_only}")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every row and of its edited text, and their likeness."""
    bits = lexicon(docs)
    rows = keyed(docs).withColumn("text", F.coalesce("text", F.lit("")))
    rows = with_next(rows.withColumn("fingerprint", fingerprint(F.col("text"), bits)), "text", "fingerprint")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    following = F.coalesce("next_fingerprint", fingerprint(F.col("next_text"), bits))
    rows = rows.withColumns({"edited_fingerprint": fingerprint(F.col("edited"), bits), "following": following})
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("following")).alias("near_next"))
