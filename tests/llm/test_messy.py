"""Every operator over tables with nulls, empty, long, equal and repeated rows, and over an empty table."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm import (imatch, language_id, lm_scoring, minhash_dedup, piece_lattice, quality_rules, resharding,
                            retrieval_packing, secret_scan, substring_dedup)

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
OPERATORS = {
    "packing": lambda d: retrieval_packing.pack(d, WORDS),
    "pieces": lambda d: piece_lattice.encoded(d, PIECES),
    "quality": quality_rules.quality,
    "near": minhash_dedup.near_duplicates,
    "repeats": substring_dedup.removal_report,
    "language": language_id.identify,
    "shards": resharding.layout,
    "secrets": secret_scan.scan,
    "fingerprints": imatch.fingerprints,
    "scores": lm_scoring.score,
}
KEEPING = {"quality": quality_rules.kept_documents, "near": minhash_dedup.drop_near_duplicates, "repeats": substring_dedup.without_repeats, "secrets": secret_scan.redact}


@pytest.fixture(scope="module", params=list(OPERATORS))
def result(request, messy):
    return request.param, OPERATORS[request.param](messy).collect()


def test_messy_rows(messy, result):
    name, rows = result
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert set(by_id) == {None, *range(1, 14)}
    if name != "packing":  # which returns pieces
        assert len(rows) == messy.count() and len(by_id[4]) == 3 and len(by_id[None]) == 3
    first = {i: r[0] for i, r in by_id.items()}
    if name == "packing":
        assert {(r.length, r.doc_tokens) for r in by_id[2]} == {(1, 1)} and sum(r.length for r in by_id[5]) == by_id[5][0].doc_tokens > 4096
    elif name == "pieces":
        assert (first[1].n_pieces, first[2].n_pieces, list(first[2].scores)) == (0, 0, [0.0]) and all(r.round_trip for r in rows)
    elif name == "quality":
        assert (first[1].n_words, first[3].n_words, first[3].kept) == (0, 0, False)
    elif name == "near":
        assert first[1].n_shingles == 0 and first[1].component_id == 1 and first[2].kept and first[6].kept
        assert (first[7].component_id, first[7].kept) == (6, False) and {r.component_id for r in by_id[4]} == {4}
        assert sorted((r.n_shingles, r.component_id, r.kept) for r in by_id[None])[-1][1:] == (6, False)
    elif name == "repeats":
        assert first[1].n_bytes == 0 and first[7].n_removed == first[7].n_bytes > 0 and first[10].n_spans == 1
        assert first[9].n_bytes == 6000 and first[9].n_removed == 6000 - 2  # the windows at 0 and 1 are new, all others repeat
    elif name == "language":
        assert all((first[i].lang_pred, first[i].score) == ("und", 0.0) for i in (1, 2, 3, 12)) and first[6].lang_pred in ("en", "de", "fr")
    elif name == "shards":
        for shard in range(24):
            slots = sorted(r.slot for r in rows if r["shard"] == shard)
            assert slots == list(range(len(slots)))
        assert first[1]["size"] == 8 and all(r.grown_shard is None for r in rows)
    elif name == "secrets":
        assert first[11].n_assign == 1 and first[1].spans == "" and first[11].spans.startswith("assign:0:")
    elif name == "fingerprints":
        assert first[6].fingerprint == first[7].fingerprint and first[1].n_chars == 0
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    elif name == "scores":
        assert first[1].n_tokens == first[2].n_tokens == 1 and all(r.score <= 0 and r.base_score < 0 for r in rows)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(empty, name):
    df = OPERATORS[name](empty)
    assert df.collect() == []


@pytest.mark.parametrize("name", list(KEEPING))
def test_stages_keep_the_columns(messy, empty, name):
    out = KEEPING[name](messy)
    assert out.dtypes == messy.dtypes and out.count() <= messy.count()
    assert out.agg(F.min("_row"), F.max("spans")).first() in [("a", "d"), (None, None)]
    assert KEEPING[name](empty).collect() == []


def test_pipeline_over_messy_rows(spark, messy, tmp_path):
    at = str(tmp_path)
    messy.write.parquet(f"{at}/documents.parquet")
    pieces = corpus_pipeline.run(spark, at).collect()
    # an exact copy and the upper-case text are gone; document 6 stays
    assert {r.doc_id for r in pieces} & {6, 7} <= {6}
