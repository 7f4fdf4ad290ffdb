"""Every registered query of the document operators: against SQL where there is some, else against plain versions."""

import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from perigee.llm import pii, queries, winnowing
from tests.comparing import assert_same, duck
from tests.llm import brute
from tests.llm.test_passages import winnowed, without

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows_of(sf_dir, columns="doc_id, text"):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/documents.parquet'").fetchall()


def items_of(sf_dir):
    return [(str(i), t) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()]


@pytest.fixture(scope="module")
def docs():
    return rows_of(MEDIUM)


def result(spark, name, sf_dir=MEDIUM):
    return {r["doc_id"]: r for r in queries.queries()[name](spark, sf_dir).collect()}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert assert_same(queries.queries()[name](spark, MEDIUM), duck(MEDIUM), queries.SQL[name]) > 0


def test_each_number_has_one_query():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{n}" for n in range(1, 14)]


def test_quality_on_rows_held_out(spark):
    found = result(spark, "op4_quality")
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{MEDIUM}/labels.parquet'").fetchall())
    held = [i for i, r in found.items() if r["held_out"] and i in labels]
    assert len(found) == 1000 and all(r["held_out"] == (brute.fold(i, 3) == 1) for i, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    assert np.mean([found[i]["predicted"] == labels[i] for i in held]) >= 0.97


def test_language_on_rows_held_out(spark):
    found = result(spark, "op5_language")
    lang = dict(rows_of(MEDIUM, "doc_id, lang"))
    held = [i for i, r in found.items() if r["held_out"]]
    assert all(r["held_out"] == (brute.fold(i, 4) == 2) and 0 <= r["score"] <= 1 for i, r in found.items())
    assert np.mean([found[i]["lang_pred"] == lang[i] for i in held]) >= 0.99


def test_base_scores_and_gain_of_the_model(spark, docs):
    found, want = result(spark, "op6_hmm"), brute.op6_base(docs)
    for i, (n, known, total, base) in want.items():
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held)


def test_plain_spans(spark, docs):
    found = result(spark, "op7_pii")
    for i, text in docs:
        want = brute.op7(text)
        joined = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in want[k])
        r = found[i]
        assert tuple(r[f"n_{k}"] for k in pii.KINDS) == tuple(len(want[k]) for k in pii.KINDS)
        assert r["base_sha256"] == brute.sha256(joined) and r["spans"] == joined  # no disguises here


def test_rules(spark):
    found = result(spark, "op8_repetition", SMALL)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat")
    for i, text in rows_of(SMALL):
        assert tuple(found[i][n] for n in names) == brute.op8(text)
        assert (found[i]["base_failed"], found[i]["kept"]) == brute.op8_kept(text)


def test_rules_on_more_texts(spark, docs):
    """All but the longest texts, which the plain version takes too long for."""
    found, seen = result(spark, "op8_repetition"), set()
    for i, text in docs:
        if len(text or "") < 6000:
            failed, kept = brute.op8_kept(text)
            assert (found[i]["base_failed"], found[i]["kept"]) == (failed, kept)
            seen.add((failed, kept))
    assert seen == {(True, False), (False, True), (False, False)}


def test_components(spark, docs):
    found = result(spark, "op9_simhash")
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in found.items()} == brute.op9(docs)


def check_packing(pieces, texts):
    """Every id in one piece, sequences gapless and within their limit; returns the share of padding."""
    reference = Tokenizer.from_file(queries.TOKENIZER)
    ids = {i: [*reference.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts}
    covered, sequences = dict.fromkeys(ids, 0), {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        own = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert p["start"] == covered[p["doc_id"]] and p["doc_tokens"] == len(ids[p["doc_id"]])
        assert p["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        covered[p["doc_id"]] += p["length"]
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert covered == {i: len(v) for i, v in ids.items()}
    padding = total = 0
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048 and len(spans) <= 64
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / total


def test_packing_is_an_exact_round_trip(spark, docs):
    assert check_packing(queries.op10_packing(spark, MEDIUM).collect(), docs) < 0.005


def test_pipeline_equals_plain_stages(spark):
    """Stage by stage, on what each predecessor kept."""
    docs, sf_dir = spark.read.parquet(f"{SMALL}/documents.parquet"), SMALL
    stages = dict(corpus_pipeline.STAGES)
    names = docs.columns
    kept = [(i, t) for i, t in rows_of(SMALL) if brute.op8_kept(t)[1] and brute.few_symbols(t)]

    def equal(result, want):
        assert result.columns == names
        got = {r["doc_id"]: r for r in result.collect()}
        assert {i: r["text"] for i, r in got.items()} == dict(want)
        assert all(r["n_chars"] == len(r["text"]) for r in got.values())
        return result

    docs = equal(stages["quality_rules"](spark, docs, sf_dir), kept)
    units = winnowed(kept, winnowing.SENTENCES, winnowing.PASSAGE_BYTES)
    kept = [(i, without(t, units[i, t])) for i, t in kept]
    docs = equal(stages["line_dedup"](spark, docs, sf_dir), kept)
    found = brute.op9(kept)
    kept = [(i, t) for i, t in kept if found[i][1] == i]
    docs = equal(stages["near_dedup"](spark, docs, sf_dir), kept)
    items = items_of(SMALL)
    kept = [(i, c) for i, t in kept if (c := brute.without_items(t, items)) is not None]
    docs = equal(stages["decontamination"](spark, docs, sf_dir), kept)
    check_packing(stages["packing"](spark, docs, sf_dir).collect(), kept)
    check_packing(corpus_pipeline.run(spark, SMALL).collect(), kept)
