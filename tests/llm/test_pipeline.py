"""Each pipeline stage against its brute-force version, on the rows its
predecessor kept."""

import collections
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from turnfold.llm import langid, mixing
from turnfold.llm.frames import written
from turnfold.llm.idtokens import Encoder, tokenizer_path

from .conftest import SF
from .test_dedup import brute_classes
from .test_secrets_mixing import base_spans, check_mix
from .test_tokens import check_packing, plain_ids


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(1).select((F.lit(10_000) + F.col("doc_id")).alias("doc_id"), F.lit("123 456 !!").alias("text"),
                                 "lang", "source", "n_chars")
    # a text of its own, with a secret in it
    backwards = F.concat_ws(" ", F.reverse(F.split("text", " ")))
    secret = docs.where("length(text) > 800").orderBy("doc_id").limit(3).select(
        (F.lit(20_000) + F.col("doc_id")).alias("doc_id"),
        F.concat(backwards, F.lit(' token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" end')).alias("text"),
        "lang", "source", "n_chars")
    out = [docs.union(extra).union(secret)]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_columns(outputs):
    for frame in outputs[1:-1]:
        assert frame.columns == outputs[0].columns


def test_language_stage_drops_unknown_only(outputs):
    judged = langid.identify(outputs[0]).collect()
    stay = {r["doc_id"] for r in judged if r["lang_pred"] != "und" and not r["ambiguous"]}
    kept = {r["doc_id"] for r in outputs[1].collect()}
    assert kept == stay and 10_000 not in kept and len(kept) >= 0.98 * (outputs[0].count() - 4)


def test_duplicates_stage(outputs):
    rows = [(r["doc_id"], r["text"]) for r in outputs[1].collect()]
    assert {r["doc_id"] for r in outputs[2].collect()} == {c for _, _, c in brute_classes(rows, 5, 80)}


def test_secrets_stage(outputs):
    before = {r["doc_id"]: r for r in outputs[2].collect()}
    after = {r["doc_id"]: r for r in outputs[3].collect()}
    assert set(before) == set(after)
    changed = 0
    for key, old in before.items():
        new, spans = after[key], base_spans(old["text"])
        for start, _, _, end in spans:
            assert old["text"][start:end] not in new["text"]
        if not spans and "[secret]" not in new["text"]:
            assert new == old
        if spans:
            changed += 1
            assert new["n_chars"] == len(new["text"])
            want, at = "", 0
            for start, _, _, end in spans:
                want += old["text"][at:start] + "[secret]" if start >= at else ""
                at = max(at, end)
            assert re.sub(re.escape("[secret]"), "", want + old["text"][at:])[:200] == re.sub(
                re.escape("[secret]"), "", new["text"])[:200]
    assert changed > 0


def test_mixing_stage(outputs):
    counts = mixing.copy_counts(outputs[3]).collect()
    check_mix(counts, outputs[3].collect())
    got = collections.Counter(r["doc_id"] for r in outputs[4].collect())
    assert got == {r["doc_id"]: r["copies"] for r in counts if r["copies"]}


def test_packing_stage(outputs):
    encoder = Encoder(tokenizer_path())
    rows = outputs[4].collect()
    ids_of = {}
    for r, ids in zip(rows, plain_ids(encoder, [r["text"] for r in rows], 1), strict=True):
        ids_of.setdefault(r["doc_id"], []).append(ids)
    check_packing(outputs[5].collect(), ids_of)
    assert set(ids_of) == {r["doc_id"] for r in outputs[5].select("doc_id").distinct().collect()}


def test_stages_of_odd_rows(spark, odd_rows, no_rows):
    for docs in (odd_rows, no_rows):
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF), f"odd-{name}")
        assert docs.count() >= 0


def test_one_row_of_each_class_stays_whatever_its_id(spark):
    copy, near = "one two three four five six seven eight nine ten", "one two three four five six seven eight nine ten "
    other = "an altogether different text of some more words than that"
    rows = [(1, copy), (1, copy), (None, copy), (None, copy), (3, near), (None, other), (None, other), (5, None), (5, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect())
    assert got == collections.Counter([(1, copy), (None, other), (5, None), (5, None), (None, "")])
