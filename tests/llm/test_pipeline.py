"""The stages of the pipeline on awkward tables, and the whole of it against a plain version."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import language, minhash, pii, quality
from tests.llm.test_texts import DOCS, ODD, best_fit, edited, plain_components, plain_set, sentence

STAGES = dict(corpus_pipeline.STAGES)
LONG = "deux mots " * 60_000


def good(rng, lang, n=3):
    return ".\n".join(sentence(rng, lang, 12).capitalize() for _ in range(n)) + "."


def bad(rng, lang):
    return "\n".join("!!".join(w.upper() for w in sentence(rng, lang, 8).split()) + "$$" for _ in range(3))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Rows of documents and a folder with labels."""
    rng = random.Random(12)
    rows = []
    for i in range(240):
        lang = rng.choice(["en", "fr", "de"])
        rows.append((i, bad(rng, lang) if i % 4 == 0 else good(rng, lang), lang, f"s{i % 3}", 1))
    for i in range(20):
        text = rows[i * 4 + 1][1].split()
        rows.append((300 + i, edited(rng, text, rng.randint(0, 1)), "en", "s", None))
    rows += [(400, "write to ann.b@mail.example.org or +1 415 555 0100 " + good(rng, "en"), "en", "s", 5), (401, good(rng, "de") + " 4111 1111 1111 1111", "de", None, None)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows, folder


def awkward(rows):
    """Nulls in every column, odd and long texts, rows that repeat."""
    more = [(500 + i, t, "en", "s", 1) for i, t in enumerate(ODD)] + [(None, rows[5][1], None, None, None), (7, None, None, None, None), (600, LONG, "fr", "s", None)]
    return rows + more + [rows[1]] * 3 + [(None, None, None, None, None)] * 2


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_on_awkward_tables(spark, corpus, name):
    rows, folder = corpus
    docs = spark.createDataFrame(awkward(rows), DOCS)
    wide = docs
    for c in ("score", "predicted", "lang_pred", "text_key", "root", "kept", "of_text", "row", "piece", "length", "bucket", "digest", "spans"):
        wide = wide.withColumn(c, F.lit("x"))
    stage = STAGES[name]
    empty = stage(spark, docs.limit(0), folder)
    assert empty.count() == 0
    out, plain = stage(spark, wide, folder), stage(spark, docs.repartition(3), folder)
    if name == "packing":
        assert out.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        assert out.where("piece = 0").count() == docs.count() and out.where("doc_id = 500 and length = 1").count() == 1
        return
    assert out.columns == empty.columns == corpus_pipeline.COLUMNS
    found = sorted(map(str, out.collect()))
    assert found == sorted(map(str, plain.collect())) and found
    if name == "pii":
        assert len(found) == docs.count() and out.where("text is null").count() == docs.where("text is null").count()
        assert out.where("text like '%ann.b@%' or text like '%4111 1111%'").count() == 0 and out.where("text like '%[EMAIL]%'").count() == 1
    elif name == "near_dedup":
        assert len(set(found)) == len(found) and out.where("doc_id = 600").count() == 1
        assert out.where("text is null").count() == docs.where("text is null").select("doc_id").distinct().count()
    elif name == "language":
        assert out.where("text is null or not text rlike '[a-zA-Zéè]'").count() == 0 and out.where("doc_id < 240").count() >= 236
    else:
        kept = {r.doc_id for r in out.where("doc_id < 240").collect()}
        assert np.mean([(i in kept) == (i % 4 != 0) for i in range(240)]) > 0.95


def test_stages_without_labels(spark, corpus, tmp_path):
    rows, _ = corpus
    docs = spark.createDataFrame(rows[:20], DOCS)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).count() == 20


def test_pipeline_equals_a_plain_version(spark, corpus):
    rows, folder = corpus
    spark.createDataFrame(rows, DOCS).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    table = lambda rows: spark.createDataFrame(rows, DOCS)
    # the models by the same calls, what they decide by plain loops
    model = quality.learn(table(rows), spark.read.parquet(f"{folder}/labels.parquet"))
    left = [r for r, s in zip(rows, quality.score_texts(model, [r[1] for r in rows]), strict=True) if s >= 0.5]
    assert 0 < len(left) < len(rows)
    model = language.learn(table(left))
    shares = language.Predictor(model).documents([r[1].encode() for r in left])[:, : len(model.languages)].max(1)
    left = [r for r, s in zip(left, shares, strict=True) if s >= corpus_pipeline.least_score(len(model.languages))]
    left.sort()
    component = plain_components([plain_set(r[1]) for r in left], 80)
    least = [r for k, r in enumerate(left) if component[k] == k]
    assert len(least) < len(left)
    w = pii.weights()
    clean = {r[0]: pii.redacted(r[1], pii.all_spans(r[1], w)[1]) for r in least}
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    sizes = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in clean.items()}
    found = corpus_pipeline.run(spark, folder).collect()
    assert {i: sum(r.length for r in found if r.doc_id == i) for i in {r.doc_id for r in found}} == sizes
    assert len({r.sequence_id for r in found}) == best_fit(list(sizes.values()), 2048)
    assert minhash.PERCENT == 85 and corpus_pipeline.SIMILAR == 80
