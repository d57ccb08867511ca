"""The pipeline, stage by stage, on the smallest tables and on odd rows."""

from collections import Counter

import pytest

import corpus_pipeline as C
from odoscore.llm import secrets, simhash
from odoscore.llm.common import read, stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = read(spark, SF, "documents"), []
    for name, stage in C.STAGES:
        out.append((name, docs, stage(spark, docs, SF)))
        docs = stored(out[-1][2])
        out[-1] = (*out[-1][:2], docs)
    return {name: (before, after) for name, before, after in out}


def test_stages_keep_the_columns(outputs):
    assert list(outputs) == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]
    for name, (before, after) in outputs.items():
        assert name == "packing" or after.schema == before.schema


def test_toxicity_keeps_what_it_does_not_reject(outputs):
    before, after = (set(map(tuple, df.collect())) for df in outputs["toxicity"])
    assert after <= before and len(after) > 0.7 * len(before)


def test_one_document_of_each_group(outputs):
    before, after = (df.toPandas() for df in outputs["near_duplicates"])
    prints = {i: simhash.fingerprint(t) for i, t in zip(before.doc_id, before.text)}
    group = {i: i for i in prints}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((top(i), top(j)))
                group[b] = a
    assert sorted(after.doc_id) == sorted({top(i) for i in ids})


def test_secrets_are_gone_and_nothing_else(outputs):
    before, after = (df.toPandas().set_index("doc_id") for df in outputs["secrets"])
    assert sorted(before.index) == sorted(after.index)
    for i, text in before.text.items():
        assert after.text[i] == secrets.redact(text, secrets.scan(text).spans)


def test_mix_takes_words_of_its_documents(outputs):
    before, after = (df.toPandas() for df in outputs["mixing"])
    whole = dict(zip(before.doc_id, before.text))
    assert all(whole[i].startswith(t) or whole[i].strip() == t for i, t in zip(after.doc_id, after.text))
    words = lambda df: sum(len(t.split()) for t in df.text)
    assert abs(words(after) - words(before)) <= len(set(before.source))


def test_packing_loses_no_word(outputs):
    before, after = (df.toPandas() for df in outputs["packing"])
    count = lambda df: Counter(w for t in df.text for w in t.split())
    assert count(before) == count(after)


def test_odd_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, spans string, taken int, size int"
    rows = [
        (1, "a b token: abcdefghij", None, None, 9, "k", "s", 5, 6), (1, "a b token: abcdefghij", None, None, 9, "k", "s", 5, 6), (None, None, None, None, None, None, None, None, None),
        (2, "", "en", "src", 0, "k", "s", 1, 1), (3, "word " * 5000, "en", "src", 25_000, "k", "s", 1, 1),
    ]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for n, data in enumerate((rows, [])):
        folder = f"{tmp_path}/{n}"
        labels.write.parquet(f"{folder}/labels.parquet")
        docs = spark.createDataFrame(data, schema)
        docs.write.parquet(f"{folder}/documents.parquet")
        docs = read(spark, folder, "documents")
        for name, stage in C.STAGES:
            after = stored(stage(spark, docs, folder))
            assert name == "packing" or after.columns == docs.columns
            docs = after
        assert docs.count() >= (3 if data else 0) and (data or docs.count() == 0)


def test_run(spark):
    assert C.run(spark, SF).count() > 0 and C.ORACLE_SQL is None
