"""The pipeline against a plain version of its stages."""

import hashlib
import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import plain
from tests.llm.conftest import SCHEMA, SF, odd_rows


def stored(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


def expected(rows, items):
    kept = []
    for doc_id, text in rows:
        n, _, _, _, repeated, covered, longest = plain.repetition(text)
        if n >= 50 and 100 * repeated <= 50 * n and covered <= 0.4 * n and longest <= 400:
            kept.append((doc_id, text))
    named = [r for r in kept if r[0] is not None]
    first = {i: low for i, _, low in plain.components(named)}
    kept = [r for r in kept if r[0] is None or first[r[0]] == r[0]]
    passages = [x for x in map(plain.normal, items) if len(x) >= 24]
    kept = [r for r in kept if not any(x in plain.normal(r[1]) for x in passages)]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = {}
    for doc_id, text in kept:
        clean, at = "", 0
        for start, _, end in plain.secrets(text):
            if start >= at:
                clean += text[at:start] + "[SECRET]"
            at = max(at, end)
        ids = library.encode(clean + text[at:], add_special_tokens=False).ids
        out[doc_id] = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    return out


def test_pipeline_equals_its_plain_version(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(str(SF / "documents.parquet")).collect()]
    items = [r.text for r in spark.read.parquet(str(SF / "benchmark.parquet")).collect()]
    found = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, str(SF)).collect()}
    assert found == expected(rows, items) and len(found) > 100


def test_stages_keep_the_columns_and_bear_odd_tables(spark, tmp_path):
    secret = "password = hunter2hunter2 "
    extra = [(500, secret + " ".join(f"w{k}" for k in range(80)), "en", "s", 1)]
    docs = spark.createDataFrame([*odd_rows(), *extra], SCHEMA)
    stored(docs, tmp_path, "documents")
    stored(spark.createDataFrame([(1, None)], "item_id long, text string"), tmp_path, "benchmark")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "encoding":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), out.schema)
        if name == "secret_scan":
            row = docs.where("doc_id = 500").first()
            assert re.match(r"\[SECRET\] w0 ", row.text) and row.n_chars == len(row.text)
    empty = spark.createDataFrame([], SCHEMA)
    stored(empty, tmp_path / "none", "documents")
    stored(spark.createDataFrame([], "item_id long, text string"), tmp_path / "none", "benchmark")
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_the_registered_names():
    import __spark_entry__ as entry_points

    names = [n for n in entry_points.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_points.queries()
