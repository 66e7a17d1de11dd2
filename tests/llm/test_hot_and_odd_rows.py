"""Repeated ids, rare labels, crafted texts and clashing names."""

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import plain
from tests.llm.conftest import SCHEMA, odd_rows
from tripstrata.llm import language, secrets
from tripstrata.llm import words as W
from tripstrata.llm.decontaminate import drop_contaminated
from tripstrata.llm.near_duplicates import keep_one_of_each
from tripstrata.llm.private import free_name
from tripstrata.llm.repetition import repetition_rules

TWO = "doc_id long, text string"


def thue_morse(n, letters="ab"):
    return "".join(letters[k.bit_count() % 2] for k in range(n))


def test_rows_of_one_id_are_told_apart(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [
        (1, base), (9, base + " more"), (9, "a clean and quite unrelated text of its own"), (None, base.upper()),
        (None, "nobody knows whose words these are"), (None, "nobody knows whose words these are"),
        (5, None), (5, ""), (None, ""), (None, " "), (7, "twice the same row here"), (7, "twice the same row here"),
    ]
    kept = [tuple(r) for r in keep_one_of_each(spark.createDataFrame(rows, TWO)).collect()]
    words = sorted((r for r in kept if plain.words(r[1])), key=str)
    assert words == sorted(
        [rows[0], rows[2], rows[4], rows[10]], key=str
    )
    assert sorted(str(r[0]) for r in kept if not plain.words(r[1])) == ["5", "None"]


@pytest.mark.parametrize("size", [1024, 4096])
def test_crafted_words_and_lines(spark, size):
    one, two = thue_morse(size), thue_morse(size, "ba")
    h = W.hashes(W.split(pa.array([f"{one} {two} {one.upper()}"], pa.large_string())), fold=True)
    assert h[0] == h[2] != h[1]
    rows = [(1, f"{one}\n{two}\n{one}"), (2, f"{one}\n{two}"), (3, f"x {one}\nx {two}\n"), (4, f"{two}\n{two}\nb\nb")]
    found = {r.doc_id: r for r in repetition_rules(spark.createDataFrame(rows, TWO)).collect()}
    for doc_id, text in rows:
        assert (found[doc_id].n_words, found[doc_id].n_dup_lines) == (len(text.split()), plain.repetition(text)[3])


def test_shares_at_any_size():
    for total in (1, 1000, 45_000, 6 * 10**9, 10**11, 10**15):
        quota, share = language.shares({"a": total, "b": 1, "c": 5})
        assert quota == language.SAMPLE // 3
        assert share["b"] == share["c"] == 1.0
        drawn = share["a"] * total
        assert drawn >= min(total, 4 * quota) and drawn <= 4 * quota + 65
        assert share["a"] * 2.0**63 >= 1
    quota, share = language.shares({str(k): 10**9 for k in range(20_000)})
    assert quota == 1 and min(share.values()) * 10**9 > 60


def language_rows(n, ids):
    texts = {"en": "the house and the garden of the world", "de": "das haus und der garten der welt"}
    rows = [(ids(k), texts[lang] + f" {k}", lang) for k in range(n) for lang in [("en", "de")[k % 2]]]
    polish = [(ids(n + k), f"zażółć gęślą jaźń szczęście ośmiu {k}", "pl") for k in range(5)]
    return [*rows, *polish]


@pytest.mark.parametrize("ids", ["distinct", "none", "one"])
def test_rare_languages_are_learned(spark, ids):
    of = {"distinct": lambda k: 4 * k, "none": lambda k: None, "one": lambda k: 1}[ids]
    rows = language_rows(45_000, of)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    train = df.where("lang IS NOT NULL")
    sample = language._sampled(train).groupBy("lang").count().collect()
    counts = {r["lang"]: r["count"] for r in sample}
    assert counts == {"en": 2000, "de": 2000, "pl": 5}
    odd = spark.createDataFrame(rows[-5:] + rows[:50], df.schema)
    model = language.predict_language(df.unionByName(odd))
    found = {r.lang_pred for r in model.collect()}
    assert found == {"en", "de", "pl"}


def test_names_that_operators_use_may_be_taken(spark, clashing_docs):
    names = clashing_docs.columns
    assert free_name(clashing_docs, "OWN_text") == "OWN_text_" and free_name(clashing_docs, "x") == "x"
    benchmark = spark.createDataFrame([(1, "an item of more than twenty four letters")], "item_id long, text string")
    for out in (
        repetition_rules(clashing_docs),
        drop_contaminated(clashing_docs, benchmark),
        secrets.find_secrets(clashing_docs),
        keep_one_of_each(clashing_docs),
    ):
        assert set(names) <= set(out.columns)
        values = {r["__named"] for r in out.select("__named").collect()}
        assert values == {names.index("__named") - len(SCHEMA.split(","))}
        assert 0 < out.count() <= len(odd_rows())


def test_hashes_of_words_do_not_depend_on_their_place():
    texts = ["a " + "q" * 65 + " B", "Q" * 65 + " b " + "q" * 64, "q" * 64 + "é"]
    words = W.split(pa.array(texts, pa.large_string()))
    h = W.hashes(words, fold=True)
    assert h[1] == h[3] and h[2] == h[4] and len(set(h.tolist())) == 5
    assert np.array_equal(W.hashes(words, fold=False)[[0, 5]], h[[0, 5]])
