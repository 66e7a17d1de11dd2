"""Texts encoded and blocks read many at a time: the same ids, with few calls."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import odd_rows
from tripstrata.llm import token_blocks
from tripstrata.llm.subword import Subwords

PARTS = (
    "a word Word naïve , . !! 's don't 123 <|endoftext|> <|end |> é ß 日本 😀 \x00 _ ' \" [CLS]".split(" ")
    + [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x0c", "x" * 70]
)
ODD = ["　", "\xa0", "\x85", "\x1c", " ", "​", "﻿"]


def odd_texts():
    draw = random.Random(2)
    texts = [t or "" for _, t, *_ in odd_rows()]
    for k in range(600):
        texts.append("".join(draw.choices(PARTS + ODD * (k % 3 == 0), k=draw.choice([0, 1, 2, 3, 8, 30]))))
    return texts


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("limit", [1, 300, 1_000_000])
def test_ids_of_many_texts_equal_the_library(name, limit):
    path, texts = public_tokenizers.path(name), odd_texts()
    library, words = Tokenizer.from_file(path), Subwords(path, limit)
    whole = pa.array(texts, pa.large_string())
    for a in range(0, len(texts), 100):
        ids, lengths = words.encode_array(whole.slice(a, 100))
        expected = [library.encode(t, add_special_tokens=False).ids for t in texts[a : a + 100]]
        assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == expected
    empty = words.encode_array(pa.array(["", ""], pa.large_string()))
    assert [x.tolist() for x in empty] == [[], [0, 0]]


class Counted:
    def __init__(self, wrapped):
        self._wrapped, self.calls = wrapped, 0

    def __getattr__(self, name):
        found = getattr(self._wrapped, name)
        if name not in ("encode", "encode_batch_fast", "tokenize"):
            return found

        def counting(*args, **kwargs):
            self.calls += 1
            return found(*args, **kwargs)

        return counting


def test_new_words_are_encoded_together_and_once():
    words = Subwords(public_tokenizers.path("byte_bpe_50k.json"))
    words.library, words._model = Counted(words.library), Counted(words._model)
    texts = pa.array([f"Text {' '.join(f'w{k}' for k in range(5000))}"] * 20, pa.large_string())
    first = words.encode_array(texts)
    calls = words.library.calls + words._model.calls
    assert calls < 20
    again = words.encode_array(texts)
    assert words.library.calls + words._model.calls == calls
    assert np.array_equal(first[0], again[0]) and np.array_equal(first[1], again[1])


def test_blocks_of_a_stretch_are_unpacked_together(tmp_path, monkeypatch):
    draw = np.random.default_rng(4)
    ids = np.concatenate([draw.integers(0, top, 512 * 30) for top in (1, 50, 50_000, 2**32)] + [np.arange(77)])
    ids[draw.random(len(ids)) < 0.03] = 2**32 - 1
    writer = token_blocks.Writer(str(tmp_path / "x.pfor"))
    writer.add(np.array([1]), np.array([len(ids)]), ids)
    writer.close()
    calls, unpackbits = [], np.unpackbits
    monkeypatch.setattr(np, "unpackbits", lambda *a, **k: calls.append(1) or unpackbits(*a, **k))
    found = token_blocks.Reader(str(tmp_path / "x.pfor")).ids(0, len(ids))
    assert found.tolist() == ids.tolist()
    assert len(calls) < 30


def test_blocks_do_not_depend_on_the_type_of_the_ids():
    draw = np.random.default_rng(6)
    for size in (1, 511, 513, 3000):
        ids = draw.integers(0, 40, size)
        ids[draw.random(size) < 0.05] = 50_256
        assert len({b"".join(token_blocks.pack(ids.astype(t))) for t in ("<u2", "<u4", "<i8")}) == 1


def test_an_end_above_the_vocabulary_and_texts_without_ids(spark, tmp_path):
    rows = [(1, "one two"), (2, None), (3, ""), (4, "  ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    manifest = token_blocks.write_token_files(df, public_tokenizers.path("byte_bpe_50k.json"), 70_000, f"file://{tmp_path}/t")
    found = []
    for row in manifest.orderBy("first_doc").collect():
        found += [ids.tolist()[-1] for _, _, ids in token_blocks.Reader(row.path).documents()]
    assert found == [70_000] * 4
    sizes = [r.n_tokens for r in token_blocks.read_token_files(manifest).orderBy("doc_id").collect()]
    assert sizes[1:3] == [1, 1] and min(sizes[0], sizes[3]) > 1
