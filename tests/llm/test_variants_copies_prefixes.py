"""Spelling variants, SuperMinHash groups and the trie of conversations against plain versions."""

import random

import numpy as np
import pytest

from tests.llm import plain
from tests.llm.conftest import SCHEMA, SF, odd_rows
from tripstrata.llm import grouping, minhash, prefix_trie, spelling
from tripstrata.llm import words as W

TWO = "doc_id long, text string"
TURNS = "conv_id long, turn int, role string, text string"


def plain_rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def forms(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_forms(df).collect()}


def test_spelling_of_documents(docs):
    assert forms(docs) == plain.spelling(plain_rows(docs))


def variant_rows():
    """Words in chains of ever rarer variants, also in accented and very long forms."""
    rng = random.Random(3)
    words = []
    for base in ("streetlight", "größenwahn", "Ÿàéîõü", "x" * 90, "abcdef"):
        for n in (130, 26, 5):
            words += [base] * n
            at = rng.randrange(len(base))
            base = base[:at] + "q" + base[at + rng.choice((0, 1)) :]
    words += ["short"] * 50 + ["a×b÷cdé"] * 9 + ["fewer_than", "fïve"]
    rng.shuffle(words)
    rows = [(k, " ".join(words[k::40])) for k in range(40)]
    return [*rows, (None, "streetlight streetlights 12streetlight"), (3, None), (3, ""), (3, "größenwahn")]


def test_spelling_of_odd_words_in_small_tiles(spark, monkeypatch, docs):
    monkeypatch.setattr(spelling, "TILE", 3)
    odd = spark.createDataFrame(variant_rows(), TWO)
    found = forms(odd)
    assert found == plain.spelling(variant_rows())
    assert found["streetlight"][0] is None and any(x[1] == "streetlight" != x[0] for x in found.values() if x[0])
    assert forms(docs) == plain.spelling(plain_rows(docs))


def test_spelling_of_odd_tables(odd_docs, clashing_docs, no_docs):
    expected = plain.spelling((r[0], r[1]) for r in odd_rows())
    assert forms(odd_docs) == expected == forms(clashing_docs)
    assert forms(no_docs) == {}


def test_distances_keep_every_single_edit():
    words = ["abcdef", "abcxef", "abcdefg", "xabcdef", "abdcef", "abcdex", "qqqqqq"]
    found = set()
    for head in (True, False):
        pairs = spelling.near_pairs(words, 6, head, np.zeros(len(words)), True)
        found |= {tuple(sorted((words[i], words[j]))) for i, j in pairs}
    assert found == {
        ("abcdef", "abcxef"), ("abcdef", "abcdefg"), ("abcdef", "xabcdef"), ("abcdef", "abcdex"),
    }


def drawn(lanes):
    def draw(e, j):
        mixed = int(W.mix(np.array([(e + (j + 1) * minhash._STEP) & minhash._MASK], np.uint64))[0])
        return j + ((mixed >> 32) * (lanes - j) >> 32), (mixed & 0xFFFFFFFF) / 2**32

    return draw


def test_signatures_follow_the_definition():
    rng = np.random.default_rng(2)
    lanes = 32
    counts = np.array([0, 1, 2, 7, 300, 0, 40])
    elements = rng.integers(0, 2**64, counts.sum(), np.uint64)
    found = minhash.superminhash(elements, counts, lanes)
    ends = np.cumsum(counts)
    for row, end, n in zip(found, ends, counts, strict=True):
        least = plain.permutation_ranks([int(e) for e in elements[end - n : end]], lanes, drawn(lanes))
        if n:
            ranks = np.array([(int(x) << 32) | round((x % 1) * 2**32) for x in least], np.uint64)
            assert (W.mix(ranks) >> np.uint64(32)).astype(np.uint32).tolist() == row.tolist()


def test_equal_places_estimate_the_similarity():
    rng = np.random.default_rng(4)
    errors = []
    for k in range(100):
        x = rng.integers(0, 2**64, 300, np.uint64)
        a, b = minhash.superminhash(np.concatenate([x[:270], x[30:]]), np.array([270, 270]))
        errors.append((a == b).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.036


def copies(df, **options):
    rows = minhash.near_copies(df, **options).collect()
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows)


def expected_copies(rows):
    found = plain.components(rows, width=2)
    return sorted((i, n, low, i == low) for i, n, low in found)


def test_copies_of_documents(docs):
    assert copies(docs) == expected_copies(plain_rows(docs))


def family_rows():
    """Long near-threshold variants, some linked through others only, beside copies."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    rows = []
    for k in range(150):
        text = list(base)
        for at in rng.sample(range(400), rng.choice((5, 15, 22, 25, 28, 40))):
            text[at] = f"v{rng.randrange(9000)}"
        rows += [(3 * k + 1, " ".join(text)), (3 * k + 2, " ".join(text).upper())]
    return rows


@pytest.mark.parametrize("small", [True, False])
def test_copies_in_near_threshold_families(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(grouping, "TILE", 7)
        monkeypatch.setattr(grouping, "BLOCK_SETS", 11)
        monkeypatch.setattr(grouping, "BLOCK_ELEMENTS", 9000)
    rows = family_rows()
    found = copies(spark.createDataFrame(rows, TWO))
    assert found == expected_copies(rows)
    assert 1 < sum(x[3] for x in found) < 149


def test_rows_without_an_id_connect(spark):
    words = [f"w{k}" for k in range(200)]
    left, middle, right = ([*words[:k], *(f"x{j}" for j in range(k, k + 8)), *words[k + 8 :]] for k in (0, 90, 180))
    mid = [*words]
    rows = [
        (9, " ".join(left)), (5, " ".join(right)), (None, " ".join(mid)), (None, " ".join(mid)),
        (None, " ".join(middle)), (None, "quite another text here"), (None, None), (7, "own words only"),
        (7, "and other words of the same id"), (8, None),
    ]
    assert 100 * len(set(left) & set(right)) > 0
    found = minhash.near_copies(spark.createDataFrame(rows, TWO)).collect()
    linked = sorted((str(r.doc_id), r.component_id, r.kept) for r in found if r.n_shingles > 150)
    assert linked == [("5", 5, True), ("9", 5, False), *[("None", 5, False)] * 3]
    others = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in found if r.n_shingles < 150)
    assert others == [
        ("7", 2, 7, True), ("7", 6, 7, True), ("8", 0, 8, True), ("None", 0, None, True), ("None", 3, None, True),
    ]


def test_copies_of_odd_tables(odd_docs, clashing_docs, no_docs):
    named = [(r[0], r[1]) for r in odd_rows() if r[0] is not None]
    expected = expected_copies(named)
    for df in (odd_docs, clashing_docs):
        found = [x for x in copies(df.where("doc_id IS NOT NULL"))]
        assert found == expected
    assert minhash.near_copies(odd_docs).count() == len(odd_rows())
    assert copies(no_docs) == []


def nodes(df, **options):
    return sorted((tuple(r) for r in prefix_trie.shared_prefixes(df, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.read.parquet(str(SF / "conversations.parquet"))


@pytest.mark.parametrize("first", [1, 4, 4096])
def test_trie_of_conversations(spark, conversations, first):
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    assert nodes(conversations, first_batch=first) == plain.prefix_nodes(rows)


def odd_turns():
    """Prefixes of one another, equal ones, gaps, ties, missing values, repeated rows, ids without a base."""
    rng = random.Random(6)
    rows = []
    for conv_id in [*range(0, 120), *range(1003, 1010), -7, -5, -1]:
        length = rng.choice((1, 2, 5, 9, 17, 33, 40))
        kind = rng.randrange(3)
        for turn in range(length):
            text = f"turn {turn} é" * (1 + turn % 3) if kind else f"turn {turn} of {conv_id % 4}"
            rows.append((conv_id, turn, "user" if turn % 2 else "assistant", text))
        if conv_id % 11 == 0:
            rows += [(conv_id, 3, None, None), (conv_id, None, "system", ""), rows[-1], rows[-1]]
    rows += [(None, 1, "user", "of no conversation"), (77777, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("first", [2, 4096])
def test_trie_of_odd_turns(spark, first):
    df = spark.createDataFrame(odd_turns(), TURNS)
    assert nodes(df, first_batch=first) == plain.prefix_nodes(odd_turns())


def test_trie_of_odd_tables(spark):
    assert nodes(spark.createDataFrame([], TURNS)) == []
    extra = "key parent low depth edge sizes path node at fresh place size base borrowed first d".split()
    rows = [(*r, *range(len(extra))) for r in odd_turns()]
    df = spark.createDataFrame(rows, TURNS + "".join(f", `{x}` int" for x in extra))
    assert nodes(df) == plain.prefix_nodes(odd_turns())


def test_handles_are_the_fattest_depths(spark):
    pairs = [(a, b) for b in range(1, 70) for a in range(b)]
    df = spark.createDataFrame(pairs, "a int, b int")
    from pyspark.sql import functions as F

    for a, b, f in df.select("a", "b", prefix_trie._fattest(F.col("a"), F.col("b"))).collect():
        assert f == max(range(a + 1, b + 1), key=lambda k: k & -k)
