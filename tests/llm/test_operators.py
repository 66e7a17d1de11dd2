import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import plain
from tests.llm.conftest import SCHEMA, SF
from tripstrata.llm import decontaminate, language, quality_model, secrets, token_blocks
from tripstrata.llm.bpe import encode_documents
from tripstrata.llm.class_lm import best_classes, exchange, likelihood, score_documents
from tripstrata.llm.components import components
from tripstrata.llm.jaccard import jaccard_components
from tripstrata.llm.near_duplicates import keep_one_of_each
from tripstrata.llm.repetition import repetition_rules
from tripstrata.llm.sharding import with_shards, write_shards

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(params=["odd_docs", "docs"])
def some_docs(request):
    return request.getfixturevalue(request.param)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_components_of_links(spark):
    chain = [(k, k + 1) for k in range(50)] + [(100 + k, 100) for k in range(30)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(51)} | {100 + k: 100 for k in range(30)}


def test_encoding_equals_the_library(some_docs):
    library = Tokenizer.from_file(WORD_BPE)
    found = by_id(encode_documents(some_docs, WORD_BPE, keep_ids=True))
    for doc_id, text in texts(some_docs):
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        decoded = library.decode(ids, skip_special_tokens=False)
        row = found[doc_id]
        assert (row.n_tokens, bytes(row.ids), row.decoded) == (len(ids), raw, decoded)
        assert row.ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_joints_inside_words_are_repaired(spark):
    """Shared text without white space is cut anywhere; the ids must not show it."""
    shared = "".join(hashlib.sha256(bytes([k])).hexdigest() for k in range(200))
    rows = [(1, "abc" + shared + " end"), (2, "x y" + shared + "tail"), (3, shared)]
    library = Tokenizer.from_file(WORD_BPE)
    found = by_id(encode_documents(spark.createDataFrame(rows, "doc_id long, text string"), WORD_BPE, keep_ids=True))
    for doc_id, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        assert bytes(found[doc_id].ids) == np.array(ids, "<u4").tobytes()


def test_token_files(some_docs):
    library = Tokenizer.from_file(BYTE_BPE)
    found = by_id(token_blocks.token_files_roundtrip(some_docs, BYTE_BPE, 2))
    start = 0
    for doc_id, text in sorted(texts(some_docs), key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        row = found[doc_id]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_one_id_goes_to_several_token_files(spark, tmp_path):
    """Texts of one id, and texts without one, are dealt out; their places still follow one another."""
    rows = [(k if k % 3 else None if k % 2 else 7, f"text {k} " * (1 + k % 5)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        manifest = token_blocks.write_token_files(df, BYTE_BPE, 2, f"file://{tmp_path}/tokens")
        files = manifest.groupBy("first_doc").count().collect()
        assert max(r["count"] for r in files if r.first_doc in (None, 7)) > 1
        found = sorted(token_blocks.read_token_files(manifest).collect(), key=lambda r: r.start)
    finally:
        spark.conf.set(key, before)
    ids = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert ids == sorted(-1 if k is None else k for k, _ in rows)
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens


def test_blocks_hold_any_ids():
    random = np.random.default_rng(1)
    for size in (0, 1, 511, 512, 513, 3000):
        ids = random.integers(0, 50, size)
        ids[random.random(size) < 0.05] = 2**32 - 1
        blocks = token_blocks.pack(ids)
        whole = np.concatenate([token_blocks.unpack(b) for b in blocks]) if blocks else ids
        assert whole.tolist() == ids.tolist()


def test_token_file_ranges(tmp_path):
    ids = np.arange(5000) % 777
    writer = token_blocks.Writer(str(tmp_path / "x.pfor"))
    writer.add(np.array([5, 6]), np.array([2000, 3000]), ids)
    writer.close()
    reader = token_blocks.Reader(str(tmp_path / "x.pfor"))
    assert reader.ids(700, 3100).tolist() == ids[700:3100].tolist()
    assert [len(x) for _, _, x in reader.documents()] == [2000, 3000]


def test_passages(spark):
    items = [(1, "Der Rhein fließt durch Köln und Bonn, bis er das Meer erreicht; so sagt man."), (2, "tiny"), (3, None)]
    changed = "der rhein fliest durch köln und bonn bis er das  meer erreicht so sagt man"
    rows = [
        (10, "Vorher. " + items[0][1] + " Nachher."),
        (11, "A " + changed + " B"),
        (12, "Der Rhein fließt durch Köln und Bonn."),
        (13, None),
        (14, ""),
    ]
    found = decontaminate.find_passages(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id, r.edits > 0) for r in found} == {(10, 1, False), (11, 1, True)}
    where = next(r for r in found if r.doc_id == 10)
    assert rows[0][1][where.start : where.end] == items[0][1][:-1]


def test_passages_of_the_benchmark(spark, docs):
    benchmark = spark.read.parquet(str(SF / "benchmark.parquet"))
    found = decontaminate.find_passages(docs, benchmark)
    exact = {(r.doc_id, r.item_id) for r in found.where("edits = 0").collect()}
    items = [(r.item_id, plain.normal(r.text)) for r in benchmark.collect()]
    expected = {(d, i) for d, t in texts(docs) for i, x in items if x in plain.normal(t)}
    assert exact == expected and expected
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()}
    assert kept == {d for d, _ in texts(docs)} - {r.doc_id for r in found.collect()}


def test_secrets(some_docs):
    found = by_id(secrets.secret_digests(some_docs))
    for doc_id, text in texts(some_docs):
        spans = plain.secrets(text)
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        row = found[doc_id]
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))


def test_secrets_resume_after_a_dropped_match(spark):
    df = spark.createDataFrame([(1, "token=token:abcdef secret==abcdefg API_KEY: \"xyz-123\"")], "doc_id long, text string")
    assert secrets.secret_digests(df).first().n_assign == len(plain.secrets(df.first().text))


def test_random_tokens_are_discovered_and_words_are_not(spark):
    random = np.random.default_rng(3)
    alphabet = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    tokens = ["".join(random.choice(alphabet, 64)) for _ in range(20)]
    prose = ["internationalization" * 3, "characteristicallyandincomprehensibly", "a" * 60, "ab" * 40]
    rows = [(k, f"key {t} end") for k, t in enumerate([*tokens, *prose])]
    found = by_id(secrets.secret_digests(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sum(found[k].n_random for k in range(20)) >= 18
    assert all(found[k].n_random == 0 for k in range(20, 24))
    at, end = map(int, found[0].spans.split(":")[1:])
    assert rows[0][1][at:end] == tokens[0]


def test_redaction(odd_docs, clashing_docs):
    clean = by_id(secrets.redact(odd_docs))
    assert clean[18].text == "[SECRET]' and [SECRET]" and clean[0].text is None
    assert secrets.redact(clashing_docs).count() == odd_docs.count()


def test_language(spark, docs):
    found = by_id(language.predict_language(docs))
    rows = docs.collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(found[r.doc_id].held_out == (r in held) for r in rows)
    right = np.mean([found[r.doc_id].lang_pred == r.lang for r in held])
    assert right >= 0.9
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_without_letters_or_labels(odd_docs, no_docs):
    found = by_id(language.predict_language(odd_docs))
    assert {found[k].lang_pred for k in (0, 1, 2)} == {"und"} and found[3].lang_pred == "en"
    assert language.predict_language(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.predict_language(unlabelled).collect()} == {"und"}


def test_ftrl_weights_are_sparse():
    random = np.random.default_rng(0)
    x = random.random((400, 50)).astype(np.float32)
    y = (x[:, 3] > x[:, 4]).astype(int)
    w = language.fit(x, y, 2, l1=3.0)
    assert (w[:-1] == 0).mean() > 0.2
    assert ((x @ w[:-1] + w[-1]).argmax(axis=1) == y).mean() > 0.9


def test_quality(spark, docs):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = by_id(quality_model.score_quality(big, labels))
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good = [found[r.doc_id].score for r in held if r.quality == 1]
    bad = [found[r.doc_id].score for r in held if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in found.values())


def test_quality_of_odd_texts(spark, odd_docs, no_docs, clashing_docs):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (4, None, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    for df in (odd_docs, clashing_docs):
        found = quality_model.score_quality(df, labels).collect()
        assert len(found) == df.count() and all(0 <= r.score <= 1 for r in found)
    assert quality_model.score_quality(no_docs, labels).count() == 0


def test_shards(spark, docs, odd_docs, no_docs, clashing_docs, tmp_path):
    limit = 40_000
    found = with_shards(docs, limit).collect()
    sizes = {}
    for r in found:
        sizes.setdefault((r.shard_depth, r.shard_prefix), []).append(r.n_bytes)
    assert all(sum(x) <= limit or len(x) == 1 for x in sizes.values()) and len(sizes) > 4
    assert all(sum(sizes[r.shard_depth, r.shard_prefix]) == r.shard_bytes for r in found)
    for (depth, prefix), x in sizes.items():  # no split without need: the parent is over the limit
        if depth:
            parent = sum(sum(v) for (d, p), v in sizes.items() if d >= depth and p >> (d - depth + 1) == prefix >> 1)
            assert parent > limit
    assert with_shards(no_docs, limit).count() == 0
    assert with_shards(clashing_docs, 10).count() == odd_docs.count()
    write_shards(docs, limit, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == docs.count()


def test_shard_of_one_key_cannot_split(spark):
    df = spark.createDataFrame([(1, "x" * 50)] * 4 + [(2, "y")], "doc_id long, text string")
    found = with_shards(df, 100).collect()
    assert [r.oversized for r in found if r.doc_id == 1] == [True] * 4
    assert [r.shard_bytes for r in found if r.doc_id == 2] == [1]


def test_jaccard(some_docs):
    named = some_docs.where("doc_id IS NOT NULL")
    found = jaccard_components(named).collect()
    assert sorted(map(tuple, found)) == plain.components(texts(named))


def test_jaccard_of_a_family_around_the_threshold(spark):
    """Many near copies of one text at 0.7 to 0.9 of it, with a passage that all other texts share."""
    rng = np.random.default_rng(4)
    base, passage = [f"w{k}" for k in range(150)], " ".join(f"p{k}" for k in range(60))
    rows = []
    for k in range(120):
        w = list(base)
        for at in rng.choice(150, rng.integers(1, 6), replace=False):
            w[at] = f"n{k}_{at}"
        rows.append((k, " ".join(w)))
    rows += [(200 + k, " ".join(f"u{k}_{j}" for j in range(90)) + " " + passage) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(df).collect())) == plain.components(rows)


def test_jaccard_keeps_rows(odd_docs, no_docs, clashing_docs):
    assert jaccard_components(no_docs).count() == 0
    assert jaccard_components(clashing_docs).count() == odd_docs.count()
    found = {r.doc_id: r.component_id for r in jaccard_components(odd_docs.unionAll(odd_docs)).collect()}
    assert found[None] is None and found[10] == 6 and found[2] == 2


def test_one_of_each(odd_docs):
    kept = [r.doc_id for r in keep_one_of_each(odd_docs.unionAll(odd_docs)).collect()]
    assert 7 not in kept and 8 not in kept and 4 not in kept and kept.count(None) == 1
    assert len([k for k in kept if k is not None]) == len({k for k in kept if k is not None})


def test_repetition(some_docs):
    short = some_docs.where("text IS NULL OR length(text) < 20000")
    found = by_id(repetition_rules(short))
    for doc_id, text in texts(short):
        r = found[doc_id]
        expected = plain.repetition(text)
        assert (
            r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.covered_words, r.longest_repeat,
        ) == expected
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed
        assert r.kept == (not failed and r.covered_words <= 0.4 * r.n_words and r.longest_repeat <= 400)


def test_repetition_finds_what_windows_miss(spark):
    """Two copies of a long passage are no more than half of the text, and yet too much."""
    once = " ".join(f"a{k}" for k in range(120))
    text = f"{once} {' '.join(f'b{k}' for k in range(260))} {once}"
    row = repetition_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert not row.base_failed and not row.kept and row.longest_repeat == 120


def test_repetition_keeps_columns(odd_docs, clashing_docs, no_docs):
    out = repetition_rules(clashing_docs)
    assert out.count() == odd_docs.count() and set(clashing_docs.columns) <= set(out.columns)
    assert repetition_rules(no_docs).count() == 0


def test_language_model(some_docs):
    named = some_docs.where("doc_id IS NOT NULL")
    found = by_id(score_documents(named))
    tokens = {d: [*plain.words((t or "").translate(plain.FOLD)), None] for d, t in texts(named)}
    from collections import Counter

    count = Counter()
    for d, w in tokens.items():
        if zlib.crc32(str(d).encode()) % 10:
            count.update(w)
    total, kinds = sum(count.values()), len(count)
    for d, w in tokens.items():
        r = found[d]
        base = sum(np.log10((count[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(count[x] > 0 for x in w), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    assert {d for d, r in found.items() if r.held_out} == {
        d for d in tokens if zlib.crc32(str(d).encode()) % 10 == 0
    }


def test_classes_predict_better_than_words(docs):
    rows = [r for r in score_documents(docs).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_language_model_of_odd_tables(no_docs, odd_docs, clashing_docs):
    assert score_documents(no_docs).count() == 0
    assert score_documents(clashing_docs.unionAll(clashing_docs)).count() == 2 * odd_docs.count()


def test_exchange_groups_words_that_are_used_alike():
    counts = np.zeros((9, 9), np.int64)
    counts[:3, 3:] = np.arange(10, 16)
    counts[3:, :3] = 20
    of = exchange(counts, 9, 2)
    assert len(set(of[:3])) == 1 and len(set(of[3:])) == 1 and of[0] != of[3]


def test_best_class_of_a_word():
    """Against the likelihood of the class bigrams counted anew for every class."""
    rng = np.random.default_rng(3)
    core, classes, size = 12, 4, 7
    counts = rng.integers(0, 9, (core + 3, core + 3)) * (rng.random((core + 3, core + 3)) < 0.5)
    of = np.concatenate([rng.integers(0, classes, core - 1), [classes], classes + np.arange(3)])

    def grid(of):
        out = np.zeros((size, size))
        np.add.at(out, (of[:, None], of[None, :]), counts)
        return out

    entries = []
    for w in range(core):
        for side, row in ((0, counts[w]), (1, counts[:, w])):
            others = np.bincount(of, np.where(np.arange(core + 3) == w, 0, row), size)
            entries += [(w, side, d, others[d]) for d in np.flatnonzero(others)]
    own, side, cls, n = (np.array(x) for x in zip(*entries, strict=True))
    found = best_classes(grid(of), classes, of[:core], own, side, cls, n, counts.diagonal()[:core].astype(float))
    for w in range(core):
        reached = []
        for c in range(classes):
            moved = of.copy()
            moved[w] = c
            reached.append(likelihood(grid(moved)))
        assert found[w] == np.argmax(reached)


def test_classes_are_learned_for_all_but_the_rarest_words(spark):
    """Two kinds of 700 words each take turns. Which word is of which kind, its letters do not tell."""
    rng = np.random.default_rng(8)
    names = rng.permutation([f"w{k}" for k in range(1400)])
    rows = []
    for d in range(600):
        kinds = names[:700], names[700:]
        rows.append((d, " ".join(kinds[k % 2][rng.integers(700)] for k in range(100))))
    found = score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    held_out = [r for r in found if r.held_out]
    gain = sum(r.score - r.base_score for r in held_out) / sum(r.n_tokens for r in held_out)
    assert gain > 0.9 * np.log10(2)


def test_empty_table_and_schema(no_docs):
    assert no_docs.schema.simpleString() and SCHEMA
    assert encode_documents(no_docs, WORD_BPE).count() == 0
    assert token_blocks.token_files_roundtrip(no_docs, BYTE_BPE, 2).count() == 0
    assert secrets.secret_digests(no_docs).count() == 0
    items = no_docs.select(F.col("doc_id").alias("item_id"), "text")
    assert decontaminate.find_passages(no_docs, items).count() == 0
