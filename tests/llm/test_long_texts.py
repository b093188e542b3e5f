"""Very long texts and hot keys in operators 3, 5, 8 and 9: results don't depend on where a text is cut, memory is bounded."""

from __future__ import annotations

import random
import resource

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cadence.llm import langid, quality, token_files, wordcache
from cadence.llm.common import small, text_bytes, work_path

WORDS = ["alpha", "beta", "it's", "naïve", "日本、語", "x1", "12,5", "<|endoftext|>", "The", "end."]


def prose(seed, n, gap=" "):
    rng = random.Random(seed)
    return gap.join(rng.choice(WORDS) for _ in range(n))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_texts_in_pieces_encode_as_whole(name, monkeypatch):
    monkeypatch.setattr(wordcache, "PIECE", 40)
    e, tok = wordcache.WordEncoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    texts = [prose(1, 3000), prose(2, 3000, "\n"), prose(3, 3000, "  "), prose(4, 3000, " \t"), prose(5, 3000).replace("<|endoftext|>", "a"), "q" * 5000, "<|endoftext|>", "a<|endoftext|> b", " " * 500 + "a"]
    for t in texts:
        assert np.frombuffer(e.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
    assert 50256 in e.tok.encode("<|endoftext|>").ids or 49407 in e.tok.encode("<|endoftext|>").ids


def test_word_cache_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(wordcache, "CACHE_BYTES", 50_000)
    e = wordcache.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for k in range(3000):
        e.encode(f"word{k} other{k}")
        assert sum(map(len, (e.first, e.inner, e.first.old, e.inner.old))) <= 50_000 // wordcache.ENTRY_BYTES + 2
    e.encode("y" * 5000)
    assert all(len(w) <= wordcache.LONGEST_KEPT for w in e.first)


def test_long_text_takes_little_memory():
    e = wordcache.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    text = prose(6, 400_000, "  ").replace("<|endoftext|>", "token")
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    ids = e.encode(text)
    assert len(ids) > len(text) / 2
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024 < 60 * len(text)


def test_small_slices_keep_all_rows():
    b = pa.RecordBatch.from_pydict({"n": list(range(50)), "text": ["x" * (k % 7 * 30) if k % 5 else None for k in range(50)]})
    got = list(small([b, b.slice(0, 0)], most=100, rows=9))
    assert [n for s in got for n in s.column("n").to_pylist()] == list(range(50)) and len(got) > 20
    assert all(s.num_rows == 1 or sum(len(t or "") for t in s.column("text").to_pylist()) <= 100 for s in got)


@pytest.mark.parametrize("chunk", [7, 64, 1000])
def test_quality_features_do_not_depend_on_cuts(monkeypatch, chunk):
    texts = pa.array([prose(k, 40) if k % 4 else None for k in range(12)] + ["", "one", "w" * 300 + " tail", prose(9, 300, "  ")])
    data, offsets = text_bytes(texts)
    vectors = np.random.default_rng(0).normal(size=(quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32)

    def features():
        index, empty = quality.index_vectors(), (np.zeros(0, np.int64), np.zeros(0, np.int64))
        table, counts, before = np.zeros(quality.BUCKETS * quality.DIMENSIONS), np.zeros(quality.BUCKETS, np.int64), empty
        for bucket, text in quality.chunks(data, offsets):
            quality.add_contexts(table, counts, bucket, text, index, before)
            before = tuple(np.concatenate(x)[-quality.WINDOW:] for x in zip(before, (bucket, text)))
        return quality.pooled(vectors, data, offsets), table, counts

    whole = features()
    assert len(list(quality.chunks(data, offsets))) == 1
    monkeypatch.setattr(quality, "CHUNK", chunk)
    for a, b in zip(whole, features()):
        assert np.allclose(a, b, atol=1e-5)
    bucket, text = (np.concatenate(x) for x in zip(*quality.chunks(data, offsets)))
    assert np.array_equal(bucket, quality.words(data, offsets)[0]) and np.array_equal(text, quality.words(data, offsets)[1])


def test_code_lengths_do_not_depend_on_cuts(monkeypatch):
    texts = pa.array([prose(k, 30) for k in range(5)] + [None, "", prose(9, 900), "z"])
    sample = langid.grams(*text_bytes(texts))
    model = langid.Model(["a", "b"], [np.unique(sample[::2], return_counts=True), np.unique(sample[1::3], return_counts=True)])
    whole = model.code_lengths(*text_bytes(texts))
    for chunk in (3, 50, 333):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        assert np.allclose(model.code_lengths(*text_bytes(texts)), whole, rtol=1e-5)


def test_a_language_in_few_long_texts_is_learned(spark):
    rng = random.Random(1)
    en, de = ["the", "house", "with", "green", "water", "and"], ["das", "haus", "mit", "grünem", "wasser", "und"]
    rows = [(i, " ".join(rng.choices(en, k=40)), "en") for i in range(400)]
    rows += [(1000 + i, " ".join(rng.choices(de, k=150_000)), "de") for i in range(3)] + [(2000 + i, " ".join(rng.choices(de, k=30)), "de") for i in (0, 5, 10, 15)]
    rows += [(3000, rows[0][1], "en")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.train(docs, train_bytes=100_000)
    assert model.languages == ["de", "en"]
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang").distinct(), "doc_id").collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)


def test_a_hot_doc_id_does_not_fill_the_driver(spark):
    rows = [(7, f"good text number {i} of many with words", 1) for i in range(600)] + [(i, f"zz qq {i} xx", 0) for i in range(100, 400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, label int")
    vectors = quality.word_vectors(docs)
    made = []
    network = quality.Network
    try:
        quality.Network = lambda x, y: made.append(len(x)) or network(x, y)
        assert quality.train(docs, labels, vectors, train_docs=300) is not None
    finally:
        quality.Network = network
    assert 0 < made[0] <= 600


def test_token_files_outlive_the_session(spark):
    texts = [prose(k, 50) for k in range(40)] + [None, ""]
    docs = spark.createDataFrame([(k // 2, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    path = work_path(spark, "test-files")
    token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    rows = token_files.read_tokens(spark, path).orderBy("start").collect()  # nothing but the folder
    assert [r["doc_id"] for r in rows] == [k // 2 for k in range(42)]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    read = []
    reader = token_files.read_range
    try:
        token_files.read_range = lambda s, p, at, n: read.append(n) or reader(s, p, at, n)
        got = token_files.read_document(spark, path, token_files.load_dictionary(spark, path), 3)
    finally:
        token_files.read_range = reader
    assert sorted(x.tolist() for x in got) == sorted(tok.encode(texts[k], add_special_tokens=False).ids + [0] for k in (6, 7))
    assert sum(read[1:]) < 2000  # the dictionary, then two short frames
    assert token_files.part_number("file:/x/part-y/part-100000-ab-c000.txt") == 100_000
