"""Each operator on small tables with known or brute-force answers: nulls, empty and long texts, ties,
repeated rows, empty tables and columns with clashing names."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadence.llm import chat_format, decontam, knn, langid, packing, pii, quality, simhash, token_files, warc
from cadence.llm.common import materialize, row_key, text_bytes, work_path
from cadence.llm.wordcache import WordEncoder

DOCS = "doc_id long, text string, key long, rank int, score string"  # the last three clash with internal names
LONG = " ".join(f"word{i}" for i in range(9000))
TEXTS = ["Hello there, this is a text.", "", None, "  two  spaces\n\nand lines \n", "naïve café Ünïcode İ! ẞ", LONG, "x" * 5000,
         "Hello there, this is a text.", "<|endoftext|> it's 'sTop don't", "日本語 テキスト", "a\tb c"]


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(None if t == "null id" else first + i, t, i, i, "s") for i, t in enumerate(texts)], DOCS)


def encoded(name, text):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    return tok.encode(text or "", add_special_tokens=False).ids


# --- word cache -------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_words_equal_whole_texts(name):
    e = WordEncoder(public_tokenizers.path(name))
    odd = [t or "" for t in TEXTS] + [
        " a", "a ", "\n", "\na", "a\n", "it's. x'll", "é ́e á.", "x² y½ 12a b3.c", "a.b,c!!d ***f", "Ǆ ǅ. İ.", "Σ. ΑΣ.", "a 's b", "İ.̇", "q ", "12,345.67 $5.00"]
    assert [e.encode(t) for t in odd] == [e.whole(t) for t in odd]
    assert [e.encode(t) for t in odd] == [np.array(encoded(name, t), "<u4").tobytes() for t in odd]


# --- 1 chat -----------------------------------------------------------------------------------------

CHAT = "conv_id long, turn long, role string, text string, formatted string"


def test_chat_round_trip(spark):
    bad = ["</s>[INST] ok [/INST]", "a & b &amp; &lt;/s>", "<s>user\n[INST] x", "[INST] [/INST]", "", None, "|e\n", "plain\ntext", "&#91;INST]", "</s", "s>", "<"]
    rows = [(c, t, r, x, "clash") for c, r in enumerate(["user", "assistant", "system", "tool|e\n</s>", "", None]) for t, x in enumerate(bad)]
    rows += [(None, 0, "user", "nameless", ""), (99, 1, "user", "tie b", ""), (99, 1, "user", "tie a", ""), (99, 1, "user", "tie a", ""), (99, None, "assistant", "first", ""),
             (100, 0, "assistant", "x" * 300_000 + "</s>", "")]
    out = {r["conv_id"]: r for r in chat_format.read_chat(chat_format.format_chat(spark.createDataFrame(rows, CHAT))).collect()}
    for c in range(6):
        own = [r for r in rows if r[0] == c]
        assert [(t["role"], t["text"]) for t in out[c]["turns"]] == [(r[2] or "", r[3] or "") for r in own]
        assert out[c]["loss_text"] == "".join(r[3] or "" for r in own if r[2] == "assistant")
        if own[0][2] == "user":  # control strings stand only where the template puts them
            assert out[c]["formatted"].count("[INST]") == out[c]["formatted"].count("[/INST]") == out[c]["formatted"].count("</s>") == len(own)
    assert [t["text"] for t in out[99]["turns"]] == ["first", "tie a", "tie a", "tie b"]
    assert out[None]["turns"][0]["text"] == "nameless"
    assert out[100]["loss_text"] == "x" * 300_000 + "</s>"
    assert chat_format.format_chat(spark.createDataFrame([], CHAT)).count() == 0


def test_chat_stays_in_the_engine(spark):
    plan = chat_format.read_chat(chat_format.format_chat(spark.createDataFrame([(1, 0, "user", "x", "")], CHAT)))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- 2 WARC -----------------------------------------------------------------------------------------

def test_archives_and_histories(spark):
    big, other = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 20, "y" * 100
    rows = [(5, "http://a.example/x", big), (3, "http://b.example/", big), (9, "http://a.example/x#f", big), (4, "https://www.c.example/Q?z=1", None),
            (6, None, "small"), (7, "no url", "small"), (8, "http://a.example/x", other), (2, "http://a.example/x", other), (2, "http://a.example/x", other),
            (10, "http://h\r\nX: y", ""), (None, "http://n.example", other), (11, "http://a.example/x", "z" * 2_000_000)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, record_type string, key int").repartition(4)
    out = warc.capture_histories(pages).collect()
    assert len(out) == len(rows)
    first = {big: 3, other: 2}
    for page, _, html in rows:
        payload = (html or "").encode()
        got = [r for r in out if r["page_id"] == page]
        revisit = html in first and page != first[html]
        for r in got:
            assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
            assert (r["record_type"], r["refers_to"]) == (("revisit", first[html]) if revisit else ("response", None))
    order = [(r["key"], r["date"], -1 if r["page_id"] is None else r["page_id"]) for r in out]
    assert order == sorted(order)
    assert warc.capture_histories(pages.limit(0)).count() == 0


def test_histories_are_ordered_across_ranges(spark):
    pages = spark.range(500).selectExpr("id as page_id", "concat('http://h', id % 3, '.example/', id % 7) as url", "repeat('x', 120) as html").repartition(5)
    path = work_path(spark, "test-warc")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    warc.write_archives(pages, path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert warc.read_index(spark, path).select("run").distinct().count() > 1
    merged = warc.merge_runs(warc.read_index(spark, path), merge_rows=60)
    got = [(r["key"], r["date"], r["page_id"]) for r in merged.collect()]
    assert got == sorted(got) and len(got) == 500 and merged.rdd.getNumPartitions() > 1


def test_loser_tree():
    rng = np.random.default_rng(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((int(x), r) for x in rng.integers(0, 20, rng.integers(0, 30))) for r in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


# --- 3 packing --------------------------------------------------------------------------------------

def check_packing(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_whole_documents(spark):
    docs = docs_of(spark, TEXTS + ["null id"])
    rows = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    used = check_packing(rows, 4096)
    want = []
    for r in docs.collect():
        ids = encoded("word_bpe_49k.json", r["text"]) + [1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4")
            want.append((r["doc_id"], k // 4096, k, len(part), zlib.crc32(part.tobytes())))
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows], key=key) == sorted(want, key=key)
    assert used == math.ceil(sum(w[3] for w in want) / 4096) or used <= math.ceil(sum(w[3] for w in want) / 4096) + 1
    assert packing.pack(docs.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = docs_of(spark, ["one two", "three", "one two", ""])
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)
    assert sorted(i for r in packing.sequences(packed).collect() for i in r["ids"]) == sorted(i for t in ("one two", "three", "one two", "") for i in encoded("word_bpe_49k.json", t) + [1])


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = 200
    lengths = np.clip(rng.gamma(1 + seed, 40, 3000).astype(int) + 1, 1, capacity)
    if seed == 3:
        lengths[:1000] = 70  # one length holds a third
    counts = np.bincount(lengths, minlength=capacity + 1)
    plan = packing.plan_packing(counts, capacity, groups=20)
    assert (plan.used == counts).all()
    fill, ranks = defaultdict(list), Counter()
    length, first, sequence, copies, offset = plan.arrays()
    order = np.lexsort((first, length))
    for k, row in enumerate(order):
        last = k + 1 == len(order) or length[order[k + 1]] != length[row]
        n = (counts[length[row]] if last else first[order[k + 1]]) - first[row]
        for i in range(n):
            fill[sequence[row] + i // copies[row]].append((offset[row] + i % copies[row] * length[row], length[row]))
        ranks[length[row]] += n
    assert all(ranks[n] == counts[n] for n in range(1, capacity + 1))
    check_packing([{"sequence_id": s, "offset": o, "length": n} for s, places in fill.items() for o, n in places], capacity)
    plain = packing.Plan(counts, capacity)
    for n in range(capacity, 0, -1):
        plain.best_fit(n)
    assert len(fill) == plan.sequences <= 1.02 * plain.sequences + 1


# --- 4 decontamination ------------------------------------------------------------------------------

ITEM = "A train leaves Boston with 120 passengers and 30 km later, in Salem, another 120 passengers enter the long train"


def test_leaks_and_reparameterised_questions(spark):
    items = [(1, ITEM), (2, "only three words"), (3, None), (4, "The quick brown fox jumps over it"), (5, ITEM), (6, "7 8 9 10 11 12 13 14 15 16")]
    other = ITEM.replace("120", "85").replace("Boston", "Denver").replace("30", "12").replace("Salem", "Aurora").replace("km", "miles")
    docs = ["Clean text about trains and other things that leave the town with many people on board.",
            f"Before. {ITEM}. After.", f"Before.\n{other}! After it", other.replace("85", "44", 1), "", None, "quick: the quick brown fox jumps over it.",
            "null id", "1 2 3 4 5 6 7 8 9 10 11", f"Before. {ITEM}. After.", "say only three words here", LONG + " " + ITEM]
    d = docs_of(spark, docs)
    found = decontam.leaks(d, spark.createDataFrame(items, "item_id int, text string"))
    got = {(r["doc_id"], r["item_id"]): r for r in found.collect()}
    assert set(got) == {(i, j) for i in (1, 2, 9, 11) for j in (1, 5)} | {(6, 4)}
    assert got[1, 1]["changed"] == 0 and got[2, 1]["changed"] == got[2, 1]["slots"] >= 6
    kept = decontam.without_leaks(d, spark.createDataFrame(items, "item_id int, text string"))
    assert kept.columns == d.columns and sorted(r["key"] for r in kept.collect()) == [0, 3, 4, 5, 7, 8, 10]
    assert decontam.leaks(d.limit(0), spark.createDataFrame(items, "item_id int, text string")).count() == 0
    assert decontam.leaks(d, spark.createDataFrame([], "item_id int, text string")).count() == 0


SHORT = "Which river runs through the old town near Salem in May"


def test_leaks_in_running_text(spark):
    items = [(1, SHORT), (2, "Name the largest old river there"), (3, "days of rain fell upon the old bridge"), (4, "What is the capital of our country today")]
    docs = [f"He asked, {SHORT}?", f"he asked {SHORT}", SHORT.replace(" Salem", "\nSalem"), "Please; Name the largest old river there.",
            SHORT.replace("near ", "near \u00a0\n "), "It was 5 days of rain fell upon the old bridge", "he knew Paris is the capital of our country today", f"he asked {SHORT.lower()}"]
    found = decontam.leaks(docs_of(spark, docs), spark.createDataFrame(items, "item_id int, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 1), (1, 1), (2, 1), (3, 2), (4, 1), (5, 3)}
    assert all(r["matched"] == r["windows"] for r in found)


def test_leaks_with_one_changed_value(spark):
    item = "a tank holds 120 litres of clean water and then after a long slow leak in the old pipe it holds only 120 litres again"
    other = item.replace("120", "85")
    docs = [item.replace("only 120", "only 121"), other.replace("only 85", "only 86"), other,
            item.replace("120", "7").replace("holds 7", "holds 8", 1).replace("clean", "dirty").replace("slow", "fast")]
    found = decontam.leaks(docs_of(spark, docs), spark.createDataFrame([(1, item)], "item_id int, text string")).collect()
    got = {r["doc_id"]: (r["matched"], r["changed"]) for r in found}
    assert got == {0: (15, 0), 1: (11, 0), 2: (18, 2)}


def test_leaks_of_numbers_and_names(spark):
    series, people, short = "3 1 4 1 5 9 2 6 5 35 89 79 32 38", "it names Ada, Bob, Cyd, Dan, Eve, Fay, Gus, Hal, Ivy, Joe, Kim, Lee, Max, Ned", "5 km 7 kg 9 m"
    items = [(1, series), (2, people), (3, short), (4, "2 4 6 8 10 is what he said and then they all went home in the dark")]
    docs = [f"Numbers: {series}, and more.", series.replace("9 2", "9 3"), "it names Ada, Bob, Cyd, Dan, Eve, Fay, Gus, Hal, Ivy, Joe, Kim, Lee, Max and nobody",
            people.replace("Ada", "Zoe").replace("Eve", "Ann").replace("Hal", "Jim").replace("Kim", "Ron"), f"it was {short} again", "it was 5 km 7 kg 8 m again",
            "3 5 7 9 11 is what he said and then they all went home in the dark"]
    found = decontam.leaks(docs_of(spark, docs), spark.createDataFrame(items, "item_id int, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 1), (2, 2), (4, 3), (6, 4)}
    assert {r["doc_id"]: (r["matched"], r["windows"]) for r in found}[0] == (7, 7)


def test_leaks_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    items = spark.createDataFrame([(1, ITEM)], "item_id int, text string")
    assert [r["doc_id"] for r in decontam.leaks(docs_of(spark, ["none of it", ITEM]), items).collect()] == [1]


def test_leaks_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    found = decontam.leaks(docs, items)
    assert not re.search("Python|Pandas|ArrowEval", found._jdf.queryExecution().toString())
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    words = lambda t: re.findall(r"\w+", t.lower())
    runs = {i["item_id"]: [tuple(w[k : k + 8]) for w in [words(i["text"])] for k in range(len(w) - 7)] for i in items.collect()}
    for d in docs.collect():
        w = words(d["text"])
        own = {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
        for item, windows in runs.items():
            share = sum(x in own for x in windows)
            assert ((d["doc_id"], item) in got) == (share >= min(6, len(windows)) and share > 0) or 0 < share < 8


# --- 5 quality --------------------------------------------------------------------------------------

def test_words_are_read_whole():
    import pyarrow as pa

    texts = ["ab cd!!", None, "", "ab", "!!  cd", "é*é"]
    bucket, text = quality.words(*text_bytes(pa.array(texts)))
    assert text.tolist() == [0, 0, 0, 3, 4, 4, 5, 5, 5]
    assert bucket[0] == bucket[3] and bucket[1] == bucket[5] and bucket[2] == bucket[4] and bucket[6] == bucket[8]


def test_random_indexing_against_brute_force():
    rng = np.random.default_rng(2)
    bucket, text = rng.integers(0, 50, 300), np.sort(rng.integers(0, 4, 300))
    index = quality.index_vectors()
    table, counts = np.zeros(quality.BUCKETS * quality.DIMENSIONS), np.zeros(quality.BUCKETS, np.int64)
    quality.add_contexts(table, counts, bucket, text, index)
    want = np.zeros((quality.BUCKETS, quality.DIMENSIONS))
    for i in range(300):
        for j in range(max(0, i - 2), min(300, i + 3)):
            if i != j and text[i] == text[j]:
                want[bucket[i], index[0][bucket[j]]] += index[1][bucket[j]]
    assert np.allclose(table.reshape(want.shape), want) and counts.sum() == 300


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.classify(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.9


@pytest.mark.parametrize("parts", [1, 2, 7, 30])
def test_quality_tables_are_added_up_before_the_driver(spark, parts):
    got = quality.tree_sum(spark.sparkContext.parallelize(range(30), parts).mapPartitions(lambda rows: [sum(rows)]), lambda a, b: a + b)
    assert got.collect() == [sum(range(30))]               # one row, however many tables there were
    assert quality.tree_sum(spark.sparkContext.emptyRDD(), lambda a, b: a + b).collect() == []


def test_quality_edge_cases(spark):
    docs = docs_of(spark, TEXTS + ["null id"])
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 1), (0, 1, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == len(TEXTS) + 1 and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[0] == by[7] and by[1] == by[2]
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0


# --- 6 personal data --------------------------------------------------------------------------------

def brute_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


ODD = ["a@b.c@d.e x@y", "a@b@c.d", "@a.b", "a@b.c.d@e.f-g.h", "1.2.3.4.5.6.7.8 300.1.1.1 001.02.3.4", "4111 1111 1111 1111-4111111111111111", "4111-1111-1111-1111 x 4111  1111",
       "+1 (555) 123-4567 +++1 2 +49 30 1234567.", "9" * 3000, "a" * 3000 + "@" + "b" * 3000 + ".c", "1.1.1.", "+1" + " " * 500, "é@x.y 😀 a@b.co 10.0.0.1", "x@-.-"]


def test_base_spans_follow_the_patterns():
    rng = np.random.default_rng(3)
    odd = ODD + ["".join(rng.choice(list("a1@. +-()25"), 60)) for _ in range(3000)]
    assert [pii.listed(pii.base_spans(t)) for t in odd] == [pii.listed(brute_spans(t)) for t in odd]


def test_patterns_discover_unseen_identifiers(spark):
    known = [f"please write to mail{i}@host{i}.example today or later {i}" for i in range(12)]
    texts = known + ["please write to bob[at]host.example today ok", "version 4.0.1 of it", "please write to nobody today ok", "bob[at]host.example alone", "", None, "null id"] + ODD
    docs = docs_of(spark, texts)
    rows = pii.find_personal_data(docs).collect()
    spans = {r["doc_id"]: r["spans"] for r in rows if r["doc_id"] is not None}
    assert spans[12] == "email:16:35" and spans[13] == spans[14] == spans[15] == spans[16] == spans[17] == ""
    for r in rows:
        if r["doc_id"] is not None:
            base = pii.listed(brute_spans(texts[r["doc_id"]] or ""))
            assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and set(filter(None, base.split(","))) <= set(r["spans"].split(","))
            assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k + ":") for s in r["spans"].split(",")) for k in pii.KINDS]
    assert pii.find_personal_data(docs.limit(0)).count() == 0


def test_patterns_with_many_unseen_identifiers(spark):
    texts = [f"please write to mail{i}@host.example today" for i in range(14)] + [f"please write to bob{i}[at]host.example today" for i in range(10)]
    texts += [f"you can call me at +1 555 123 4{i} any time" for i in range(100, 120)] + [f"you can call me at 555 123 5{i} any time" for i in range(100, 118)]
    texts += ["you can call me at (017) 555-7713 any time", "you see chapter 3 of it"]
    texts += [f"my lucky tag +1 555 123 6{i} ok" for i in range(100, 106)] + [f"my lucky tag ab{i}c ok" for i in range(100, 140)] + ["my lucky tag 555 999 7000 ok"]
    spans = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs_of(spark, texts)).collect()}
    assert all(spans[i] == f"email:16:{len(texts[i]) - 6}" for i in range(24))
    assert all(spans[i] == f"phone:19:{len(texts[i]) - 9}" for i in range(24, 63))
    assert all(spans[i] == "" for i in [63, *range(70, 111)])


def test_masking(spark):
    docs = spark.createDataFrame([(1, "to a@b.co now", 13, "c"), (2, "clean", 5, "c"), (3, None, None, "c"), (4, "+1 234 5678 90123456 x", 1, "c")], "doc_id int, text string, n_chars long, found string")
    out = {r["doc_id"]: r for r in pii.mask(docs).collect()}
    assert pii.mask(docs).columns == docs.columns
    assert (out[1]["text"], out[1]["n_chars"], out[2]["text"], out[3]["text"], out[3]["n_chars"]) == ("to [EMAIL] now", 14, "clean", None, None)
    assert pii.masked("abcdef", [("ip", 1, 4), ("card", 3, 5)]) == "a[IP]f"


# --- 7 SimHash --------------------------------------------------------------------------------------

def brute_fingerprint(text):
    import xxhash

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=2):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_near_duplicates_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(1000, ""), (999, None), (1001, " \t\n"), (1002, "One"), (1003, "one"), (0, rows[5][1]), (None, rows[5][1]), (1004, "É É é é"), (None, "unique nameless text of its own")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, component_id string")
    got = simhash.near_duplicates(docs).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    label = brute_components(fps)
    first = {}
    for (i, _), g in zip(rows, label):
        if i is not None:
            first[g] = min(first.get(g, i), i)
    want = Counter((i, f"{f:016x}", first.get(g)) for (i, _), f, g in zip(rows, fps, label))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [4, 512])
def test_dense_groups_keep_every_link(spark, block):
    rng = np.random.default_rng(5)
    centre = int(rng.integers(0, 2**62))
    fps = {centre}
    while len(fps) < 120:  # one large group within a few bits, in a chain and around a centre
        fps.add(list(fps)[rng.integers(len(fps))] ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    fps |= {int(x) for x in rng.integers(0, 2**63, 80)}
    fps = sorted(fps)
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), block=block)
    got = {r["fp"]: r["label"] for r in simhash.components(edges).collect()}
    label = brute_components(fps)
    groups = defaultdict(set)
    for x, g in zip(signed, label):
        groups[g].add(x)
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {frozenset(x for x in got if got[x] == v) for v in set(got.values())}


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 5, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(0, 64, 5).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 5).astype(np.uint64)) for _ in range(40)]]))
    i, j = simhash.bit_sliced_links(fps, radius, chunk=32)
    want = {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps)) if int(fps[a] ^ fps[b]).bit_count() <= radius}
    assert set(zip(i.tolist(), j.tolist())) == want


# --- 8 token files ----------------------------------------------------------------------------------

def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(token_files, "FILE_BYTES", 3000)
    docs = docs_of(spark, TEXTS + ["null id", "again"], first=100).unionByName(docs_of(spark, ["repeated id"], first=100)).repartition(3)
    path = work_path(spark, "test-tokens")
    dictionary = token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    rows = token_files.read_tokens(spark, path, dictionary).collect()
    want = Counter()
    for r in docs.collect():
        ids = np.array(encoded("byte_bpe_50k.json", r["text"]) + [0], "<u4")
        want[r["doc_id"], len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    at = 0
    rows = sorted(rows, key=lambda r: r["start"])
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert ids == sorted(ids)
    assert [x.tolist() for x in token_files.read_document(spark, path, dictionary, 104)] == [encoded("byte_bpe_50k.json", TEXTS[4]) + [0]]
    assert len(token_files.read_document(spark, path, dictionary, 100)) == 2
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_tokens(spark, path, b"other").count()
    assert token_files.tokens(docs.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# --- 9 language -------------------------------------------------------------------------------------

def test_code_lengths_against_a_plain_model():
    import pyarrow as pa

    texts = {"aa": ["banana band", "Ban the bandana", ""], "bb": ["zig zag zoo", "zoological é"]}
    sample = {k: langid.grams(*text_bytes(pa.array(v))) for k, v in texts.items()}
    model = langid.Model(sorted(texts), [np.unique(sample[k], return_counts=True) for k in sorted(texts)])

    def plain(lang, text):
        seen = defaultdict(Counter)
        fold = lambda t: bytes(langid._FOLD[np.frombuffer(t.encode(), np.uint8)])
        for t in texts[lang]:
            data = bytes(langid.ORDER) + fold(t)
            for i in range(langid.ORDER, len(data)):
                for k in range(langid.ORDER + 1):
                    seen[data[i - k : i]][data[i]] += 1
        data, bits = bytes(langid.ORDER) + fold(text), 0.0
        for i in range(langid.ORDER, len(data)):
            for k in range(langid.ORDER, -2, -1):
                if k < 0:
                    bits += 8
                    break
                c = seen.get(data[i - k : i])
                if c and data[i] in c:
                    bits -= math.log2(c[data[i]] / (c.total() + len(c)))
                    break
                if c:
                    bits -= math.log2(len(c) / (c.total() + len(c)))
        return bits

    asked = ["banana", "zoo band", "", "qqq é", "Ban the zig", "x" * 50]
    got = model.code_lengths(*text_bytes(pa.array(asked)))
    assert np.allclose(got, [[plain(k, t) for k in sorted(texts)] for t in asked], rtol=1e-5)


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows if r["held_out"]]) > 0.97


def test_language_edge_cases(spark):
    rows = [(i, f"the cat sat on mat {i}", "en") for i in range(40)] + [(100 + i, f"der hund läuft über {i}", "de") for i in range(40)]
    rows += [(200, None, "en"), (201, "", "en"), (202, "12 34 !!", "de"), (None, "der hund", None), (203, "der hund über", None), (0, "the cat", "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, has_letter string")
    got = langid.identify(docs).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and [by[k]["lang_pred"] for k in (200, 201, 202, 203, None)] == ["und", "und", "und", "de", "de"]
    assert {r["lang_pred"] for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0


# --- 10 top-k ---------------------------------------------------------------------------------------

def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(knn, "PER_PIVOT", 40)
    monkeypatch.setattr(knn, "LEAST_CHUNK", 16)
    monkeypatch.setattr(knn, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(4)
    vecs = [(i, rng.normal(0, 1, 8).round(3).tolist()) for i in range(300)]
    vecs += [(300 + i, vecs[0][1]) for i in range(150)]  # one vector holds a third
    vecs += [(600, None), (601, [1.0, None]), (602, [float("nan")] * 8), (603, [float("inf")] * 8), (604, [2.0, -1.5]), (605, []), (None, [9.0] * 8), (7, [3.0] * 8), (20, [1.0] * 8)]
    rows = spark.createDataFrame([(i, v, 1, "x") for i, v in vecs], "vec_id long, embedding array<float>, cell int, chunk string")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in knn.top_k(knn.whole_vectors(rows), F.col("vec_id") % 20 == 0).collect()}
    fine = [(i, np.pad([math.floor(1024 * float(np.float32(x))) for x in v], (0, 8 - len(v))).astype(np.int64)) for i, v in vecs
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q in {i for i, _ in fine if i % 20 == 0} - {20}:  # id 20 names two queries
        x = next(v for i, v in fine if i == q)
        best = sorted(((-int(x @ v), i) for i, v in fine if i != q))[:10]
        assert [got[q, k + 1] for k in range(10)] == [(i, -s) for s, i in best]
    few = knn.top_k(knn.whole_vectors(rows.filter("vec_id < 3")), F.col("vec_id") == 0).collect()
    assert sorted(r["rank"] for r in few) == [1, 2]
    assert knn.top_k(knn.whole_vectors(rows.limit(0)), F.col("vec_id") == 0).count() == 0


def test_scores_beyond_doubles_are_exact():
    q = np.array([[2**31 + 1, 3]])
    assert knn.exact_scores(q, q)[0, 0] == (2**31 + 1) ** 2 + 9


def test_row_keys_tell_nulls_and_ids_apart(spark):
    """128 bits per (doc_id, text): nulls, empty texts and ids that run into the text have keys of their own."""
    rows = [(None, None), (None, ""), (1, None), (1, ""), (1, "1"), (11, ""), (1, "+"), (-1, ""), (None, "1+"), (1, "-")]
    keys = [bytes(r[0]) for r in spark.createDataFrame(rows * 2, "doc_id long, text string").select(row_key()).collect()]
    assert keys[:10] == keys[10:] and len(set(keys)) == 10 and {len(k) for k in keys} == {16}
