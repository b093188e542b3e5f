"""Operators 11 to 13 against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from cadence.llm import merkle, oracles, queries, suffix_dedup, vafile

SF = "/root/testdata/sf0.001"


def h(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


# --- 11 clustering ------------------------------------------------------------------------------------

def brute_clusters(rows, clusters, rounds):
    """rows: (vec_id, whole numbers). The contract, number by number."""
    centroids = [x for _, _, x in sorted((h(f"1:{i}"), x, x) for i, x in rows if i is not None)][:clusters]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, x in rows:
            members[near(x)[1]].append(x)
        centroids = [[sum(v) // len(v) for v in zip(*members[k])] if members[k] else c for k, c in enumerate(centroids)]
    out = [(i, *near(x)[::-1]) for i, x in rows]
    inertia = defaultdict(int)
    for _, c, d in out:
        inertia[c] += d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), h(",".join(map(str, centroids[c])))) for i, c, d in out), key=repr)


EMBEDDINGS = "vec_id long, embedding array<float>, cluster int, row long, x string"


@pytest.mark.parametrize("spread", [3.0, 0.05])
def test_clusters_equal_brute_force(spark, spread):
    rng = np.random.default_rng(5)
    x = (rng.normal(0, 1, (6, 64))[rng.integers(0, 6, 400)] + rng.normal(0, spread, (400, 64))).astype(np.float32)
    given = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, x[8].tolist()), (8, x[8].tolist()), (8, x[8].tolist()), (None, x[3].tolist()), (900, [0.0] * 64), (901, [-0.01] * 64)]
    bad = [(1000, None), (1001, [1.0] * 63), (1002, []), (1003, [float("nan")] + [0.0] * 63), (1004, [float("inf")] * 64), (1005, [None] + [0.0] * 63)]
    df = spark.createDataFrame([(i, v, 1, 2, "clash") for i, v in given + bad], EMBEDDINGS).repartition(5)
    fetched: list[float] = []
    got = vafile.clustering(vafile.whole_vectors(df), report=fetched).collect()
    want = brute_clusters([(i, [int(np.floor(float(np.float32(c)) * 64)) for c in v]) for i, v in given], 16, 3)
    assert sorted(map(tuple, got), key=repr) == want
    assert fetched[0] == 1 and len(fetched) == 4
    if spread < 1:  # clear clusters are told from the cells alone
        assert fetched[-1] < 0.9


def test_intervals_hold_the_distance():
    rng = np.random.default_rng(2)
    x, centroids = rng.integers(-90, 90, (300, 9)), rng.integers(-120, 120, (5, 9))
    cells = vafile.Cells(x[:40], x.min(0), x.max(0))
    low, high = vafile.intervals(cells.of(x), cells.tables(centroids))
    exact = vafile.distances(x, centroids)
    assert (low <= exact).all() and (exact <= high).all() and (low < high).any()
    one = np.tile(x[:1], (50, 1))  # all alike: every cell but one is empty
    cells = vafile.Cells(one, one[0], one[0])
    low, high = vafile.intervals(cells.of(one), cells.tables(centroids))
    assert (low == high).all()


def test_few_vectors_and_none(spark):
    few = spark.createDataFrame([(1, [0.5] * 64), (2, [0.5] * 64), (3, [-1.0] * 64)], "vec_id long, embedding array<float>")
    got = vafile.clustering(vafile.whole_vectors(few)).collect()
    assert sorted(map(tuple, got)) == brute_clusters([(1, [32] * 64), (2, [32] * 64), (3, [-64] * 64)], 16, 3)
    assert vafile.clustering(vafile.whole_vectors(few.limit(0))).count() == 0
    assert vafile.clustering(vafile.whole_vectors(few.selectExpr("cast(null as long) as vec_id", "embedding"))).count() == 0
    with pytest.raises(ValueError):
        vafile.clustering(vafile.whole_vectors(spark.createDataFrame([(1, [1e12] * 64)], "vec_id long, embedding array<float>")))


# --- 12 manifest --------------------------------------------------------------------------------------

def brute_tree(items):
    """Levels of one tree."""
    levels = [items]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[k : k + 3])) for k in range(0, len(last), 3)])
    return levels


def brute_path(levels, i):
    out = []
    for level in levels[:-1]:
        run = i - i % 3
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
        i //= 3
    return out


def postorder(levels):
    """The nodes in completion order: each after its children, the ones cut short at the very end."""
    out, n = [], len(levels[0])
    for i in range(n):
        for level in range(len(levels)):
            if (i + 1) % 3**level == 0:
                out.append((level, (i + 1) // 3**level - 1))
    return out + [(k, len(levels[k]) - 1) for k in range(len(levels)) if n % 3**k]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 10, 11, 26, 27, 28, 80, 81, 82, 200])
def test_positions_are_closed_form(n):
    items = [h(str(i)) for i in range(n)]
    levels = brute_tree(items)
    order = postorder(levels)
    log = merkle.append_all(items)
    assert log == [levels[k][j] for k, j in order]
    assert [merkle.position(k, j, n) for k, j in order] == list(range(len(order)))
    for i in range(n):
        path = merkle.siblings("".join(log), i, n, merkle.height(n))
        assert path == brute_path(levels, i) and merkle.fold(items[i], path) == levels[-1][0]


def brute_manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: h("".join(map(field, (r[0], r[2], r[3], r[4], text))))
    sources = defaultdict(list)
    for r in rows:
        seen = r[1].replace("\n", "") if r[1] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[1]
        sources[r[2]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), leaf(r, seen)))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([x[2] for x in sorted(sources[s])]) for s in names}
    top = brute_tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (named, doc, own, seen) in enumerate(sorted(sources[s])):
            path = brute_path(trees[s], i) + brute_path(top, k)
            folded = merkle.fold(seen, path)
            out.append((doc if named else None, own, trees[s][-1][0], top[-1][0], h("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


DOCS = "doc_id long, text string, source string, lang string, n_chars long, tree string, digest string, i long"


@pytest.mark.parametrize("align", [1, 2, 7])
def test_manifest_equals_brute_force(spark, monkeypatch, align):
    monkeypatch.setattr(merkle, "ALIGN", align)
    rng = random.Random(3)
    sources = [None, "", "a", "B", "é", "z\n", *[f"s{k}" for k in range(9)]]
    rows = [(i, rng.choice(["a\nb", "no line end", "\n", "", None, "é\n\n日本"]), "hot" if i % 3 else rng.choice(sources), rng.choice(["en", None]), rng.choice([None, i])) for i in range(230)]
    rows += [(5, "tie\n", "hot", None, 1), (5, "tie\n", "hot", None, 1), (5, "other", "hot", None, 1), (None, "x\ny", "hot", None, 1), (None, None, None, None, None), (-3, "minus\n", "alone", "en", 7),
             (9, "long\n" * 50_000, "alone", "en", 7)]
    df = spark.createDataFrame([(*r, "clash", "clash", 0) for r in rows], DOCS).repartition(6)
    got = merkle.manifest(df, merkle.without_line_ends()).collect()
    assert sorted((tuple(r)[:7] for r in got), key=repr) == brute_manifest(rows)
    assert merkle.manifest(df.limit(0), merkle.without_line_ends()).count() == 0
    one = merkle.manifest(df.filter("doc_id = -3"), None).collect()
    assert [(r["leaf"], r["proof_sha256"], r["verified"]) for r in one] == [(one[0]["root"], h(""), True)]


# --- 13 repeated spans --------------------------------------------------------------------------------

def brute_spans(rows, length=50):
    """rows: (doc_id, bytes)."""
    first: dict[bytes, int] = {}
    for i, t in rows:
        if i is not None:
            for p in range(len(t) - length + 1):
                s = t[p : p + length]
                first[s] = min(i, first.get(s, i))
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1 if i is not None else 0):
            if first[t[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), sum(1 for x in bytes(gone).split(b"\0") if x), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def texts_with_copies(seed, n=120):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "日本", "kappa"]
    line = " ".join(rng.choice(words) for _ in range(14))  # a line that many texts hold
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.2:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.5:
            t = rng.choice(texts)
            a = rng.randrange(len(t) + 1)
            b = a + rng.choice([20, 40, 49, 50, 51, 60, 200])
            texts.append(" ".join(rng.choice(words) for _ in range(30)) + t[a:b] + "".join(rng.choice("xyz\0\xff ") for _ in range(30)))
        else:
            texts.append(" ".join(rng.choice(words) for _ in range(rng.randrange(60))) + (line if kind < 0.8 else "") + str(rng.random()))
    return texts


def test_matching_statistics_of_any_text():
    """Texts that aren't in the index are matched too, by jumps to the sampled ends of runs."""
    rng = random.Random(8)
    word = lambda: bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randrange(1, 120)))
    base = [word() for _ in range(25)]
    texts = list(dict.fromkeys(base + [a[:70] + b"c" * 3 + b[-60:] for a, b in zip(base, base[1:])]))
    index = suffix_dedup.RunIndex(texts, np.arange(len(texts)))
    asked = [a[5:90] + rng.choice(texts)[:80] + word() for a in texts] + [b"q", b"qqa", b"a" * 300]
    for lane, place, matched, _, _ in index.stream(asked):
        for k, p, m in zip(lane.tolist(), place.tolist(), matched.tolist()):
            t = asked[k][p:]
            want = max((n for n in range(1, min(len(t), 50) + 1) if any(t[:n] in x for x in texts)), default=0)
            assert min(m, 50) == want, (k, p)
    assert len(index.start) < len(index.text)  # runs, not letters


@pytest.mark.parametrize("limits", [{}, {"BLOCK_BYTES": 3000, "KEY_SHARE": 4000, "INDEX_SHARE": 5000, "CHUNK": 700}, {"BLOCK_BYTES": 2000, "HOT": 3, "MOST": 5}])
def test_spans_equal_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(4)
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts_with_copies(11))]  # some ids twice
    rows += [(7000, ""), (7001, None), (None, rows[0][1]), (None, "z" * 80), (7002, "z" * 80), (7003, "z" * 30_000), (7004, "z" * 81 + "y" * 49), (7005, "ab" * 4000), (6999, "ba" * 50),
             (7006, "u" * 49), (7007, "u" * 49), (7008, "only once " + str(rng.random()) * 3), (7008, rows[3][1]), (7008, rows[3][1])]
    df = spark.createDataFrame([(i, t, i or 0, 1, "clash") for i, t in rows], "doc_id long, text string, block long, part int, payload string").repartition(4)
    got = suffix_dedup.repeated_spans(df).collect()
    assert sorted(map(tuple, got), key=repr) == brute_spans([(i, (t or "").encode()) for i, t in rows])


def test_spans_of_no_text(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.repeated_spans(none).count() == 0
    blank = suffix_dedup.repeated_spans(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).collect()
    assert sorted(map(tuple, blank), key=repr) == sorted([(1, 0, 0, 0, hashlib.sha256().hexdigest()), (None, 0, 0, 0, hashlib.sha256().hexdigest())], key=repr)


# --- the queries --------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_merkle_manifest"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.llm_oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries.llm_queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    got = got.select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
    assert oracles.LEVELS >= 12


def test_span_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_suffix_dedup(spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == brute_spans([(r[0], (r[1] or "").encode()) for r in docs])
