"""Merkle manifest of a dataset as postorder append logs: one per source, and one over the sources.

A tree takes its items in order; while several nodes remain, every ARITY consecutive ones (the last
run may be shorter, even a single one) become the SHA-256 of their digests (lower-case hex, joined).

* Items get their number in their tree by a range sort: a task numbers its own run of a tree's items,
  and the counts of the runs (a row per task and tree) say where each run begins.
* Aligned builders: ``ARITY ** ALIGN`` consecutive items, counted from a multiple of that number, are one
  builder's. It appends a node to its log as soon as the node's last item is there, that is in
  postorder, and passes the root on; the roots are the items of the next round. A source with a third
  of all rows is many builders, and a builder never holds more than ``ARITY ** ALIGN`` items.
* The place of a node in such a log follows from the sizes of the complete subtrees before it
  (:func:`position`). A proof is therefore read from the log by address, without links or searches.
* Proofs come down the rounds: a builder takes the path of its root and adds its own siblings to it.
  Siblings stay as (left, right) texts per level, which is what folding needs.

Defined cases: a null column is hashed as ``-``; rows of one source are ordered by doc_id (null
first), then leaf; equal rows are leaves each and get the same values; the null source comes first; a
null doc_id is never tampered with; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import materialize, ship

ARITY = 3
#: A builder covers ARITY ** ALIGN items.
ALIGN = 7
HEX = 64

PATH = "array<struct<left:string,right:string>>"


# --- one log ----------------------------------------------------------------------------------------

def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` items: 0 for one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def position(level: int, j: int, n: int, levels: int | None = None) -> int:
    """Place of node ``j`` of ``level`` in the log of a tree over ``n`` items.

    Nodes that end with item E - 1 come after all complete nodes that end before it; a node that
    is cut short by the end of the items is appended after all complete ones, lower levels first.
    """
    levels = height(n) if levels is None else levels
    end = (j + 1) * ARITY**level
    if end <= n:
        return sum(end // ARITY**t for t in range(level + 1)) + sum((end - 1) // ARITY**t for t in range(level + 1, levels + 1)) - 1
    complete = sum(n // ARITY**t for t in range(levels + 1))
    return complete + sum(1 for t in range(level) if n % ARITY**t)


def append_all(items: Iterable[str], levels: int | None = None) -> list[str]:
    """The log of one tree: every node in completion order. ``levels``: carry a single node up to that level."""
    log: list[str] = []
    open_: list[list[str]] = [[]]

    def put(level: int, node: str) -> None:
        log.append(node)
        while len(open_) <= level:
            open_.append([])
        open_[level].append(node)

    n = 0
    for item in items:
        n += 1
        put(0, item)
        level = 0
        while len(open_[level]) == ARITY:
            node = digest(*open_[level])
            open_[level] = []
            level += 1
            put(level, node)
    top, level = height(n) if levels is None else levels, 0
    while level < top:  # the runs cut short by the end
        if level < len(open_) and open_[level]:
            node = digest(*open_[level])
            open_[level] = []
            put(level + 1, node)
        level += 1
    return log


def siblings(log: str, item: int, n: int, levels: int) -> list[tuple[str, str]]:
    """(left, right) digests beside the nodes from item ``item`` up to the root, read from the log by address."""
    out = []
    size = n
    for level in range(levels):
        j = item // ARITY**level
        first = j - j % ARITY
        at = [position(level, k, n, levels) for k in range(first, min(first + ARITY, size))]
        nodes = [log[HEX * a : HEX * a + HEX] for a in at]
        out.append(("".join(nodes[: j - first]), "".join(nodes[j - first + 1 :])))
        size = -(-size // ARITY)
    return out


def fold(leaf: str, path: Iterable[tuple[str, str]]) -> str:
    for left, right in path:
        leaf = digest(left, leaf, right)
    return leaf


# --- Spark ------------------------------------------------------------------------------------------

def _field(c: Column, text: bool) -> Column:
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) if text else c


def leaf_digest(text: Column | str = "text") -> Column:
    """H of doc_id, source, lang, n_chars and text, each as its UTF-8 length, ``:`` and itself, ``-`` if null."""
    columns = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col(text) if isinstance(text, str) else text]
    return F.sha2(F.concat(*[_field(c, True) for c in columns]), 256)


def numbered(items: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``items`` with ``i``, its number among the rows of its ``tree`` in that order, and the tree's ``n``."""
    kept = items.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, last, rank = TaskContext.get().partitionId(), object(), 0
        for b in batches:
            ranks = []
            for t in b.column(tree).to_pylist():
                rank = rank + 1 if t == last else 0
                last = t
                ranks.append(rank)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([run] * b.num_rows, pa.int32()), pa.array(ranks, pa.int64())], [*b.schema.names, "_run", "_rank"])

    by = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    schema = items.select("*", F.lit(0).alias("_run"), F.lit(0).cast("long").alias("_rank")).schema
    ranked = materialize(items.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(number, schema), "merkle-items")
    runs = ranked.groupBy(tree, "_run").agg(F.count(F.lit(1)).alias("_rows"))
    w = Window.partitionBy(tree)  # a row per task that holds the tree
    firsts = runs.select(F.col(tree).alias("_tree"), F.col("_run").alias("_of"), F.sum("_rows").over(w).alias("n"),
                         (F.sum("_rows").over(w.orderBy("_run")) - F.col("_rows")).alias("_first"))
    same = F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("_run") == F.col("_of"))
    return ranked.join(firsts, same).select(*kept, (F.col("_first") + F.col("_rank")).alias("i"), "n")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows that are equal in ``keys``, of sorted batches."""
    last, rows = None, []
    for b in batches:
        for r in b.to_pylist():
            k = tuple(r[c] for c in keys)
            if rows and k != last:
                yield last, rows
                rows = []
            last = k
            rows.append(r)
    if rows:
        yield last, rows


def build(items: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The logs of all trees, from items (tree, i, digest, n): the roots (tree, root), and the log of each round.

    A log row is one builder's: tree, g (its number), n (the tree's items in this round), nodes (its
    part of the log), top (its root).
    """
    ship(items.sparkSession)
    size = ARITY**ALIGN

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, g), rows in _groups(batches, ["tree", "g"]):
            n = rows[0]["n"]
            log = append_all((r["digest"] for r in rows), ALIGN if n > size else None)
            yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.string()), "g": pa.array([g], pa.int64()), "n": pa.array([n], pa.int64()),
                                              "nodes": pa.array(["".join(log)], pa.string()), "top": pa.array([log[-1]], pa.string())})

    logs, roots = [], None
    while True:
        units = items.select("tree", F.floor(F.col("i") / size).alias("g"), "i", "digest", "n")
        log = materialize(units.repartition("tree", "g").sortWithinPartitions("tree", "g", "i").mapInArrow(append, "tree string, g long, n long, nodes string, top string"), "merkle-log")
        logs.append(log)
        done = log.filter(F.col("n") <= size).select("tree", F.col("top").alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        items = log.filter(F.col("n") > size).select("tree", F.col("g").alias("i"), F.col("top").alias("digest"), F.ceil(F.col("n") / size).alias("n"))
        if not items.limit(1).count():
            return roots, logs


def _down(units: DataFrame, log: DataFrame, paths: DataFrame, out, schema: str) -> DataFrame:
    """Give ``out`` each builder's units (tree, g, i, payload) with its log row and the path of its root.

    The log row is sorted before the units, which stream past it: only the log and one batch are held.
    """
    ship(units.sparkSession)
    nothing = F.lit(None)
    head = log.join(paths, (F.col("tree").eqNullSafe(F.col("p_tree"))) & (F.col("g") == F.col("p_i"))).select(
        "tree", "g", F.lit(-1).cast("long").alias("i"), "n", "nodes", "path", "context", nothing.cast("string").alias("payload"))
    rest = units.select("tree", "g", "i", nothing.cast("long").alias("n"), nothing.cast("string").alias("nodes"), nothing.cast(PATH).alias("path"),
                        nothing.cast("string").alias("context"), "payload")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = ARITY**ALIGN
        now = None
        for b in batches:
            found = []
            for r in b.to_pylist():
                if r["i"] < 0:
                    whole, first = r["n"], r["g"] * size
                    now = (r["nodes"], min(size, whole - first), ALIGN if whole > size else height(whole), [(p["left"], p["right"]) for p in r["path"]], r["context"])
                    continue
                nodes, n, levels, above, context = now
                found.append(out(r, siblings(nodes, r["i"] % size, n, levels) + above, context))
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return head.unionByName(rest).repartition("tree", "g").sortWithinPartitions("tree", "g", "i").mapInArrow(walk, schema)


def _paths_to_items(logs: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Paths of the builders of round 0 (p_tree, p_i = g, path, context), from those of the roots (tree, path, context)."""
    size = ARITY**ALIGN
    schema = f"p_tree string, p_i long, path {PATH}, context string"

    def as_path(r: dict, path: list[tuple[str, str]], context: str) -> dict:
        return {"p_tree": r["tree"], "p_i": r["i"], "path": [{"left": a, "right": b} for a, b in path], "context": context}

    paths = None
    for k in range(len(logs) - 1, -1, -1):
        own = logs[k].filter(F.col("n") <= size).select(F.col("tree").alias("p_tree"), F.col("g").alias("p_i")).join(
            tops, F.col("p_tree").eqNullSafe(F.col("tree"))).select("p_tree", "p_i", "path", "context")
        paths = own if paths is None else paths.unionByName(own)
        if k:
            units = logs[k - 1].filter(F.col("n") > size).select(
                "tree", F.floor(F.col("g") / size).alias("g"), F.col("g").alias("i"), F.lit(None).cast("string").alias("payload"))
            paths = materialize(_down(units, logs[k], paths, as_path, schema), "merkle-paths")
    return paths


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified and ``log_position`` of every row of ``docs``.

    ``tampered`` is the text that the check sees instead of the row's own; the proof stays the original one.
    """
    ship(docs.sparkSession)
    text = F.col("text").cast("string")
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("tree"),
                         leaf_digest(text).alias("digest"), leaf_digest(text if tampered is None else tampered).alias("seen"))
    leaves = materialize(numbered(leaves, "tree", ["doc_id", "digest"]), "merkle-leaves")
    subroots, logs = build(leaves.select("tree", "i", "digest", "n"))
    # over the sources: one tree whose items are the subroots
    named = subroots.select(F.lit("").alias("all"), F.col("tree").alias("source"), F.col("root").alias("digest"))
    named = materialize(numbered(named, "all", ["source"]), "merkle-sources").withColumnRenamed("all", "tree")
    roots, top_logs = build(named.select("tree", "i", "digest", "n"))
    size = ARITY**ALIGN

    def as_top(r: dict, path: list[tuple[str, str]], context: str) -> dict:
        source, subroot = r["payload"][1:-HEX], r["payload"][-HEX:]
        return {"tree": source if r["payload"][0] == "+" else None, "path": [{"left": a, "right": b} for a, b in path], "context": subroot + context}

    whole = roots.select("tree", F.array().cast(PATH).alias("path"), F.col("root").alias("context"))
    payload = F.concat(F.when(F.col("source").isNull(), "-").otherwise("+"), F.coalesce("source", F.lit("")), "digest")
    tops = materialize(_down(named.select("tree", F.floor(F.col("i") / size).alias("g"), "i", payload.alias("payload")), top_logs[0],
                             _paths_to_items(top_logs, whole), as_top, f"tree string, path {PATH}, context string"), "merkle-tops")

    def as_proof(r: dict, path: list[tuple[str, str]], context: str) -> dict:
        doc, leaf, seen, n = r["payload"].split(",")
        folded, root = fold(seen, path), context[HEX:]
        n, i = int(n), r["i"]
        return {"doc_id": int(doc) if doc else None, "leaf": leaf, "subroot": context[:HEX], "root": root, "proof_sha256": digest(*[x for p in path for x in p]),
                "folded_root": folded, "verified": folded == root, "log_position": position(0, i, n)}

    payload = F.concat_ws(",", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", "seen", F.col("n").cast("string"))
    units = leaves.select("tree", F.floor(F.col("i") / size).alias("g"), "i", payload.alias("payload"))
    return _down(units, logs[0], _paths_to_items(logs, tops), as_proof,
                 "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, log_position long")


def without_line_ends(of: int = 2) -> Column:
    """The text that a check sees: without its line ends where ``of`` divides the row's crc32."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == 0
    text = F.col("text").cast("string")
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
