"""Personal data: base patterns as seeds, and bootstrapped contextual extraction for what they miss.

1. Base spans come from fixed patterns (email, ip, card, phone) over whole texts.
2. Every base span is a seed instance of its kind; every other identifier-like word (with a digit, an
   at sign or a spelled-out "[at]") is an unlabelled instance, and so is a run of digit groups of 6 to
   19 digits. The words around a mention are its lexical patterns.
3. Spark scores the graph of patterns and instances in rounds. A pattern's confidence for a kind
   is the summed score of its distinct instances of that kind over all its distinct instances (plus
   one), where unlabelled ones that fit the kind weigh only ``DOUBT`` each; a pattern counts with at least ``SUPPORT`` seeds' worth of score and ``CONFIDENCE``. An
   instance's score is one minus the product of its patterns' doubts. Instances that reach
   ``CONFIDENCE`` are labelled and support patterns in the next round.
4. Mentions of labelled instances under a pattern that counts become spans of that kind, where they
   don't overlap a base span. Base spans always stay.

Only texts with a candidate character reach Python. Instances, patterns and rounds are tables.

Defined cases: a null text is empty, no span gives an empty list, rows equal in doc_id and text get
equal spans, a null doc_id stays null, an empty table gives no row, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import materialize, row_key, ship

KINDS = ("email", "ip", "card", "phone")
ROUNDS, SUPPORT, CONFIDENCE, DOUBT = 4, 5, 0.8, 0.125
#: A text without any of these holds neither a base span nor a candidate.
CANDIDATE = r"[0-9@]|[\[({]at[\])}]"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_GROUPS = re.compile(r"(?<![\w+.@-])\(?[0-9]++(?:[ ().-]{1,3}[0-9]++)+(?![\w@])")
_WORD = re.compile(r"\S+")
_EDGES = ".,;:!?\"'()<>|*"
_IDENTIFIER = re.compile(r"[0-9@]|[\[({]at[\])}]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them, but each run of characters before an at sign is read once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(set(spans), key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


# --- mentions: instances in their contexts --------------------------------------------------------

def _shape(word: str) -> str:
    return re.sub("[0-9]+", "0", word.strip(_EDGES).lower())


def mentions(text: str) -> list[tuple[str | None, int, int, str, list[str]]]:
    """(kind or None, start, end, instance, patterns) of base spans and of other identifier-like words."""
    base = sorted(base_spans(text), key=lambda s: s[1])
    words = [m.span() for m in _WORD.finditer(text)]
    taken = [(a, b) for _, a, b in base]
    found: list[tuple[str | None, int, int]] = list(base)
    loose = [m.span() for m in _GROUPS.finditer(text) if " " in m[0] and 6 <= len(_digits(m[0])) <= 19]
    for a, b in words:
        if not _IDENTIFIER.search(text, a, b):
            continue
        while a < b and text[a] in _EDGES:
            a += 1
        while a < b and text[b - 1] in _EDGES:
            b -= 1
        loose.append((a, b))
    k = 0
    for a, b in sorted(loose):
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if 5 <= b - a <= 64 and not any(x < b and a < y for x, y in taken[max(0, k - 4) : k + 4]):
            found.append((None, a, b))
    out = []
    for kind, a, b in found:
        before = [_shape(w) for w in text[max(0, a - 80) : a].split()[-2:]]
        after = [_shape(w) for w in text[b : b + 40].split()[:1]]
        patterns = []
        if len(before) == 2:
            patterns.append(f"{before[0]} {before[1]} _")
        if before and after:
            patterns.append(f"{before[-1]} _ {after[0]}")
        if patterns:
            out.append((kind, a, b, re.sub(r"[\s().-]", "", text[a:b]).lower(), patterns))
    return out


def find_mentions(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    kinds = [pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
    names = ["row_key", "kind", "start", "end", "instance", "pattern"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(key, kind, a, z, value, p) for key, text in zip(b.column("row_key").to_pylist(), b.column("text").to_pylist())
                    for kind, a, z, value, patterns in mentions(text) for p in patterns]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    some = docs.filter(F.col("text").rlike(CANDIDATE)).select(row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    return some.mapInArrow(find, "row_key binary, kind string, start int, end int, instance string, pattern string")


# --- scoring the graph ----------------------------------------------------------------------------

def fits(kind: Column, instance: Column) -> Column:
    """Whether an instance could be of the kind at all, by its characters."""
    digits = F.length(F.regexp_replace(instance, "[^0-9]", ""))
    return (F.when(kind == "email", instance.rlike(r"@|[\[({]at[\])}]")).when(kind == "ip", digits >= 4)
             .when(kind == "card", digits >= 12).otherwise(digits.between(6, 15)))


def score_graph(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, support: float = SUPPORT, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Labelled instances (instance, kind, score) beyond the seeds, and patterns that count (pattern, kind, trust)."""
    labelled = seeds.select("instance", "kind", F.lit(1.0).alias("score"))
    suits = lambda k: F.count_if(fits(F.lit(k), F.col("instance")))
    sizes = materialize(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *(suits(k).alias(f"fit_{k}") for k in KINDS)), "pii-patterns")
    by_kind = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"hits_{k}").alias("hits"), (F.col(f"fit_{k}") - F.col(f"told_{k}")).alias("open")) for k in KINDS)))
    known, before = labelled, 0
    for _ in range(rounds):
        told = edges.join(known, "instance").groupBy("pattern").agg(
            *(F.sum(F.when(F.col("kind") == k, F.col("score"))).alias(f"hits_{k}") for k in KINDS), *(suits(k).alias(f"told_{k}") for k in KINDS))
        told = told.filter(F.greatest(*(f"hits_{k}" for k in KINDS)) >= support)
        hits = told.join(sizes, "pattern").select("pattern", "n", by_kind.alias("k")).select("pattern", "n", "k.*").filter(F.col("hits") >= support)
        trusted = materialize(hits.select("pattern", "kind", (F.col("hits") / (F.col("n") - (1 - DOUBT) * F.col("open") + 1)).alias("trust"))
                              .filter(F.col("trust") >= confidence), "pii-trusted")
        reached = edges.join(trusted, "pattern").filter(fits(F.col("kind"), F.col("instance")))
        scored = reached.groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999)))))).alias("score"))
        best = scored.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("best")).select("instance", "best.kind", "best.score")
        new = materialize(best.filter(F.col("score") >= confidence).join(seeds.select("instance").distinct(), "instance", "left_anti"), "pii-labelled")
        n = new.count()
        if n == before:
            break
        known, before = labelled.unionByName(new.select("instance", "kind", "score")), n
    return new, trusted


def discovered(docs: DataFrame) -> DataFrame | None:
    """row_key, found (array of kind, start, end) of the rows with spans beyond the base; None if no row has any."""
    told = materialize(find_mentions(docs), "pii-mentions")
    edges = materialize(told.select("pattern", "instance").distinct(), "pii-edges")
    # an instance that base patterns name by several kinds supports none
    seeds = materialize(told.filter("kind is not null").groupBy("instance").agg(F.min("kind").alias("kind"), F.max("kind").alias("other"))
                        .filter(F.col("kind") == F.col("other")).select("instance", "kind"), "pii-seeds")
    new, trusted = score_graph(edges, seeds)
    spans = (told.filter("kind is null").drop("kind").join(new.select("instance", "kind"), "instance")
                 .join(trusted.select("pattern", "kind"), ["pattern", "kind"]).select("row_key", "kind", "start", "end"))
    out = materialize(spans.groupBy("row_key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("found")), "pii-found")
    return out if out.limit(1).count() else None


# --- results --------------------------------------------------------------------------------------

def with_found(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_stage_found``, the spans beyond the base (null: none)."""
    found = discovered(docs.select("doc_id", "text"))
    if found is None:
        return docs.withColumn("_stage_found", F.lit(None).cast("array<struct<kind:string,start:int,end:int>>"))
    found = found.select(F.col("row_key").alias("_stage_key"), F.col("found").alias("_stage_found"))
    return docs.join(found, row_key() == F.col("_stage_key"), "left").drop("_stage_key")


def all_spans(text: str, found: list[dict] | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans; of those found, none inside another of its kind."""
    base = base_spans(text)
    own = [(f["kind"], f["start"], f["end"]) for f in found or ()]
    return base, base + [s for s in own if not any(o != s and o[0] == s[0] and o[1] <= s[1] and s[2] <= o[2] for o in own)]


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    ship(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for b in batches:
            rows = []
            for text, found in zip(b.column("text").to_pylist(), b.column("_stage_found").to_pylist()):
                if text is None:
                    rows.append((0, 0, 0, 0, nothing, ""))
                    continue
                base, spans = all_spans(text, found)
                rows.append((*(sum(s[0] == k for s in spans) for k in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, kinds))],
                                             ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    told = with_found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    some = F.when(F.col("text").rlike(CANDIDATE), F.col("text"))  # other texts needn't travel
    return told.select("doc_id", some.alias("text"), "_stage_found").mapInArrow(
        find, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span becomes its kind in brackets; spans that overlap become one, of the first one's kind."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, every span of personal data in ``text`` masked, ``n_chars`` counted again."""
    ship(docs.sparkSession)

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("_stage_some")
            texts = [None if t is None else masked(t, all_spans(t, f)[1]) for t, f in zip(b.column(at).to_pylist(), b.column("_stage_found").to_pylist())]
            yield b.set_column(at, "_stage_some", pa.array(texts, pa.string()))

    told = with_found(docs).withColumn("_stage_some", F.when(F.col("text").rlike(CANDIDATE), F.col("text").cast("string")))
    told = told.withColumn("text", F.when(F.col("_stage_some").isNull(), F.col("text")))  # a text travels once
    done = told.mapInArrow(cover, told.schema).withColumn("text", F.coalesce("_stage_some", "text")).drop("_stage_some", "_stage_found")
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done
