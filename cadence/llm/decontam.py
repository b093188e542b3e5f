"""Benchmark decontamination by template canonicalisation, in DataFrame expressions only.

Texts become token templates: numbers, names (capitalised words inside a sentence) and units after a
number are replaced by typed placeholders, all other words are lower-cased. Windows of ``WINDOW``
template tokens are hashed and joined with those of the benchmark items. Matches of a document and
an item are grouped by their shift (place in the document less place in the item), then checked
against the texts: the templates must be equal, not only their hashes, and the slots must be
consistent — one value of the item must have become one value of the document wherever it
occurs. A question with other numbers or names keeps its template and passes. A window with every
value unchanged is always sound; one with changed values is, unless it holds an item value that became
several in its shift. Sound windows count, whatever became of the others.

An item's first word has nothing before it that could mark it as a name or a unit; in a document it has.
Its windows are looked for in each form, and the word itself must be equal.

Windows mostly of placeholders are hashed and compared with their values: they match only if every
value is unchanged. A document leaks an item if sound windows are at least ``LEAST`` of the item's
windows, or of those that aren't mostly placeholders (all, of an item with fewer). An item shorter than
WINDOW tokens is one window of its own length; one of fewer than ``SHORTEST`` tokens is never looked for.

The benchmark's windows, and the keys of suspect documents, are broadcast only after their number was
measured; beyond ``BROADCAST_WINDOWS`` rows both sides are shuffled.

Defined cases: a null text is empty and leaks nothing, a null doc_id or item_id is reported as null,
rows equal in doc_id and text are reported once, empty tables give no row, other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import materialize, row_key

WINDOW, LEAST, SHORTEST = 8, 6, 4
BROADCAST_WINDOWS = 300_000

# Private characters that mark a token's type; POINT joins the parts of one number.
NUMBER, NAME, UNIT, POINT = "", "", "", ""
UNITS = ("mm|cm|km|m|mg|g|kg|t|ml|l|s|ms|min|h|hz|khz|mhz|ghz|w|kw|v|a|j|kj|n|pa|bar|kb|mb|gb|tb|px|mph|kmh|"
         "inch|inches|foot|feet|yard|yards|mile|miles|meter|meters|metre|metres|kilometer|kilometers|kilometre|kilometres|"
         "gram|grams|kilogram|kilograms|liter|liters|litre|litres|second|seconds|minute|minutes|hour|hours|day|days|week|weeks|"
         "month|months|year|years|dollar|dollars|euro|euros|cent|cents|percent|degree|degrees")


def tokens(text: Column) -> Column:
    """Words of a text, slots with the mark of their type in front."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    numbers = F.regexp_replace(F.regexp_replace(text, r"([0-9])[.,](?=[0-9])", "$1" + POINT), rf"[0-9][0-9{POINT}]*", NUMBER + "$0")
    units = F.regexp_replace(numbers, rf"({NUMBER}[0-9{POINT}]+)[ -]?({UNITS})\b", f"$1 {UNIT}$2")
    named = F.regexp_replace(F.when(text.rlike("[0-9]"), units).otherwise(text), r"([\p{Ll},;][\s\p{Z}]+)(?=\p{Lu})", "$1" + NAME)
    return F.filter(F.split(named, rf"[^\p{{L}}\p{{N}}{NUMBER}-{POINT}]+"), lambda t: t != "")


def is_slot(token: Column) -> Column:
    return token.substr(1, 1).isin(NUMBER, NAME, UNIT)


def template(token: Column) -> Column:
    return F.when(is_slot(token), token.substr(1, 1)).otherwise(F.lower(token))


def value(token: Column) -> Column:
    return F.lower(token.substr(2, 2**31 - 1))


def bare(token: Column) -> Column:
    return F.when(is_slot(token), value(token)).otherwise(F.lower(token))


def first_forms(token: Column) -> Column:
    """An item's first token as it is and as what precedes it in a document may mark it: as a name or a unit."""
    forms = F.array(token, F.when(token.rlike(r"^\p{Lu}"), F.concat(F.lit(NAME), token)), F.when(token.rlike(f"^({UNITS})$"), F.concat(F.lit(UNIT), token)))
    return F.filter(forms, lambda t: t.isNotNull())


def once(column: Column, then) -> Column:
    """``then(column)`` with the column computed once, though ``then`` uses it for every element."""
    return F.transform(F.array(column), then)[0]


def hashes(tokens: Column, exact: bool) -> Column:
    """Of each token: a hash of its template; if ``exact``, that as ``t``, ``v``, one with its value, and whether it is a slot."""
    both = lambda t: F.struct(F.xxhash64(template(t)).alias("t"), F.xxhash64(F.lower(t)).alias("v"), is_slot(t).alias("slot"))
    return F.transform(tokens, both if exact else lambda t: F.xxhash64(template(t)))


def mostly_slots(window: Column) -> Column:
    return 2 * F.size(F.array_remove(window["slot"], F.lit(False))) > F.size(window)


def window_hash(window: Column, exact: bool) -> Column:
    """The templates' hash; of a window mostly of slots, if ``exact``, one with the values."""
    return F.when(mostly_slots(window), F.xxhash64(F.lit("exact"), window["v"])).otherwise(F.xxhash64(window["t"])) if exact else F.xxhash64(window)


def window_hashes(text: Column, size: int, exact: bool) -> Column:
    """A hash of each run of ``size`` tokens, in order."""
    return once(hashes(tokens(text), exact), lambda a: F.when(F.size(a) >= size, F.transform(
        F.sequence(F.lit(1), F.size(a) - size + 1), lambda i: window_hash(F.slice(a, i, size), exact))))


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, item_key, size, at (0-based), free (other values may stand in it), exact (hashed with its values), hash,
    windows and free_windows (of the item) of every window; the first one in each form."""
    rows = items.select("item_id", F.xxhash64("item_id", "text").alias("item_key"), "text").dropDuplicates(["item_key"])
    told = rows.withColumn("tokens", tokens(F.col("text"))).withColumn("size", F.least(F.size("tokens"), F.lit(WINDOW))).filter(F.col("size") >= SHORTEST)
    placed = told.select("item_id", "item_key", "size", "tokens", F.explode(F.sequence(F.lit(0), F.size("tokens") - F.col("size"))).alias("at"))
    own, rest = F.slice("tokens", F.col("at") + 1, F.col("size")), F.slice("tokens", F.col("at") + 2, F.col("size") - 1)
    forms = F.when(F.col("at") == 0, first_forms(F.col("tokens")[0])).otherwise(F.slice("tokens", F.col("at") + 1, 1))
    formed = placed.select("item_id", "item_key", "size", "at", (~mostly_slots(hashes(own, True))).alias("free"),
                           F.explode(F.transform(forms, lambda t: hashes(F.concat(F.array(t), rest), True))).alias("own"))
    hashed = formed.select("item_id", "item_key", "size", "at", "free", mostly_slots(F.col("own")).alias("exact"), window_hash(F.col("own"), True).alias("hash"))
    n = hashed.groupBy("item_key").agg(F.count_distinct("at").alias("windows"), F.count_distinct(F.when(F.col("free"), F.col("at"))).alias("free_windows"))
    return hashed.join(n, "item_key")


def measured(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (a few numbers each) as a written table, broadcast if it is small; else joins shuffle."""
    rows = materialize(rows, name)
    return F.broadcast(rows) if rows.count() <= BROADCAST_WINDOWS else rows


def leaks(docs: DataFrame, items: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, item_id, matched, windows, slots, changed (slots with another value), row_key: one row per leak."""
    docs = docs.select("doc_id", "text")
    windows = materialize(item_windows(items), "item-windows")
    sizes = sorted(windows.groupBy("size").agg(F.max("exact")).collect())  # at most WINDOW rows
    small = windows.count() <= BROADCAST_WINDOWS
    wanted = windows.select("hash", "size", "item_key", "at", "free", "windows", "free_windows")
    wanted = F.broadcast(wanted) if small else wanted
    met = None
    for size, exact in sizes or [(WINDOW, False)]:
        # the key is taken before the windows are dealt out, once per text
        here = docs.select(row_key().alias("row_key"), "text").select("row_key", F.posexplode(window_hashes(F.col("text"), size, exact)).alias("place", "hash"))
        own = here.join(wanted.filter(F.col("size") == size), "hash").select("row_key", "item_key", "size", "windows", "free_windows", "at", "free", (F.col("place") - F.col("at")).alias("shift"))
        met = own if met is None else met.unionByName(own)
    met = materialize(met, "window-matches")

    def covers(all_found: Column, free_found: Column) -> Column:
        free, every = (F.least(F.lit(least), F.col(c)) for c in ("free_windows", "windows"))
        return ((free_found >= free) & (free > 0)) | (all_found >= every)

    aligned = met.groupBy("row_key", "item_key", "size", "windows", "free_windows", "shift").agg(F.collect_set(F.struct("at", "free")).alias("places"))
    ats = met.select("row_key", "item_key", "windows", "free_windows", "at", "free").distinct().groupBy("row_key", "item_key", "windows", "free_windows").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("free").alias("free_n"))
    enough = ats.filter(covers(F.col("n"), F.col("free_n")))
    enough = measured(enough.select("row_key", "item_key"), "leak-pairs")
    aligned = aligned.join(enough, ["row_key", "item_key"])
    suspects = measured(enough.select("row_key").distinct(), "leak-rows")  # few: the other texts stay where they are
    texts = docs.select("doc_id", row_key().alias("row_key"), "text").join(suspects, "row_key").dropDuplicates(["row_key"])
    texts = texts.select("row_key", "doc_id", tokens(F.col("text")).alias("doc_tokens"))
    asked = items.select("item_id", F.xxhash64("item_id", "text").alias("item_key"), "text").dropDuplicates(["item_key"])
    asked = asked.select("item_key", "item_id", tokens(F.col("text")).alias("item_tokens"))
    both = aligned.join(texts, "row_key").join(asked, "item_key")
    item_token = lambda k: F.col("item_tokens")[k]
    doc_token = lambda k: F.col("doc_tokens")[k + F.col("shift")]
    own = lambda at: F.sequence(at, at + F.col("size") - 1)
    covered = lambda places: F.array_distinct(F.flatten(F.transform(places, lambda p: own(p["at"]))))
    slots = lambda places: F.filter(covered(places), lambda k: is_slot(item_token(k)))
    named = lambda k: F.concat(template(item_token(k)), value(item_token(k)))
    same = lambda k: F.coalesce(
        (template(item_token(k)) == template(doc_token(k))) | ((k == 0) & (bare(item_token(k)) == bare(doc_token(k)))), F.lit(False))
    kept = lambda k: ~is_slot(item_token(k)) | (value(item_token(k)) == value(doc_token(k)))
    alike = F.filter("places", lambda p: F.forall(own(p["at"]), same))
    pairs = lambda places: F.array_sort(F.array_distinct(F.transform(slots(places), lambda k: F.struct(named(k).alias("item"), value(doc_token(k)).alias("doc")))))
    torn = lambda places: once(pairs(places), lambda a: F.transform(F.filter(a, lambda p, i: F.get(a, i - 1)["item"] == p["item"]), lambda p: p["item"]))
    sound = once(alike, lambda places: once(torn(places), lambda t: F.filter(places, lambda p: (
        F.forall(own(p["at"]), kept) | (p["free"] & ~F.exists(own(p["at"]), lambda k: is_slot(item_token(k)) & F.array_contains(t, named(k))))))))
    checked = both.select("row_key", "doc_id", "item_key", "item_id", "windows", "free_windows", once(sound, lambda places: F.struct(
        places.alias("places"), F.size(slots(places)).alias("slots"), F.size(F.filter(slots(places), lambda k: ~kept(k))).alias("changed"))).alias("sound"))
    summed = checked.groupBy("row_key", "doc_id", "item_key", "item_id", "windows", "free_windows").agg(
        F.array_distinct(F.flatten(F.collect_list("sound.places"))).alias("places"),
        F.max("sound.slots").cast("long").alias("slots"), F.max("sound.changed").cast("long").alias("changed"))
    counted = summed.withColumn("matched", F.size("places").cast("long")).withColumn("free_matched", F.size(F.filter("places", lambda p: p["free"])))
    return counted.filter(covers(F.col("matched"), F.col("free_matched"))).select("doc_id", "item_id", "matched", "windows", "slots", "changed", "row_key")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents (with all their columns) that leak no item."""
    found = measured(leaks(docs, items).select(F.col("row_key").alias("_stage_leak")).distinct(), "leaks")
    return docs.join(found, row_key() == F.col("_stage_leak"), "left_anti")
