"""Benchmark decontamination by template canonicalisation.

Documents and benchmark items are rewritten as templates: numbers, names (runs of capitalised
words inside a sentence) and units after a number become typed placeholders, everything else is a
lower-case word. All windows of ``window`` template tokens are hashed; documents meet items by an
equi-join of the hashes. Items shorter than a window are matched as one window of their own length.

A re-parameterised question is the same template with other values. What stands in the slots must
then be exchanged consistently: within one alignment (place in the document minus place in the
item) each value of the item stands for one value of the document and each value of the document
for one of the item. Windows whose slots break that rule do not count.

Whether a capitalised word is a name depends on what stands before it, which may differ between an item
and its copy. Texts are therefore read in three ways, and each reading of a document meets the same
reading of an item: names inside sentences (``INSIDE``); no names, every word as it is (``LITERAL``),
for copies of any item in any context; and every run of capitalised words as a name whose value is
its last word (``ANYWHERE``), for other names at the start of sentences. The last two normalise white
space first. ``ANYWHERE`` counts only full windows of which at least half are words, as windows of
placeholders fit any list of names; items shorter than a window are left to the other two.

A document is contaminated by an item if one alignment of one reading has at least ``min_windows`` consistent
windows (or all windows of a shorter item).

Scale: each text is read once in each of the three ways and each word hashed once; one row per window is
made and at once reduced by the join to the few that hit. The benchmark's windows are broadcast up to a measured
number of rows, else both sides are shuffled by hash. Hits on windows that very many items or
documents share become counts per alignment before any text is read again, and slots are compared
within one alignment, whose size is that of the item.

Defined results: null and empty texts have no tokens and match nothing. Items without tokens match
nothing. Repeated rows of documents are judged alike (rows are told apart by a row key of doc_id
and text, so a repeated doc_id with different texts is judged by each text). Nulls in other
columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, materialize

# Private-use characters: end of a slot's value, and the three kinds of slots.
CLOSE, NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002", "\ue003"
MARKS = f"[{CLOSE}-{UNIT}]"
# Fixed list of units that may follow a number.
UNITS = (
    "kg|mg|g|km|cm|mm|m|mi|ft|in|l|ml|s|ms|min|h|hours|hour|minutes|minute|seconds|second|days|day|weeks|week|"
    "months|month|years|year|miles|mile|meters|metres|inches|feet|pounds|dollars|euros|cents|percent|degrees|"
    "kilograms|grams|liters|litres"
)
DIGIT = r"\p{Nd}"
NUMBER_TEXT = r"\p{Nd}+(?:[.,]\p{Nd}+)*"
NAME_RUN = r"([\p{Ll},;:]) (\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*)"
NUMBER_UNIT = rf"({NUMBER_TEXT}) ?({UNITS}|[%€$£])([^\p{{L}}\p{{Nd}}]|$)"
NUMBER_ONLY = rf"(^|[^{NUMBER}\p{{Nd}}.,])({NUMBER_TEXT})"
# The commonest letters first, as the rest of the class is slower to look up.
GAP = rf"[^a-z0-9\p{{L}}\p{{Nd}}{NAME}-{UNIT}]+"
VALUED = rf"[{NAME}-{UNIT}][^{CLOSE}]*{CLOSE}|[\p{{L}}\p{{Nd}}]+"
# Windows of the benchmark are broadcast up to this number of rows.
BROADCAST_WINDOWS = 1_000_000
WINDOW, MIN_WINDOWS = 8, 4
CAPITALS = r"(^|[^\p{L}\p{Nd}])(?:\p{Lu}\p{Ll}+ )*(\p{Lu}\p{Ll}+)(?![\p{L}\p{Nd}])"
BLANKS = r"[\s\p{Z}]+"
READINGS = INSIDE, LITERAL, ANYWHERE = 0, 1, 2
# What Spark runs in place of the patterns above; they find the same. Java goes one call deeper for each repeat of a group
# that may be given back, and a run of some 2,000 names or numbers overflows the stack of its task, which ends the executor.
# No run is ever matched in part, as nothing that may follow one also continues it, so its repeats are kept (``*+``).
NAMES_KEPT = NAME_RUN.replace(")*", ")*+")
NUMBER_KEPT = NUMBER_ONLY.replace(")*", ")*+")
# A number is tried from its first digit only, else a list of numbers without a unit is read again from each of them.
UNIT_KEPT = NUMBER_UNIT.replace(NUMBER_TEXT, r"\p{Nd}(?<!\p{Nd}[.,]?\p{Nd})\p{Nd}*+(?:[.,]\p{Nd}++)*+")
# Names before the last are taken while a whole name follows.
CAPITALS_KEPT = (
    r"(^|[^\p{L}\p{Nd}])(?:\p{Lu}\p{Ll}++ (?=\p{Lu}\p{Ll}++(?![\p{L}\p{Nd}])))*+(\p{Lu}\p{Ll}++)(?![\p{L}\p{Nd}])")


def _clean(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.when(text.rlike(MARKS), F.regexp_replace(text, MARKS, " ")).otherwise(text)


def _looks(clean: Column) -> tuple[Column, Column, Column]:
    """What the readings need of a clean text: itself, with normal white space, and whether it has a digit."""
    return clean, F.regexp_replace(clean, BLANKS, " "), clean.rlike(DIGIT)


def _marked(looks: tuple[Column, Column, Column], name: str, number: str, unit: str, reading: int) -> Column:
    text, spaced, digits = looks
    if reading == INSIDE:
        t = F.lower(F.regexp_replace(text, NAMES_KEPT, f"$1 {name} "))
    else:
        t = spaced
        t = F.lower(F.regexp_replace(t, CAPITALS_KEPT, f"$1 {name} ") if reading == ANYWHERE else t)
    numbered = F.regexp_replace(t, UNIT_KEPT, f" {number} {unit} $3")
    numbered = F.regexp_replace(numbered, NUMBER_KEPT, f"$1 {number.replace('$1', '$2')} ")
    # Most texts have no digit, which one look tells for every reading.
    return F.when(digits, numbered).otherwise(t)


def _template(looks: tuple[Column, Column, Column], reading: int) -> Column:
    return F.array_remove(F.split(_marked(looks, NAME, NUMBER, UNIT, reading), GAP), "")


def template_tokens(text: Column, reading: int = INSIDE) -> Column:
    """Words and placeholders of a text; an empty list for null."""
    return _template(_looks(_clean(text)), reading)


def valued_tokens(text: Column, reading: int = INSIDE) -> Column:
    """The same list with each placeholder followed by the value it stands for."""
    marked = _marked(_looks(_clean(text)), f"{NAME}$2{CLOSE}", f"{NUMBER}$1{CLOSE}", f"{UNIT}$2{CLOSE}", reading)
    return F.regexp_extract_all(marked, F.lit(VALUED), F.lit(0))


def word_hashes(words: Column) -> Column:
    """A number for each word; each is hashed once, however many windows it is in."""
    return F.transform(words, lambda w: F.xxhash64(w))


def window_places(numbers: Column, width: Column) -> Column:
    """A row for each window of ``width`` words: where it begins, from 0."""
    return F.explode(F.when(F.size(numbers) >= width, F.sequence(F.lit(0), F.size(numbers) - width)))


def window_hash(numbers: Column, place: Column, width: Column) -> Column:
    """The hash of one window from the words' numbers; taken row by row, not in a list of all windows."""
    return F.xxhash64(F.slice(numbers, place + 1, width))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(reading, item_key, width, item_pos, hash, total) of the windows of every different item text.

    ``total`` is the number of windows of the item's text, those that do not count included.
    """
    found = None
    for reading in READINGS:
        words = items.select(F.xxhash64("text").alias("item_key"), template_tokens(F.col("text"), reading).alias("words"))
        sized = words.where(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(window)))
        made = sized.select(
            F.lit(reading).alias("reading"), "item_key", "width", "words", (F.size("words") - F.col("width") + 1).alias("total"),
            window_places(F.col("words"), F.col("width")).alias("item_pos")
        ).withColumn("hash", window_hash(word_hashes(F.col("words")), F.col("item_pos"), F.col("width")))
        if reading == ANYWHERE:
            plain = F.size(F.filter(F.slice("words", F.col("item_pos") + 1, F.col("width")), lambda w: ~w.rlike(f"^[{NAME}-{UNIT}]")))
            made = made.where((F.col("width") == window) & (2 * plain >= window))
        made = made.drop("words").distinct()
        found = made if found is None else found.unionByName(made)
    return found


def _kind(word: Column) -> Column:
    """A valued token without its value."""
    return F.when(word.rlike(f"^[{NAME}-{UNIT}]"), F.substring(word, 1, 1)).otherwise(word)


def _bound(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _consistent_places() -> Column:
    """Places of an alignment whose windows hold no token that breaks the exchange of values."""
    at = lambda j: F.struct(
        j.alias("j"), F.element_at("item_words", j + 1).alias("i"),
        F.try_element_at("doc_words", j + F.col("align") + 1).alias("d"))
    # Each place covers the ``width`` tokens from it on.
    covered = F.filter(
        F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("width") - 1)))),
        lambda j: j < F.size("item_words"))

    def sound(facing: Column) -> Column:
        slots = F.filter(facing, lambda x: x["i"].rlike(f"^[{NAME}-{UNIT}]"))
        # A pair of values that stands for itself alone breaks nothing, so different pairs are compared only.
        pairs = F.array_distinct(F.transform(slots, lambda x: F.struct(x["i"].alias("i"), x["d"].alias("d"))))
        clash = _bound(pairs, lambda given: F.filter(given, lambda x: F.exists(given, lambda y: (x["i"] == y["i"]) != (x["d"] == y["d"]))))
        # Guards against equal hashes of different windows.
        other = F.filter(facing, lambda x: ~F.coalesce(_kind(x["i"]) == _kind(x["d"]), F.lit(False)))
        broken = _bound(clash, lambda wrong: F.filter(slots, lambda x: F.exists(wrong, lambda y: (x["i"] == y["i"]) & x["d"].eqNullSafe(y["d"]))))
        return _bound(
            F.transform(F.concat(broken, other), lambda x: x["j"]),
            lambda bad: F.filter("places", lambda p: ~F.exists(bad, lambda j: (p <= j) & (j < p + F.col("width")))))

    return _bound(F.transform(covered, at), sound)


def find_leaks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, min_windows: int = MIN_WINDOWS,
) -> DataFrame:
    """Rows (doc_id, text_key, item_id, n_windows, n_consistent): the best alignment of each
    document text with each item that contaminates it. ``text_key`` is the hash of the text.
    """
    known = materialize(item_windows(items, window), "windows")
    # At most three times ``window`` pairs of numbers.
    kinds = sorted(map(tuple, known.select("reading", "width").distinct().collect()))
    lookup = F.broadcast(known) if known.count() <= BROADCAST_WINDOWS else known
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    kinds = kinds or [(INSIDE, window)]
    # Each text is read once in each way; its words then give the windows of every width.
    # Columns of their own, as Spark would look again for each reading.
    looks = ("clean", "spaced", "digits")
    looked = keyed.select("doc_id", "text_key", _clean(F.col("text")).alias("clean")).select(
        "doc_id", "text_key", *(c.alias(n) for c, n in zip(_looks(F.col("clean")), looks, strict=True)))
    read = looked.select("doc_id", "text_key", *[
        word_hashes(_template(tuple(map(F.col, looks)), r)).alias(f"numbers_{r}") for r in sorted({r for r, _ in kinds})])
    each = read.select("doc_id", "text_key", F.explode(F.array(*[
        F.struct(F.lit(r).alias("reading"), F.lit(w).alias("width"), F.col(f"numbers_{r}").alias("numbers")) for r, w in kinds])).alias("k"))
    spread = each.select("doc_id", "text_key", "k.*").select(
        "*", window_places(F.col("numbers"), F.col("width")).alias("pos")
    ).withColumn("hash", window_hash(F.col("numbers"), F.col("pos"), F.col("width"))).drop("numbers")
    # One number as the key is looked up faster than three columns; reading and width are compared where it hits.
    hits = spread.withColumnsRenamed({"reading": "own_reading", "width": "own_width"}).join(
        lookup, (spread["hash"] == lookup["hash"]) & (F.col("own_reading") - F.col("reading") == 0) & (F.col("own_width") - F.col("width") == 0)).select(
        "reading", "doc_id", "text_key", "item_key", "width", "item_pos", (F.col("pos") - F.col("item_pos")).alias("align"))
    need = known.select("reading", "item_key", F.least("total", F.lit(min_windows)).alias("need")).distinct()
    aligned = materialize(
        hits.groupBy("reading", "doc_id", "text_key", "item_key", "width", "align")
        .agg(F.collect_set("item_pos").alias("places"))
        .join(need, ["reading", "item_key"]).where(F.size("places") >= F.col("need")), "aligned")
    suspects = aligned.select(F.col("doc_id").alias("s_id"), F.col("text_key").alias("s_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("text_key") == F.col("s_key"))
    valued = F.explode(F.array(*(
        F.struct(F.lit(r).alias("r"), valued_tokens(F.col("text"), r).alias("words")) for r in READINGS)))
    texts = (
        keyed.join(suspects, same, "left_semi").dropDuplicates(["doc_id", "text_key"])
        .select(F.col("doc_id").alias("s_id"), F.col("text_key").alias("s_key"), valued.alias("v"))
        .select("s_id", "s_key", F.col("v.r").alias("s_reading"), F.col("v.words").alias("doc_words")))
    item_texts = items.select(F.xxhash64("text").alias("item_key"), valued.alias("v")).select(
        "item_key", F.col("v.r").alias("reading"), F.col("v.words").alias("item_words")).dropDuplicates(["item_key", "reading"])
    names = items.select(F.xxhash64("text").alias("item_key"), "item_id").distinct()
    return (
        aligned.join(texts, same & (F.col("reading") == F.col("s_reading")))
        .join(item_texts, ["item_key", "reading"])
        .select("reading", "doc_id", "text_key", "item_key", "need", F.size("places").alias("n_windows"),
                F.size(_consistent_places()).alias("n_consistent"))
        .where(F.col("n_consistent") >= F.col("need"))
        .join(names, "item_key")
        .groupBy("doc_id", "text_key", "item_id")
        # The first reading that finds the item gives the counts.
        .agg(F.max(F.struct((-F.col("reading")).alias("first"), "n_consistent", "n_windows")).alias("best"))
        .select("doc_id", "text_key", "item_id", "best.n_windows", "best.n_consistent")
    )


def drop_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text is contaminated by any item; columns as they were."""
    of_id, of_key = fresh(docs, "leak_id"), fresh(docs, "leak_key")
    found = find_leaks(docs, items, **options).select(
        F.col("doc_id").alias(of_id), F.col("text_key").alias(of_key)).distinct()
    return docs.join(
        found, F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.xxhash64("text") == F.col(of_key)), "left_anti")
