"""Benchmark decontamination by templates. DataFrame functions only.

Documents and benchmark items are turned into templates: names, numbers, and units after a number become typed
placeholders, everything else lower-case words. What is a name cannot be told from a capital alone, so each text has a
template in three forms, and each form of an item is looked for in the same form of the documents:

* ``INSIDE``: runs of capitalised words inside a sentence are names;
* ``ANYWHERE``: so are those at the start of a text or sentence, and after a bracket, quote or digit;
* ``PLAIN``: none are, and case counts for nothing, so that a title-cased or lower-case copy is found.

An item of which placeholders make up more than half in the form ``ANYWHERE`` (a title-cased one) is not looked for in it.
Windows of placeholders alone say nothing, so they neither count nor join, and an item is looked for only in forms in which
at least half of its windows hold a word. An item that no such form is left for (a row of numbers, say) is looked for as it
stands, in a fourth form without placeholders, ``VERBATIM``; documents are read in the forms that some item needs.

Windows of five template words are hashed and joined by
hash. A document is contaminated by an item if, in one form, it has at least 0.8 of the item's distinct windows along alignments
whose slots are consistent: along one alignment (document position minus item position) each value in an item's slot
must always meet the same value in the document. Only slots inside windows that matched on that alignment count, and
values are compared within their kind, so places that do not match are no evidence against those that do. So a question with other numbers and names is found, and a chance
likeness of templates with mixed-up values is not.

The benchmark's windows are broadcast where their count is at most ``BROADCAST`` (about 50 MB), else joined by a shuffle.

Defined cases: null or empty texts and items, and items under five words, match nothing; rows that share a key are judged
as one document, null keys too; an item's id may be null or of any type that can be ordered, a null id comes before others in ties; texts that share an id are
looked for one by one;
without items nothing is contaminated; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.llm.common import staged

WINDOW = 5
SIMILAR = 0.8
BROADCAST = 1_000_000
# Placeholders are private-use characters; units that may follow a number.
NUMBER, UNIT, NAME = "", "", ""
UNITS = "%|°C|°F|km|cm|mm|kg|mg|g|lb|oz|ml|l|m|s|ms|min|h|hours?|minutes?|seconds?|days?|weeks?|months?|years?|miles?|feet|inches|dollars?|euros?|meters?|metres?|liters?|litres?|grams?"
# Loops are possessive: Java goes through the others by recursion, and long runs of names or numbers overflow its stack.
IS_NAME = r"(?<=[\p{Ll},;]\s)\p{Lu}\p{L}*+(?:\s\p{Lu}\p{L}*+)*+"
IS_CAPITALISED = r"(?<![\p{L}\p{M}\p{N}°])\p{Lu}\p{L}*+(?:\s\p{Lu}\p{L}*+)*+"
IS_UNIT = rf"(?<=\p{{N}}\s?)(?:{UNITS})(?![\p{{L}}\p{{N}}])"
IS_NUMBER = r"\p{N}++(?:[.,:/]\p{N}++)*+"
WORD = rf"[\p{{L}}\p{{M}}\p{{N}}]+|[{NUMBER}{UNIT}{NAME}]"
INSIDE, ANYWHERE, PLAIN, VERBATIM = 0, 1, 2, 3
NAMES = {INSIDE: IS_NAME, ANYWHERE: IS_CAPITALISED}
FORMS = (INSIDE, ANYWHERE, PLAIN)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: the optimiser does not copy it to each place that reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def cased(text: Column, form: int) -> Column:
    return F.lower(text) if form in (PLAIN, VERBATIM) else text


def unit(form: int) -> str:
    return f"(?i:{IS_UNIT})" if form == PLAIN else IS_UNIT


def template(text: Column, form: int) -> Column:
    def numbered(named: Column) -> Column:
        units = F.regexp_replace(named, unit(form), f" {UNIT} ")
        return F.when(named.rlike(r"\p{N}"), F.regexp_replace(units, IS_NUMBER, f" {NUMBER} ")).otherwise(named)

    if form == VERBATIM:
        return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    named = F.regexp_replace(text, NAMES[form], NAME) if form in NAMES else cased(text, form)
    return F.regexp_extract_all(F.lower(once(named, numbered)), F.lit(WORD), F.lit(0))


def filler(word: Column) -> Column:
    return word.isin(NUMBER, UNIT, NAME)


def windows(words: Column, form: int, told: bool = False) -> Column:
    """Hash of the window at each position, another one in each form; with ``told``, null for windows without a word."""
    def at(word: Column, i: Column) -> Column:
        hashed = F.xxhash64(F.lit(form), word, *(F.get(words, i + k) for k in range(1, WINDOW)))
        return F.when(~reduce(Column.__and__, (filler(F.get(words, i + k)) for k in range(WINDOW))), hashed) if told else hashed

    return F.when(F.size(words) >= WINDOW, F.transform(F.slice(words, 1, F.size(words) - (WINDOW - 1)), at))


def hashed(df: DataFrame, key: str, name: str, forms: Iterable[int], told: bool = False) -> DataFrame:
    """One row per text and form: name, form, hash (of each window)."""
    each = [F.struct(F.lit(form).alias("form"), once(template(F.col("text"), form), lambda words, form=form: windows(words, form, told)).alias("hash")) for form in forms]
    return df.select(F.col(key).alias(name), F.explode(F.array(*each)).alias("each")).select(name, "each.form", "each.hash")


def telling(words: Column) -> Column:
    """Whether at least half of a template are words."""
    return 2 * F.size(F.filter(words, filler)) <= F.size(words)


def slots(df: DataFrame, key: str, name: str) -> DataFrame:
    """Form, position, kind and value of every placeholder: the values are the same spans, in the same order."""
    def of(form: int) -> Column:
        places = F.transform(template(F.col("text"), form), lambda w, i: F.when(w.isin(NUMBER, UNIT, NAME), F.struct(i.alias("at"), w.alias("kind"))))
        places = F.filter(places, lambda i: i.isNotNull())
        spans = "|".join([*([NAMES[form]] if form in NAMES else []), unit(form), IS_NUMBER])
        values = F.regexp_extract_all(cased(F.col("text"), form), F.lit(spans), F.lit(0))
        return F.arrays_zip(places.alias("place"), values.alias("value"))

    forms = df.select(F.col(key).alias(name), F.posexplode(F.array(*(of(form) for form in FORMS))).alias("form", "slots"))
    pairs = forms.select(name, "form", F.explode("slots").alias("slot"))
    return pairs.select(name, "form", F.col("slot.place.at").alias("place"), F.col("slot.place.kind").alias("kind"), F.lower("slot.value").alias("value"))


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Windows that a document and an item share: doc, item, form, at (position in the item), shift, wanted (windows of the item)."""
    asked = items.filter("text IS NOT NULL").withColumn("telling", telling(template(F.col("text"), ANYWHERE)))
    own = hashed(asked.filter("telling"), "item_id", "item", FORMS, True).union(hashed(asked.filter("NOT telling"), "item_id", "item", (INSIDE, PLAIN), True))
    own = own.filter("hash IS NOT NULL").withColumn("told", 2 * F.size(F.array_compact("hash")) >= F.size("hash"))
    untold = own.groupBy("item").agg(F.bool_or("told").alias("any")).filter("NOT any").select(F.col("item").alias("_item"))
    verbatim = hashed(asked, "item_id", "item", [VERBATIM]).filter("hash IS NOT NULL")
    verbatim = verbatim.join(untold, F.col("item").eqNullSafe(F.col("_item")), "left_semi")
    own = own.filter("told").drop("told").union(verbatim)
    wanted = own.withColumn("wanted", F.size(F.array_distinct(F.array_compact("hash"))))
    index = wanted.select("item", "form", "wanted", F.posexplode("hash").alias("at", "hash")).filter("hash IS NOT NULL")
    # A window that an item repeats is looked for once, or an item and a text of one repeated window would meet in all pairs.
    index = staged(index.groupBy("item", "form", "wanted", "hash").agg(F.min("at").alias("at")), "benchmark")
    forms = [r["form"] for r in index.select("form").distinct().orderBy("form").collect()]
    found = hashed(docs, "doc_id", "doc", forms or FORMS).select("doc", F.posexplode("hash").alias("place", "hash"))
    index = F.broadcast(index) if index.count() <= BROADCAST else index
    return found.join(index, "hash").select("doc", "item", "form", "wanted", "hash", "at", (F.col("place") - F.col("at")).alias("shift"))


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs of a contaminated document and an item: doc, item, similarity (share of the item's windows, in the best form)."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.struct(F.col("item_id").alias("id"), F.xxhash64("text").alias("of")).alias("item_id"), "text")
    met = staged(matches(docs, items), "matches")
    share = F.count_distinct("hash") / F.first("wanted")
    likely = met.groupBy("doc", "item", "form").agg(share.alias("similarity")).filter(F.col("similarity") >= SIMILAR)
    likely = staged(likely.select("doc", "item", "form"), "likely")
    lines = met.join(likely, on(met, likely, "doc", "item", "form"), "left_semi")
    lines = lines.groupBy("doc", "item", "form", "shift").agg(F.max("wanted").alias("wanted"), F.collect_set("hash").alias("hashes"), F.collect_set("at").alias("ats"))
    lines = staged(lines, "alignments")
    some = likely.select(F.col("doc").alias("_doc")).distinct()
    texts = docs.join(some, docs["doc_id"].eqNullSafe(some["_doc"]), "left_semi")
    here = slots(texts, "doc_id", "doc")
    there = slots(items, "item_id", "item")
    there = there.select(F.col("item").alias("_item"), F.col("form").alias("_form"), F.col("place").alias("_place"), "kind", F.col("value").alias("asked"))
    aligned = lines.join(there, F.col("item").eqNullSafe(F.col("_item")) & (F.col("form") == F.col("_form")))
    aligned = aligned.filter(F.exists("ats", lambda at: (F.col("_place") >= at) & (F.col("_place") < at + WINDOW)))
    aligned = aligned.select("doc", "item", "form", "shift", "kind", "asked", (F.col("_place") + F.col("shift")).alias("place"))
    here = here.select(F.col("doc").alias("_doc"), F.col("form").alias("_form"), F.col("place").alias("_place"), F.col("kind").alias("_kind"), "value")
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("form") == F.col("_form")) & (F.col("place") == F.col("_place"))
    pairs = aligned.join(here, same & (F.col("kind") == F.col("_kind")))
    mixed = pairs.groupBy("doc", "item", "form", "shift", "kind", "asked").agg(F.count_distinct("value").alias("answers")).filter("answers > 1")
    clean = lines.join(mixed, on(lines, mixed, "doc", "item", "form", "shift"), "left_anti")
    found = clean.select("doc", "item", "form", "wanted", F.explode("hashes").alias("hash"))
    found = found.groupBy("doc", "item", "form").agg(share.alias("similarity")).filter(F.col("similarity") >= SIMILAR)
    return found.groupBy("doc", F.col("item.id").alias("item")).agg(F.max("similarity").alias("similarity"))


def on(left: DataFrame, right: DataFrame, *names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def judged(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, contaminated, similarity and item of the best leak (ties: the smallest item)."""
    best = leaks(docs, items, key, text).groupBy("doc").agg(F.min(F.struct((-F.col("similarity")).alias("least"), "item")).alias("best"))
    best = best.select("doc", (-F.col("best.least")).alias("similarity"), "best.item")
    keys = docs.select(F.col(key).alias("key"))
    found = keys.join(best, keys["key"].eqNullSafe(best["doc"]), "left")
    return found.select("key", F.col("similarity").isNotNull().alias("contaminated"), "item", "similarity")


def drop_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that no item contaminates."""
    bad = leaks(docs, items, key, text).select(F.col("doc").alias("_bad")).distinct()
    names = docs.columns
    held = docs.select(F.struct(*names).alias("row"), F.col(key).alias("_key"))
    return held.join(bad, F.col("_key").eqNullSafe(F.col("_bad")), "left_anti").select("row.*")
