"""Benchmark decontamination over templates, in DataFrame functions only.

Numbers, units and names become typed placeholders, so a question that was asked again with other values
has the same template. Windows of five template words are hashed and joined with the windows of the
benchmark items. A document holds an item when it has at least `share` of the item's distinct windows and
the slots agree: within one alignment, equal values of the item stand for equal values of the document.
Template windows with fewer than three literal words prove nothing by themselves: they find no document, but
count where they stand in line with windows that do, so that an item is judged on all its windows.

Every text is read in three ways: names only inside sentences; every capitalised word but function words as
a name, wherever it stands and however the lines break; and plain lower-case words without placeholders.
An item is found by any reading of its own, windows of all readings of the document counting. The plain
reading keeps all windows, so copies that changed only case, punctuation or line breaks are found.

Texts are first looked through once, for anchors. Literal words that stand side by side in a template stand side
by side in the text too. So a proving window with three such words is anchored by them, and a document that
covers an item holds the anchors of as many of its windows. Documents that do are few; they alone are read in
all three ways, with the same result as if all were.

Defined results: null or empty text holds nothing, nor does an item without words get found. An
item shorter than a window is found only in documents that consist of it. Repeated rows are judged each
for itself, and an id is contaminated if one of its rows is; null ids are one id. Repeated items count
once per item_id. An empty benchmark or table gives no finding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.shared import broadcast_if_small, stored

WORDS = 5
LITERALS = 3
SHARE = 0.8
# Literal words of an anchor, and the kinds of anchors: a run of words, a single one, first and last of all.
RUN = 3
RUN_OF, WORD, ENDS = 0, 1, 2

# Placeholders: characters of the private-use area, one word each.
NAME, NUMBER, UNIT = "\ue001", "\ue002", "\ue003"
_UNITS = (
    "km|m|cm|mm|miles?|feet|ft|inch(?:es)?|kg|g|mg|grams?|pounds?|lbs?|tons?|litres?|liters?|l|ml|seconds?|minutes?|"
    "hours?|days?|weeks?|months?|years?|dollars?|euros?|cents?|degrees?|percent"
)
# Words that begin sentences without being names.
_FUNCTION_WORDS = (
    "A|After|All|An|And|Are|As|At|Be|Because|Before|Both|But|By|Can|Could|Did|Do|Does|During|Each|Every|For|From|Given|"
    "Had|Has|Have|He|Her|His|How|I|If|In|Is|It|Its|Let|May|My|No|Not|Of|On|Or|Our|She|Should|Since|So|Some|That|The|"
    "Their|Then|There|These|They|This|Those|To|Was|We|Were|What|When|Where|Which|While|Who|Whose|Why|Will|With|Would|"
    "You|Your"
)
# A capital inside a sentence begins a name, which goes on over further capitalised words.
# Repeated groups are possessive: Java runs those in a loop, others by recursion.
_NAME_PATTERN = r"\p{Lu}(?<=[\p{Ll}\p{Nd},;:] \p{Lu})[\p{L}'’-]*+(?: \p{Lu}[\p{L}'’-]*+)*+"
# The same wherever it stands: any capitalised words but function words.
_CAPITALISED = rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}'’-])(?!(?:{_FUNCTION_WORDS})(?![\p{{L}}'’-]))\p{{Lu}}[\p{{L}}'’-]*+"
_FREE_NAME_PATTERN = rf"{_CAPITALISED}(?: {_CAPITALISED})*+"
_NUMBER_PATTERN = r"[0-9]++(?:[.,:/][0-9]++)*+"
_UNIT_PATTERN = rf"(?<={NUMBER} {{1,2}})(?:{_UNITS})(?![\p{{L}}\p{{N}}])|%"


# Words whose ends a template may cut differently: capitals or units that run into marks or other digits.
_MARKS = r"[\p{M}\p{N}&&[^0-9]]"
_CUT_WORDS = r"\p{Lu}[\p{L}'’-]*+(?:\p{M}|(?![0-9])\p{N})|\p{M}\p{Lu}|[A-Za-z]\p{M}"

_ENTRIES = "array<struct<place:int,value:string>>"


# Readings of a text; items and documents are read in each of them.
INSIDE, FREE, PLAIN = 0, 1, 2
READINGS = (INSIDE, FREE, PLAIN)
_NAMES_OF = {INSIDE: _NAME_PATTERN, FREE: _FREE_NAME_PATTERN}


def _steps(text: Column, reading: int) -> list[Column]:
    """The text, then with names, numbers and units replaced in turn."""
    text = F.regexp_replace(text, r"\s+", " ") if reading == FREE else text
    named = F.regexp_replace(text, _NAMES_OF[reading], f" {NAME} ")
    numbered = F.regexp_replace(named, _NUMBER_PATTERN, f" {NUMBER} ")
    return [text, named, numbered, F.regexp_replace(numbered, _UNIT_PATTERN, f" {UNIT} ")]


def _words(replaced: Column) -> Column:
    plain = F.regexp_replace(F.lower(replaced), rf"[^\p{{L}}\p{{M}}\p{{N}}{NAME}{NUMBER}{UNIT}]+", " ")
    return F.filter(F.split(F.coalesce(F.trim(plain), F.lit("")), " ", -1), lambda w: w != "")


def _unmarked(text: Column) -> Column:
    return F.translate(text, NAME + NUMBER + UNIT, "   ")


def template_words(text: Column, reading: int = INSIDE) -> Column:
    """Lower-case words of the template; an empty array for null or empty text."""
    return _words(_unmarked(text) if reading == PLAIN else _steps(text, reading)[-1])


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(hashes: Column) -> Column:
    """Hashes of all windows of the hashed words in order; of the whole sequence where it is shorter."""
    many = F.greatest(F.size(hashes) - (WORDS - 1), F.lit(0))
    aligned = F.arrays_zip(*[F.slice(hashes, k + 1, many).alias(f"w{k}") for k in range(WORDS)])
    full = F.transform(aligned, lambda z: F.xxhash64(*[z.getField(f"w{k}") for k in range(WORDS)]))
    whole = F.when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))
    return F.when(F.size(hashes) >= WORDS, full).otherwise(whole)


def _places(words: Column, kind: str) -> Column:
    return F.filter(F.transform(words, lambda w, i: F.when(w == kind, i)), lambda i: i.isNotNull())


def _slots(words: Column, steps: Column, reading: Column) -> Column:
    """Place of each placeholder -> its value, lower-cased; nothing in the plain reading."""
    names = [F.when(reading == r, F.regexp_extract_all(steps[0], F.lit(p), F.lit(0))) for r, p in _NAMES_OF.items()]
    found = [F.coalesce(*names)]
    found += [F.when(reading != PLAIN, F.regexp_extract_all(steps[k], F.lit(p), F.lit(0))) for k, p in ((1, _NUMBER_PATTERN), (2, _UNIT_PATTERN))]
    entries = []
    for kind, matches in zip((NAME, NUMBER, UNIT), found, strict=True):
        places = _places(words, kind)
        values = F.transform(matches, lambda v: F.lower(v))
        # Stray placeholder characters in the text itself make the counts differ; such slots stay unknown.
        known = F.when(F.size(places) == F.size(values), F.arrays_zip(places, values))
        entries.append(F.coalesce(known.cast(_ENTRIES), F.array().cast(_ENTRIES)))
    return F.map_from_entries(F.concat(*entries))


def _is_literal(word: Column) -> Column:
    return ~word.isin(NAME, NUMBER, UNIT)


def _read(texts: DataFrame, *kept: str) -> DataFrame:
    """One row per text and reading: the kept columns, reading, words, their hashes and slots."""
    each = [F.struct(F.lit(r).alias("reading"), F.array(*_steps(F.col("text"), r)).alias("steps")) for r in _NAMES_OF]
    each.append(F.struct(F.lit(PLAIN).alias("reading"), F.array(_unmarked(F.col("text"))).alias("steps")))
    read = texts.select(*kept, F.inline(F.array(*each)))
    read = read.select(*kept, "reading", "steps", _words(F.element_at("steps", -1)).alias("words"))
    slots = _slots(F.col("words"), F.col("steps"), F.col("reading"))
    return read.select(*kept, "reading", "words", _hashes(F.col("words")).alias("hashes"), slots.alias("slots"))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, reading, window, place, its slots as (offset, value), whether it proves, and the reading's
    numbers of distinct windows and of proving ones."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL")
    items = _read(items, "item_id")
    rows = items.select("item_id", "reading", "words", "slots", F.posexplode(windows(F.col("hashes"))).alias("place", "window"))
    inside = F.slice("words", F.col("place") + 1, WORDS)
    literal = F.size(F.filter(inside, _is_literal))
    proves = (F.col("reading") == PLAIN) | (literal >= F.least(F.lit(LITERALS), F.size(inside)))
    offsets = F.filter(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda k: F.element_at("slots", F.col("place") + k).isNotNull())
    valued = F.transform(offsets, lambda k: F.struct(k.alias("offset"), F.element_at("slots", F.col("place") + k).alias("value")))
    rows = rows.select("item_id", "reading", "window", "place", valued.alias("slots"), proves.alias("proves"), inside.alias("words"))
    totals = rows.groupBy("item_id", "reading").agg(
        F.count_distinct("window").alias("total"), F.count_distinct(F.when(F.col("proves"), F.col("window"))).alias("proving")
    )
    return stored(rows.join(totals, ["item_id", "reading"]), "item-windows")


def _tokens(text: Column) -> Column:
    """Lower-case words of a text, cut where digits begin and end; an empty one may stand at either end."""
    return F.split(F.regexp_replace(F.lower(text), "[0-9]+", " $0 "), r"[^\p{L}\p{M}\p{N}]+", -1)


def _runs(hashes: Column) -> Column:
    """Hashes of all RUN neighbouring words."""
    runs = hashes
    for k in range(1, RUN):
        many = F.greatest(F.size(hashes) - k, F.lit(0))
        runs = F.zip_with(F.slice(runs, 1, many), F.slice(hashes, k + 1, many), lambda a, b: F.xxhash64(a, b))
    return runs


def _ends(hashes: Column) -> Column:
    """One key of the first and the last word; none without words."""
    key = F.xxhash64(F.lit("ends"), F.get(hashes, F.lit(0)), F.get(hashes, F.size(hashes) - 1))
    return F.when(F.size(hashes) > 0, F.array(key)).otherwise(F.array().cast("array<bigint>"))


def _anchors(known: DataFrame, share: float) -> DataFrame:
    """(key, kind, item_id, reading, weight, spare, total): what a document must hold to be read in all ways.

    A proving window is anchored by three literal words in a row, the run that the fewest items hold. An item
    of fewer words is anchored by its first and last. Other windows are spared: they count as held. Where
    they alone would cover the item, all its windows are anchored by their longest literal word instead.
    """
    proving = known.where("proves").select("item_id", "reading", "window", "proving", "words").dropDuplicates(["item_id", "reading", "window"])
    cut = F.flatten(F.transform("words", lambda w: F.filter(_tokens(w), lambda x: x != "")))
    proving = proving.withColumn("tokens", F.when(F.col("reading") == PLAIN, cut).otherwise(F.col("words")))
    tokens = F.col("tokens")
    places = F.when(F.size(tokens) >= RUN, F.sequence(F.lit(0), F.size(tokens) - RUN)).otherwise(F.array().cast("array<int>"))
    run = lambda k: F.slice(tokens, k + 1, RUN)
    runs = F.transform(F.filter(places, lambda k: F.forall(run(k), _is_literal)), lambda k: F.get(_runs(_hashes(run(k))), F.lit(0)))
    held = stored(proving.withColumn("runs", runs), "window-runs")
    items = held.select(F.explode("runs").alias("key"), "item_id").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("items"))
    chosen = held.select("item_id", "reading", "window", F.explode("runs").alias("key")).join(items, "key")
    chosen = chosen.groupBy("item_id", "reading", "window").agg(F.min_by("key", F.struct("items", "key")).alias("run"))
    held = held.join(chosen, ["item_id", "reading", "window"], "left")
    whole = F.col("run").isNull() & (F.size("words") < WORDS)
    of_item = held.groupBy("item_id", "reading").agg(F.count_if(F.col("run").isNull() & ~whole).alias("spare"))
    held = held.join(of_item, ["item_id", "reading"])
    loose = F.col("spare") >= F.col("proving") * share
    longest = F.aggregate(F.filter(tokens, _is_literal), F.lit(""), lambda a, w: F.when(F.length(w) > F.length(a), w).otherwise(a))
    kind = F.when(whole, ENDS).when(loose, WORD).when(F.col("run").isNotNull(), RUN_OF)
    key = F.when(kind == ENDS, F.get(_ends(_hashes(tokens)), F.lit(0))).when(kind == WORD, F.xxhash64(F.lit("word"), F.xxhash64(longest)))
    spare = F.when(loose, 0).otherwise(F.col("spare")).alias("spare")
    rows = held.select(F.coalesce(key, F.col("run")).alias("key"), kind.alias("kind"), "item_id", "reading", spare, F.col("proving").alias("total"))
    return rows.where("kind IS NOT NULL").groupBy("key", "kind", "item_id", "reading", "spare", "total").agg(F.count(F.lit(1)).alias("weight"))


def _wanted(known: DataFrame) -> DataFrame:
    return known.where("proves").select("window", "item_id", "reading", F.col("proving").alias("total")).distinct()


def _to_read(docs: DataFrame, known: DataFrame, share: float) -> DataFrame:
    """(doc_id) of the documents that may hold an item, by one look at the words of every text."""
    anchors = stored(_anchors(known, share), "anchors")
    kinds = {r.kind for r in anchors.select("kind").distinct().collect()}
    texts = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    # Each step is made once for the places that use it.
    words = texts.select("doc_id", "row", _hashes(F.filter(_tokens(F.col("text")), lambda w: w != "")).alias("words"))
    keys = [_runs(F.col("words"))]
    if WORD in kinds:
        keys.append(F.transform("words", lambda w: F.xxhash64(F.lit("word"), w)))
    if ENDS in kinds:
        keys.append(_ends(F.col("words")))
    found = words.select("doc_id", "row", F.explode(F.array_distinct(F.concat(*keys))).alias("key"))
    held = found.join(broadcast_if_small(anchors, anchors.count()), "key")
    held = held.groupBy("doc_id", "row", "item_id", "reading", "spare", "total").agg(F.sum("weight").alias("weight"))
    held = held.where(F.col("weight") + F.col("spare") >= F.col("total") * share).select("doc_id")
    # Templates may cut the words of such texts otherwise; the quick look finds those that could.
    odd = texts.where(F.col("text").rlike(_MARKS)).where(F.col("text").rlike(_CUT_WORDS)).select("doc_id")
    return stored((held.union(odd) if kinds else held).distinct(), "to-read")


def _holding(docs: DataFrame, known: DataFrame, share: float) -> DataFrame:
    """(doc_id, item_id, reading, coverage) by proving windows alone; the reading is the item's."""
    read = _to_read(docs, known, share).withColumnRenamed("doc_id", "read_id")
    texts = docs.join(broadcast_if_small(read, read.count()), F.col("doc_id").eqNullSafe(F.col("read_id")), "left_semi")
    # Words, hashes and windows one after the other: each is made once for the many places that use it.
    words = [template_words(F.col("text"), r).alias(f"words{r}") for r in READINGS]
    rows = texts.select("doc_id", F.monotonically_increasing_id().alias("row"), *words)
    rows = rows.select("doc_id", "row", *[_hashes(F.col(f"words{r}")).alias(f"hashes{r}") for r in READINGS])
    each = [windows(F.col(f"hashes{r}")) for r in READINGS]
    found = rows.select("doc_id", "row", F.explode(F.array_distinct(F.concat(*each))).alias("window"))
    held = found.join(broadcast_if_small(_wanted(known), known.count()), "window")
    held = held.groupBy("doc_id", "row", "item_id", "reading").agg(F.count(F.lit(1)).alias("n"), F.first("total").alias("total"))
    held = held.select("doc_id", "item_id", "reading", (F.col("n") / F.col("total")).alias("coverage")).where(F.col("coverage") >= share)
    return held.groupBy("doc_id", "item_id", "reading").agg(F.max("coverage").alias("coverage"))


def _agreeing(docs: DataFrame, pairs: DataFrame, known: DataFrame, share: float) -> DataFrame:
    """The pairs whose windows without contradicting slots still cover the item."""
    texts = docs.join(broadcast_if_small(pairs.select(F.col("doc_id").alias("held_id")).distinct(), pairs.count()), F.col("doc_id").eqNullSafe(F.col("held_id")), "left_semi")
    texts = stored(texts.select("doc_id", F.monotonically_increasing_id().alias("row"), "text"), "texts")
    read = _read(texts, "doc_id", "row").withColumnRenamed("reading", "way")
    read = stored(read.select("doc_id", "row", "way", windows(F.col("hashes")).alias("windows"), F.col("slots").alias("of_doc")), "read")
    rows = read.select("doc_id", "row", "way", "of_doc", F.posexplode("windows").alias("at", "window"))
    matched = rows.join(known.where("proves").drop("words"), "window")
    pair = pairs.select(F.col("doc_id").alias("held_id"), F.col("item_id").alias("held_item"), F.col("reading").alias("held_reading"))
    wanted = (F.col("item_id") == F.col("held_item")) & (F.col("reading") == F.col("held_reading"))
    matched = matched.join(pair, F.col("doc_id").eqNullSafe(F.col("held_id")) & wanted, "left_semi")

    def given(slots: Column, at: Column) -> Column:
        return F.transform(slots, lambda s: F.struct(s["value"].alias("value"), F.element_at("of_doc", at + s["offset"]).alias("given")))

    held = ["doc_id", "row", "item_id", "reading", "total"]
    shift = (F.col("at") - F.col("place")).alias("shift")
    matched = stored(matched.select(*held, "way", shift, "window", given(F.col("slots"), F.col("at")).alias("slots")), "matched")
    # The other windows of the item at the same alignments: one place each, whatever else of the text is like them.
    other = known.where("NOT proves").groupBy("item_id", "reading").agg(F.collect_list(F.struct("window", "place", "slots")).alias("others"))
    spots = matched.select(*held, "way", "shift").distinct().join(other, ["item_id", "reading"])
    spots = spots.join(read.select("row", "way", "windows", "of_doc"), ["row", "way"])
    there = F.filter("others", lambda o: F.get("windows", F.col("shift") + o["place"]) == o["window"])
    there = F.transform(there, lambda o: F.struct(o["window"].alias("window"), given(o["slots"], F.col("shift") + o["place"]).alias("slots")))
    matched = matched.unionByName(spots.select(*held, "way", "shift", F.inline(there)))
    one = matched.select(*held, "window", "way", "shift", F.explode_outer("slots").alias("slot")).withColumn("given", F.col("slot.given"))
    # The values that one value of the item stands for, within one alignment.
    stands = one.groupBy("doc_id", "row", "item_id", "reading", "way", "shift", F.col("slot.value").alias("value")).agg(
        F.min("given").alias("low"), F.max("given").alias("high")
    )
    against = stands.where("low <> high").select(
        F.col("doc_id").alias("d"), F.col("row").alias("r"), F.col("item_id").alias("i"), F.col("reading").alias("g"),
        F.col("way").alias("w"), F.col("shift").alias("s"), F.col("value").alias("v"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")) & (F.col("item_id") == F.col("i"))
    same &= (F.col("reading") == F.col("g")) & (F.col("way") == F.col("w")) & (F.col("shift") == F.col("s"))
    one = one.join(against, same & (F.col("slot.value") == F.col("v")), "left")
    good = one.groupBy(*held, "way", "shift", "window").agg(F.max(F.col("v").isNotNull()).alias("bad")).where("NOT bad")
    counted = good.groupBy(*held).agg(F.count_distinct("window").alias("n"))
    counted = counted.select("doc_id", "item_id", (F.col("n") / F.col("total")).alias("coverage")).where(F.col("coverage") >= share)
    return counted.groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"))


def contaminations(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, coverage) for every document that holds an item."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = item_windows(benchmark)
    held = stored(_holding(docs, known, share), "held")
    varied = known.where(F.size("slots") > 0).select("item_id", "reading").distinct()
    checked = stored(held.join(varied, ["item_id", "reading"], "left_semi"), "checked")
    found = held.join(varied, ["item_id", "reading"], "left_anti").select("doc_id", "item_id", "coverage")
    if not checked.isEmpty():
        found = found.unionByName(_agreeing(docs, checked, known, share))
    return found.groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"))


def marked(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, contaminated, item_ids in order and the best coverage, for every row of `docs`."""
    found = contaminations(docs, benchmark, share).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("coverage").alias("coverage")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    joined = rows.join(found.withColumnRenamed("doc_id", "held_id"), F.col("doc_id").eqNullSafe(F.col("held_id")), "left")
    return joined.select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, with all columns."""
    held = stored(contaminations(docs, benchmark, share).select(F.col("doc_id").alias("held_id")).distinct(), "held")
    small = broadcast_if_small(held, held.count())
    return docs.join(small, docs["doc_id"].cast("long").eqNullSafe(small["held_id"]), "left_anti")
