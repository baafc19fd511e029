"""Decontamination against a matcher in plain Python, and on texts that patterns could choke on."""

import random

import pytest
import regex

from runlens.llm import decontaminate as dc
from tests.llm.cases import frame, words

NAME, NUMBER, UNIT = dc.NAME, dc.NUMBER, dc.UNIT
NUMBERS = regex.compile(dc._NUMBER_PATTERN)
UNITS = regex.compile(rf"(?<={NUMBER} {{1,2}})(?:{dc._UNITS})(?![\p{{L}}\p{{N}}])|%")
NAMES = {dc.INSIDE: regex.compile(dc._NAME_PATTERN), dc.FREE: regex.compile(dc._FREE_NAME_PATTERN)}


def read(text, reading):
    """Template words, and place -> value of the placeholders."""
    text = text or ""
    if reading == dc.PLAIN:
        return split(text), {}
    if reading == dc.FREE:
        text = regex.sub(r"[ \t\n\v\f\r]+", " ", text)
    named = NAMES[reading].sub(f" {NAME} ", text)
    numbered = NUMBERS.sub(f" {NUMBER} ", named)
    out = split(UNITS.sub(f" {UNIT} ", numbered))
    values = {NAME: NAMES[reading].findall(text), NUMBER: NUMBERS.findall(named), UNIT: UNITS.findall(numbered)}
    slots = {}
    for kind, found in values.items():
        slots |= dict(zip([i for i, w in enumerate(out) if w == kind], [v.lower() for v in found], strict=True))
    return out, slots


def split(text):
    return [w for w in regex.split(rf"[^\p{{L}}\p{{M}}\p{{N}}{NAME}{NUMBER}{UNIT}]+", text.lower()) if w]


def windows(out):
    return [tuple(out[i : i + 5]) for i in range(max(1, len(out) - 4))] if out else []


def proves(window):
    return sum(w not in (NAME, NUMBER, UNIT) for w in window) >= min(3, len(window))


def holds(text, item, share=0.8):
    """Whether the text holds the item by any reading of it."""
    ways = {r: read(text, r) for r in dc.READINGS}
    for reading in dc.READINGS:
        out, slots = read(item, reading)
        own = windows(out)
        if reading != dc.PLAIN:
            proving = {w for w in own if proves(w)}
        else:
            proving = set(own)
        if not proving:
            continue
        there = {w for o, _ in ways.values() for w in windows(o)} & proving
        if len(there) < share * len(proving):
            continue
        # Equal values of the item stand for equal values of the text, within one alignment.
        total, good = len(set(own)) if slots else len(proving), set()
        for o, s in ways.values():
            mine = windows(o)
            shifts = {}
            for at, w in enumerate(mine):
                for place, v in enumerate(own):
                    if v == w and (v in proving):
                        shifts.setdefault(at - place, []).append((at, place, w))
            for shift, held in shifts.items():
                held += [(p + shift, p, v) for p, v in enumerate(own) if v not in proving and 0 <= p + shift < len(mine) and mine[p + shift] == v]
                stands = {}
                for at, place, w in held:
                    for k in range(len(w)):
                        if place + k in slots:
                            stands.setdefault(slots[place + k], set()).add(s.get(at + k))
                clash = {v for v, given in stands.items() if len(given - {None}) > 1}
                good |= {w for _, place, w in held if not any(slots.get(place + k) in clash for k in range(len(w)))}
        if len(good) >= share * total:
            return True
    return False


VOCABULARY = "how many apples does he have left after the market when they sell boxes of fruit in town and count what is there".split()
PEOPLE = ["Tom", "Ann", "Bob Hill", "Zoe", "Mary Ann Lee"]


def question(rnd):
    """Prose with names, numbers and units in it."""
    parts = []
    for _ in range(rnd.choice([2, 4, 9, 14, 30])):
        parts.append(rnd.choice([*([None] * 6), "name", "number", "unit"]))
    return [rnd.choice(VOCABULARY) if p is None else p for p in parts]


def filled(parts, people, numbers, rnd, case=0):
    out = []
    for p in parts:
        if p == "name":
            out.append(people[0] if rnd.random() < 0.5 else people[1])
        elif p == "number":
            out.append(str(numbers[rnd.randrange(2)]))
        elif p == "unit":
            out.append(f"{numbers[0]} km")
        else:
            out.append(p)
    text = " ".join(out)
    return text[0].upper() + text[1:] + "." if case == 0 else text.lower() if case == 1 else text.upper()


def drawn(seed):
    rnd = random.Random(seed)
    items, texts = [], []
    for i in range(14):
        parts = question(rnd)
        items.append((i, filled(parts, rnd.sample(PEOPLE, 2), (3, 17), random.Random(i))))
        for _ in range(3):
            changed = list(parts)
            for _ in range(rnd.choice([0, 0, 0, 1, 3])):
                changed[rnd.randrange(len(changed))] = rnd.choice([*VOCABULARY, "name", "number"])
            copy = filled(changed, rnd.sample(PEOPLE, 2), rnd.sample(range(99), 2), random.Random(rnd.choice([i, 77])), rnd.choice([0, 0, 1, 2]))
            texts.append(rnd.choice(["", words(i, 9) + " ", "One more. "]) + copy + rnd.choice(["", " " + words(i + 50, 8)]))
    items += [(20, "route 66"), (21, "x2 y3 z4 5 6 7 8 9"), (22, "who is Tom today"), (23, "yes"), (24, "3 + 4 = 7"), (25, "of Ann and Bob, of Tom and Zoe, of Ann")]
    texts += ["Route 66!", "so x2 y3 z4 5 6 7 8 9 it is", "Who is Ann today?", "who is Ann Lee Hill today", "yes", "no yes", "3 4 7", "of Zoe and Bob, of Tom and Ann, of Zoe", "abc3def ghi 12km"]
    return items, texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_a_plain_matcher(spark, seed):
    items, texts = drawn(seed)
    frame_of = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in dc.marked(frame(spark, list(enumerate(texts))), frame_of).collect()}
    want = {k: [i for i, item in items if holds(text, item)] for k, text in enumerate(texts)}
    assert got == want
    assert sum(map(len, want.values())) > 12


def test_long_runs_of_capitals_and_numbers(spark):
    item = "the old bridge near Northtown was built by Ann Hill in 1850 and cost 300 dollars at that time"
    runs = ["Abc " * 100_000, "1," * 100_000, "Abc 12 " * 60_000, "Abc, 3.5 km " * 40_000, "A" * 300_000, "7" * 300_000, "ABC-" * 80_000]
    rows = [(i, run) for i, run in enumerate(runs)] + [(100 + i, f"{run} {item.replace('Ann Hill', 'Bob')} {run}") for i, run in enumerate(runs[1:4], 1)]
    rows = [(i, t if i < 100 else t.replace("1850", "1790")) for i, t in rows]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id for r in dc.marked(frame(spark, rows), items).collect() if r.contaminated}
    assert got == {i for i, _ in rows if i >= 100}


def test_words_that_templates_cut(spark):
    """Marks after capitals or units leave rests of words that the quick look does not know."""
    item = "the house of Anń mile is near the old mill and Tom² likes the river there"
    copy = item.replace("Ann", "Bob").replace("Tom", "Zoe")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"before it {item} and after it"), (2, f"before it {copy} and after it"), (3, "the house of the old mill")]
    got = {r.doc_id: r.contaminated for r in dc.marked(frame(spark, rows), items).collect()}
    assert got == {i: holds(t, item) for i, t in rows}


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    docs = frame(spark, [(1, "Á a b c d e f g"), (2, None)])
    assert {(r.doc_id, r.contaminated) for r in dc.marked(docs, items).collect()} == {(1, True), (2, False)}
    assert not dc.marked(docs, items.limit(0)).where("contaminated").count() and not dc.marked(docs.limit(0), items).count()
