import random

from runlens.llm import langid, quality
from tests.llm.cases import frame, odd, words

STEMS = {"xx": ("ba", "lo", "ti"), "yy": ("ku", "ze", "go")}


def corpus(spark, n=240):
    rows = []
    for i in range(n):
        rnd, lang = random.Random(i), ("xx", "yy")[i % 2]
        rows.append((i, " ".join("".join(rnd.choices(STEMS[lang], k=rnd.randint(1, 3))) for _ in range(30)), lang))
    return frame(spark, rows)


def test_languages_of_held_out_documents(spark):
    docs = corpus(spark)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = langid.identify(docs).collect()
    assert len(got) == 240 and {r.held_out for r in got} == {True, False}
    assert all(r.lang_pred == truth[r.doc_id] and 0.5 < r.score <= 1 for r in got)


def test_unseen_words_back_off_to_ngrams(spark):
    model = langid.train(corpus(spark))
    assert "lotibalotibalo" not in model.places[0]
    assert langid.Scorer(model).predict("lotibalotibalo")[0] == "xx"
    assert langid.Scorer(model).predict("zegokuzegokuze")[0] == "yy"


def test_odd_documents(spark):
    docs = odd(spark).union(corpus(spark, 40).selectExpr("doc_id + 1000 as doc_id", "* except (doc_id)"))
    got = langid.identify(docs)
    assert got.count() == docs.count()
    und = {r.doc_id for r in got.where("lang_pred = 'und'").collect()}
    assert und == {2, 3, 4, 8, None}
    assert all(r.score == 0 for r in got.where("lang_pred = 'und'").collect())
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 5
    assert langid.identify(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", docs.lang.substr(1, 0)).where("false").union(frame(docs.sparkSession, [(1, "abc", None)]))
    assert [tuple(r)[2:] for r in langid.identify(unlabelled).collect()] == [("und", 0.0)]


def plain_scores(rows, text):
    """Log frequencies counted and added up one by one."""
    import math
    import re
    from collections import Counter

    counts = {}
    for _, known, lang in rows:
        for word in re.findall(r"[^\W\d_]+", known.lower()):
            counts.setdefault((0, word), Counter())[lang] += 1
            for n in (5, 4, 3, 2, 1):
                for g in langid._grams(word, n):
                    counts.setdefault((len(g), g), Counter())[lang] += 1
    langs = sorted({r[2] for r in rows})
    total, kept = Counter(), Counter()
    for (order, _), by_lang in counts.items():
        kept[order] += 1
        for lang, n in by_lang.items():
            total[order, lang] += n
    scores = Counter({lang: 0.0 for lang in langs})
    found = re.findall(r"[^\W\d_]+", text.lower())
    for word in found:
        terms = [(0, word)] if (0, word) in counts else []
        for n in (5, 4, 3, 2, 1):
            terms = terms or [(len(g), g) for g in langid._grams(word, n) if (len(g), g) in counts]
        for lang in langs:
            scores[lang] += sum(math.log((counts[t][lang] + 0.5) / (total[t[0], lang] + 0.5 * kept[t[0]])) for t in terms) / max(1, len(terms))
    scaled = {lang: s / math.sqrt(len(found)) for lang, s in scores.items()}
    best = max(langs, key=lambda x: scaled[x])
    return best, 1 / sum(math.exp(s - scaled[best]) for s in scaled.values())


def test_scores_against_plain_counting(spark):
    docs = corpus(spark, 90)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    known = [r for r, d in zip(rows, langid.identify(docs).orderBy("doc_id").collect(), strict=True) if not d.held_out]
    for r in langid.identify(docs).orderBy("doc_id").limit(25).collect():
        best, score = plain_scores(known, rows[r.doc_id][1])
        assert r.lang_pred == best and abs(r.score - score) < 1e-4


def test_many_languages_and_rare_ones_are_learned(spark):
    def text(lang, seed):
        rnd = random.Random(lang * 7919 + seed)
        own = random.Random(lang)
        stems = ["".join(own.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(25)]
        return " ".join(rnd.choice(stems) for _ in range(40))

    rows = [(lang * 10 + k, text(lang, k), f"l{lang:03d}") for lang in range(300) for k in range(8)]
    hot = [(100_000 + k, words(k, 80), "hot") for k in range(1500)]
    got = langid.identify(frame(spark, rows + hot)).where("doc_id < 100000 AND held_out").collect()
    right = sum(r.lang_pred == f"l{r.doc_id // 10:03d}" for r in got)
    assert len(got) > 400 and right > 0.97 * len(got)


def test_pipeline_stage_without_languages_keeps_documents(spark):
    docs = frame(spark, [(1, "some text", None), (2, "12 34", None), (3, None, None), (4, "", None)])
    assert [r.doc_id for r in langid.accepted(docs).collect()] == [1]


def labelled(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        text = words(i, 60)
        rows.append((i, text if good else " ".join(w + "%%%" for w in text.split())))
        labels.append((i, int(good), 0))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_of_held_out_documents(spark):
    docs, labels = labelled(spark)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality.classify(docs, labels).where("held_out").collect()
    assert len(got) > 60 and all(r.predicted == truth[r.doc_id] for r in got)


def test_quality_of_odd_documents(spark):
    docs, labels = labelled(spark, 60)
    got = quality.scored(odd(spark), quality.train(docs, labels)).collect()
    assert len(got) == odd(spark).count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id == 3} == {r.score for r in got if r.doc_id == 2}
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    one = quality.classify(docs, labels.selectExpr("doc_id", "1 as quality", "toxic")).collect()
    assert all(r.predicted == 1 for r in one)
    nulls = labels.selectExpr("if(doc_id % 2 = 0, null, doc_id) as doc_id", "if(doc_id % 5 = 0, null, quality) as quality")
    assert quality.classify(docs, nulls.union(nulls)).count() == docs.count()


def test_trees_follow_their_arrays():
    import numpy as np

    rng = np.random.default_rng(0)
    rows = rng.normal(size=(500, 3))
    labels = (rows[:, 0] * rows[:, 1] > 0).astype(float)
    forest = quality.boosted(rows, labels)
    binned = forest.binned(rows)
    for i in range(0, 500, 37):
        total = forest.base
        for feature, split, value in zip(forest.feature, forest.split, forest.value, strict=True):
            node = 0
            for _ in range(quality.DEPTH):
                node = 2 * node + 1 + int(binned[i, feature[node]] > split[node])
            total += value[node - (2**quality.DEPTH - 1)]
        assert abs(1 / (1 + np.exp(-total)) - forest.score(rows[i : i + 1])[0]) < 1e-9
    assert ((forest.score(rows) > 0.5) == labels).mean() > 0.95
