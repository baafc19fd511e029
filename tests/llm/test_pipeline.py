import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from runlens.llm import catalog
from tests.llm.cases import PROSE, frame, odd, words
from tests.llm.test_values import card


def write(spark, tmp_path, rows, items):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(catalog.oracle_sql()) <= set(names)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "personal_data", "token_ids"]


def test_pipeline(spark, tmp_path):
    import random

    item = words(500, 25)
    number = card(random.Random(1))
    base = words(501, 60)
    rows = [(i, words(i, 40)) for i in range(30)]
    rows += [(100, base), (101, base + " tail"), (102, f"{words(502, 20)} {item} {words(503, 20)}"), (103, f"{words(504, 40)} {number}")]
    rows += [(104, None), (105, "12 34"), (106, "")]
    sf_dir = write(spark, tmp_path, rows, [(1, item)])
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert sorted(got) == [*range(30), 100, 103]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, text in rows[:31]:
        assert got[i].input_ids == library.encode(text, add_special_tokens=False).ids
    assert number not in got[103].decoded.replace(" ", "").replace("</w>", "")
    assert got[103].n_tokens == len(got[103].input_ids)


def test_stages_take_odd_documents(spark, tmp_path):
    sf_dir = write(spark, tmp_path, [(1, PROSE)], [(1, words(500, 25))])
    for docs in (odd(spark), odd(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            if name != "token_ids":
                assert out.columns == docs.columns
            assert out.count() <= docs.count()
