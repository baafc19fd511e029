"""Documents with the cases every operator must take: nulls, empty and very long texts, repeated rows, odd columns."""

import random

import duckdb

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id string, node string, row string, kept string, window string, label string, path string, held_id string, "
    "place string, findings string, words string, gone_id string, again_id string, bucket string"
)
EXTRA = 14
PROSE = "the river runs past the old mill and under the stone bridge near the quiet village where people meet on market days"
DEUTSCH = "der fluss fließt an der alten mühle vorbei und unter der steinernen brücke nahe dem stillen dorf wo leute sich treffen"


def words(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdeilmnorstu") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def frame(spark, rows):
    """Rows of (doc_id, text[, lang]) as documents with further columns whose names clash with internal ones."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1]) if r[1] else 0, *["x"] * EXTRA) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd(spark):
    long = words(7, 60_000)
    return frame(
        spark,
        [
            (1, PROSE), (2, None, None), (3, ""), (4, " \n\t "), (5, long), (6, PROSE), (6, PROSE), (None, PROSE), (None, None),
            (7, "x"), (8, "1234 !!"), (9, DEUTSCH, "de"), (10, "a" * 200_000), (2**62, PROSE + " end"), (-5, "é ß 漢字 🙂 <|endoftext|>"),
        ],
    )


def oracle(sql, **frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toArrow())
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    return sorted(map(repr, (dict(sorted(zip(columns, row, strict=True))).items() for row in answer.fetchall())))


def told(df):
    return sorted(map(repr, (dict(sorted(r.asDict().items())).items() for r in df.collect())))
