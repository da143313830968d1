import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words string, shard string, fp string, key string, size string, kept string, "
          "n_tokens string, ids string, t64 string, block string, score string, position string")


def make(spark, rows):
    """Documents with extra columns whose names clash with what operators add."""
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *["x"] * 12) for r in rows], SCHEMA)


def edge_rows():
    rng = random.Random(7)
    words = ["the", "of", "and", "Haus", "été", "niño", "x,", "Z.", "漢字", "re-do", "it's", "42"] + ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(300)]

    def prose(n):
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", "\n", "\t"]) for _ in range(n))

    shared = prose(80)
    rows = [(1, prose(120), "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \n\t ", "de", "b"), (5, "one", "de", "b"), (6, "two words", None, "b"),
            (7, prose(30) + " " + shared + " " + prose(60), "en", "a"), (8, prose(25) + " " + shared + " " + prose(10), "fr", None), (9, shared, "en", "a"),
            (None, prose(20) + " " + shared, "en", "a"), (None, None, None, None), (10, "of " * 400, "en", "a"), (12, "a b c\x1cd", "en", "a"),
            (13, prose(9000), "en", "a"), (14, "x" * 5000, "en", "a"), (15, "#$% | <a> " * 60 + prose(60), "en", "a")]
    first = rows[0]
    rows += [first, first, (16, first[1], "en", "b"), (17, first[1], "de", "a"), (18, first[1].replace("the", "The"), "en", "a"), (19, first[1] + " more", "en", "a")]
    rows += [(20 + i, prose(90), "en", "a") for i in range(20)] + [(1, prose(70), "en", "a")]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return make(spark, edge_rows()).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return make(spark, [])
