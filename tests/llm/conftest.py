import random

import pytest


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    """The tests' own shared folder, where the session names none."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tmp_path_factory.mktemp("shared").as_uri())


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty and long texts, repeats, and clashing columns."""
    r = random.Random(4)
    words = ["the", "quick", "brown", "Fox", "jumps.", "over", "lazy", "dogs!", "éa", "ß", "42", "a@b.com", "x"]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = prose(60)
    rows = [
        (1, prose(80), "en", "a"), (2, None, "en", "a"), (3, "", "en", None), (4, " \n\t ", None, "a"), (5, "word", "en", "a"),
        (6, passage, "en", "a"), (7, passage + ".\n" + prose(20), "en", "b"), (8, prose(10) + "\n" + passage, "de", "b"),
        (9, "z" * 3000, "en", "a"), (10, "\n".join([prose(8)] * 3 + [prose(9)]), "en", "a"), (11, prose(9000), "en", "a"),
        (None, prose(30), "en", "a"), (12, passage, "en", "a"), (12, passage, "en", "a"), (13, prose(20) + " ÿ　日本語 \U0001f600", None, None),
        (-5, "one two three", "en", "a"), (14, "the the the " * 40, "en", "a"),
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, key string, line string, n int, place string,"
        " fp long, raw string, version int, n_lines string, n_removed string, kept string, centre int, spans int"
    )
    extra = ("k", "l", 3, "p", 5, "r", 7, "nl", "nr", "kept", 1, 2)
    return spark.createDataFrame([(d, t, a, b, None if t is None else len(t), *extra) for d, t, a, b in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
