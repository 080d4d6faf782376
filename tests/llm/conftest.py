import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, size int, fp long"


def words(rng, n, letters="abcdefghijklmnop"):
    return [rng.choice(letters) + rng.choice("aeiou") + rng.choice(letters) + str(rng.randint(0, 40)) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """Copies, near copies, NULLs in every column, empty and long texts, a repeated row, columns with clashing names."""
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.randint(20, 120))) for _ in range(40)]
    texts += [texts[0]] * 30 + [texts[1].replace(" ", "\t ")] * 3
    for i in range(25):
        w = texts[2].split() * 3
        w[rng.randrange(len(w))] = f"other{i}"
        texts.append(" ".join(w))
    texts += [None, "", "   \n\t", "x", "ÄÖ Straße é É", "a b", " ".join(words(rng, 20_000)), "Lead\n\nline  two   end "]
    rows = [
        (i, t, None if i % 7 == 0 else "en", None if i % 11 == 0 else f"s{i % 3 if i % 2 else 0}", None, "x", 1, 7)
        for i, t in enumerate(texts)
    ]
    rows += [(None, "a lone row", "en", "s1", 3, None, None, None), rows[5], rows[5]]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
