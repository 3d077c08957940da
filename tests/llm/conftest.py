import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Random texts with exact copies (also in other case), near copies, nulls, empty texts and one long text."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(60)]
    texts += [texts[i % 7] for i in range(40)] + [texts[3].upper(), texts[4].title()]
    base = prose(rng, 400)
    for i in range(12):
        words = base.split()
        words[30 * i] = "changed"
        texts.append(" ".join(words))
    texts += [None, "", "", None, " \n\t", "é", "É", prose(rng, 30000), "Mail a.b@c.example.org now", "token = 'abcdef123456'"]
    return [(i * 3 + 1, t, ("en", "fr", None)[i % 3], f"src{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


#: Names that the operators use inside or return.
CLASHING = ["digest", "maybe", "keep_id", "fp", "node", "component_id", "size", "row", "shard", "score", "block", "length", "copy_digest", "near_keep", "clean_text", "toxic", "batch", "class", "ids", "low"]


@pytest.fixture(scope="session")
def wide_docs(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids, repeated rows, repeated ids with other texts, null metadata."""
    rows = [(None, "same text here", None, None, None), (None, None, "en", "a", 0), (5, "same text here", "en", "a", 14)]
    rows += [(5, "same text here", "en", "a", 14), (5, "another", "en", "a", 7), (2, "Same TEXT here", "en", None, 14), (9, "", "en", "a", 0)]
    return spark.createDataFrame(rows, SCHEMA)
