import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, words: int) -> str:
    """Invented text that the seed decides."""
    import random

    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(WORDS) for _ in range(words))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, ties, repeated rows, odd texts, a long one, and more columns with clashing names."""
    texts = [
        (0, prose(0, 200)), (1, prose(0, 200)), (2, prose(0, 199) + " changed"), (3, None), (4, ""), (5, " \n\t "),
        (6, "word"), (7, "two words"), (8, "x" * 3000), (9, prose(9, 30_000)), (10, "Ünï çødé <|endoftext|> 日本語 it's 12 ﬁ"),
        (11, prose(11, 50)), (11, prose(11, 50)), (12, "A. B. C.\nA. B. C.\n\nD!"), (None, prose(13, 40)), (None, None),
    ]
    rows = [(i, t, "en", None if i == 7 else "web", len(t or ""), 1, 2, 3, 4) for i, t in texts]
    names = "doc_id long, text string, lang string, source string, n_chars long, fp long, id long, shard long, component_id long"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
