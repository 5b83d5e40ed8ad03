import pytest

from clickfold.llm.common import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def tokenizers_of():
    from clickfold.llm.queries import tokenizer_path
    return tokenizer_path


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


def prose(seed: int, n: int) -> str:
    import random
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


#: NULLs, empty and blank texts, ties, repeated rows, a long text, odd white space.
ODD_TEXTS = [None, "", " \t\n\x0b\x0c\r ", "one", "one two", "ONE two", "one two three",
             " x y", "É é 漢字 \U0001F600", "a\tb\r\nc", prose(1, 60), prose(1, 60),
             prose(1, 59) + " other", prose(2, 30_000), "# $ % & | < > *" * 20]


def odd_documents(spark):
    """Rows for every case the operators define, with columns whose names
    clash with those that operators use inside."""
    rows = [(i, t, ["en", None, "de"][i % 3], ["b", None, "a", ""][i % 4], 7, "x", 1.5)
            for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "one", "en", "b", 7, "x", 1.5), (3, "one", "en", "b", 7, "x", 1.5),
             (None, "one", "en", "b", 7, "x", 1.5), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, size long, _row string, "
              "score double")


def no_documents(spark):
    return odd_documents(spark).where("1 = 0")
