import random
from pathlib import Path

import pytest

SF = Path("/root/testdata/sf0.001")


def odd_rows():
    """Texts that are missing, empty, blank, short, repeated, very long, or of rare characters."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    base = prose(120)
    near = base.split()
    near[60] = "changed"
    far = base.split()
    far[::9] = ["x"] * len(far[::9])
    long = prose(30_000)
    texts = [
        None, "", "   \n\t ", "one", "One", "two words", base, base, " ".join(near), " ".join(far),
        base.upper(), "a b c d e f g h i j " * 40, "same line here\n" * 30, long, long + " tail",
        "x" * 5000, "naïve café straße \x1c odd   space", "\U0001f600 emoji ퟿ end",
        "password = 'abcdef123456' and token: deadbeefdeadbeefdeadbeef00", "AKIA" + "A1B2C3D4E5F6G7H8",
        "<|endoftext|> <|startoftext|> don't we're", "İstanbul été ẞ",
    ]
    rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    return [*rows, (None, "a text without an id", None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(spark):
    """Further columns with the names that operators use themselves."""
    names = (
        "key sid node component tile part n_words kept h cls n c place a b ids shard_depth hash_key "
        "score n_bytes count start end secret_spans __text __named own_text named_spans row_number number group "
        "first id draw lang_pred"
    ).split()
    rows = [(*row, *range(len(names))) for row in odd_rows()]
    return spark.createDataFrame(rows, SCHEMA + "".join(f", `{x}` int" for x in names))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(str(SF / "documents.parquet"))
