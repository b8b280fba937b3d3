import pytest

#: Documents that try every operator: nulls, blanks, copies, near-copies, ties, repeated rows, a long text.
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
BASE = "the quick brown fox jumps over the lazy dog while many other animals look on and wonder what will come next in this old story about foxes and dogs that never seems to end at all"


def rows():
    texts = [None, "", "   \n\t ", "one", "two words", BASE, BASE, BASE.replace("lazy", "idle"), BASE + " today", LONG, LONG + " tail", "ÉTÉ Straße ñ", "x" * 5000, "a b\n" * 60]
    out = [(i, t, "en" if i % 2 else None, f"s{i % 3}", len(t) if t is not None else None, "clash") for i, t in enumerate(texts)]
    return [*out, out[5], (None, BASE, "en", None, None, None), (None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd(spark):
    """The documents, with a column whose name the operators might use themselves."""
    return spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long, fp string").repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
