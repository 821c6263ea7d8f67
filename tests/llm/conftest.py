import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"
#: A column of each name that the operators use inside, to clash with.
CLASHING = ("kept", "key", "length", "ids", "fp", "row", "part", "hilbert", "n", "component_id", "start", "chunk")
WORDS = "the of and house river mountain walks slowly over green fields toward evening light der die und haus fluss le la et maison".split()


@pytest.fixture
def docs(spark):
    """Rows of documents as a table, with clashing extra columns."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], DDL)
        from pyspark.sql import functions as F

        return df.withColumns({c: F.lit(f"x{c}") for c in CLASHING}) if extra else df

    return make


@pytest.fixture
def texts():
    """Awkward and ordinary texts, the same each time."""
    rng = random.Random(3)
    out = [None, "", " \n\t ", "a", "two words", "x" * 3000, "ü" * 50 + " 日本語 👍 İ ς", "line\nline\nline\n", "tail \x1c\x85 odd white　space"]
    for _ in range(40):
        out.append(" ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(rng.randrange(20, 400))))
    out += [out[12], out[12].replace(" ", "  "), out[13] + " end", out[14].replace("the", "a", 1)]
    return out
