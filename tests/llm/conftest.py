import pytest

from basketflow.llm.shipping import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text[, lang[, source]])."""
    def build(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return build


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, extra columns whose
    names the operators use inside."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, None, None, None, None), (None, "no id here at all", "en", "s", 17),
            (2, "", "en", "s", 0), (3, " \t\n\r\x0b\x0c ", "en", None, 7), (4, long, "en", "s", len(long)),
            (5, "One two three four five six.", "de", "t", 28),
            (5, "One two three four five six.", "de", "t", 28),
            (6, "one TWO three four five six.", "de", "t", 28),
            (7, "\n\n\n", "fr", "", 3), (8, "日本語 текст ñ é ß 🎉 \x00 \x1c  end", "xx", "u", 30),
            (9, "!!! 123 ...", None, "u", 11)]
    full = [r + tuple(range(9)) for r in rows]
    return spark.createDataFrame(
        full, SCHEMA + ", node long, size long, key long, source_size long, score long, copies long,"
                       " strip long, deleted long, rank long")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)

