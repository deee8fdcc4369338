import pytest

from tidewell.llm.shipping import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with every odd case: NULLs, empty and very long texts, repeated rows, columns with clashing names."""
    long_text = " ".join(f"word{i % 997} tail{i % 313}" for i in range(30_000))
    base = " ".join(f"alpha{i} beta{i}" for i in range(40))
    line = "this line is long enough that one mark more at its end leaves it a duplicate, " * 3
    rows = [
        (1, base, "en"),
        (2, base, "en"),
        (3, base + " gamma", "en"),
        (3, base + " gamma", "en"),
        (4, None, None),
        (5, "", "en"),
        (6, " \n\t ", None),
        (7, "one two", "en"),
        (8, "One  TWO", "en"),
        (9, long_text, "en"),
        (10, long_text + " end", None),
        (None, "a text without an id " * 4, "en"),
        (None, None, None),
        (11, "Žluťoučký kůň 中文字 😀 \U0001f468‍\U0001f469 é " * 3, "xx"),
        (12, f"{line}\n{line}\nshort", "en"),
        (13, f"{line}!\nanother line that is long enough to count here, and is in no other text", "en"),
    ]
    names = "doc_id long, text string, lang string, word string, ids string, key string, score double, n int, label long, row long, line_no int"
    return spark.createDataFrame([(*r, "w", "i", "k", 0.5, 1, 2, 3, 4) for r in rows], names)


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)
