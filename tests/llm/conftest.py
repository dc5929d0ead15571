import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, place_ string, n int, score string"


def edge_texts():
    base = " ".join(f"w{i}" for i in range(60))
    return [
        None,
        "",
        " \t\n\r\x0b\x0c ",
        "one",
        "One TWO three",
        "one two THREE",
        base,
        base.upper(),
        base.replace("w30", "changed"),
        base.replace(" w", "\n w", 5),
        base + " tail",
        "word " * 20000,
        "x" * 70000,
        "Mail a.b+c@example.co.uk, 10.0.0.256 and 10.0.0.25, card 4539 1488 0343 6467, +49 (30) 1234-5678.",
        "ß漢字 😀 \u2581 e\u0301 \x00 <s> </s> <0x0A>",
        "1234 5678 !!! ???",
    ]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty, blank, very long and repeated texts, repeated rows, odd ids and clashing columns."""
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "a", "b", "a"][i % 4], None if t is None else len(t), "clash", "clash", 1, "clash") for i, t in enumerate(edge_texts())]
    rows += [rows[6], rows[13]]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def scratch(spark):
    from nocturne.llm.shared import Scratch

    return Scratch(spark)
