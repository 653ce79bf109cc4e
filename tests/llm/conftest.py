import pytest

from shelfcast.llm.text import DOCUMENTS

# Texts that every operator has to live with.
ODD_TEXTS = (
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "Two words",
    "á　b\x1cc\x85d word\x00word",
    "日本語 テスト 💥 é́ <s> </s> <0x41> ▁x ▁",
    "x" * 30_000,
    "long text of many words " * 4_000,
    "same same same same same same same same same same same same same same same same same",
    "!!! ### $$$ %%% &&& *** | | |",
)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, NULL in every column, repeated ids and repeated rows."""
    rows = [(at, text, "en", f"src{at % 3}", 1) for at, text in enumerate(ODD_TEXTS)]
    rows += [
        (None, "text without an id " * 6, None, None, None),
        (None, None, None, None, None),
        (3, "another text under a used id", "de", "src0", None),
        (4, "Two words", "en", "src1", 1),
        (4, "Two words", "en", "src1", 1),
    ]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, source="src"):
        rows = [(at, text, "en", source, len(text or "")) for at, text in enumerate(texts)]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    from shelfcast.llm.text import read_documents

    return read_documents(spark, sf_dir)
