import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A table of documents from ``(doc_id, text)`` rows, with columns that clash."""

    def make(rows, partitions=3):
        data = [(i, t, None, "s", None if t is None else len(t), 1, "x", [1]) for i, t in rows]
        clash = ", chunk int, row string, score array<int>"
        return spark.createDataFrame(data, DOCS + clash).repartition(partitions)

    return make


@pytest.fixture
def stored(spark, folder):
    """A folder with the tables given, as the queries read them."""

    def make(**tables):
        sf_dir = folder("tables")
        for name, df in tables.items():
            df.write.parquet(f"{sf_dir}/{name}.parquet")
        return sf_dir

    return make


#: Texts that every operator must take.
ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\t ",
    "a",
    "É ñ ß 中文 \U0001f600",
    "  lead and  double  blanks \n",
    "same text",
    "same text",
    "x" * 3000,
    "la " * 2500,
    "<|endoftext|> is text, 'tis <|startoftext|>",
    "don't we'll \x1c x\x85y 12 345",
]


@pytest.fixture
def odd_documents(documents):
    """Odd texts, one of them twice whole, two rows without an id."""
    rows = list(enumerate(ODD_TEXTS)) + [(7, "same text"), (None, "no id"), (None, None)]
    return documents(rows)
