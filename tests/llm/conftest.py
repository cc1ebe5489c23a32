import pytest

SF_SMALL = "/root/testdata/sf0.001"

#: Texts that every operator must take: null, empty, blank, one word, no letters, non-ASCII, repeated, long.
ODD_TEXTS = [None, "", " \n\t ", "word", "12 34 %% $$", "Straße déjà-vu ΣΑΣ 東京 ́x", "a b c d e f", "a b c d e f",
             "lorem ipsum dolor sit amet " * 8000, "x" * 300_000]


@pytest.fixture
def odd_docs(spark):
    """Documents with odd texts, null and repeated ids, null lang and source, and columns that operators use too."""
    rows = [(None if i == 4 else 6 if i == 7 else i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", 0, "k", 1, "t", "u")
            for i, t in enumerate(ODD_TEXTS)]
    rows.append(rows[6])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, n int, "
                                       "bucket string, TIE string")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.where("doc_id < 0")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").toPandas()
