import pytest

from tidewater.llm.base import prepare

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)


@pytest.fixture()
def odd_docs(spark):
    """Nulls in every column, empty, short and very long texts, copies, repeated
    rows, and extra columns named like the operators' own."""
    rows = [
        (1, "", "en", "src0"), (2, None, None, None), (None, "no id here at all today", "en", "src1"),
        (3, "one", "en", "src0"), (4, "same words for two documents, told twice", "de", "src2"),
        (5, "same words for two documents, told twice", "de", "src2"), (6, LONG, "fr", "src9"),
        (7, " \t\n ", "en", "src0"), (7, " \t\n ", "en", "src0"), (8, "▁ ␛ 日本 \U0001d518 <|im_start|> </s>", "xx", "zzz"),
        (None, None, None, None), (9, "repeated row of text", "es", "src3"), (9, "repeated row of text", "es", "src3"),
    ]
    extra = "score double, label int, node long, hash string, epoch long, full int, cut string, e string, s string, scan int"
    return spark.createDataFrame([(*r, 0.5, 1, 2, "h", 3, 4, "c", "e", "s", 5) for r in rows],
                                 f"doc_id long, text string, lang string, source string, {extra}")


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture()
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
