import pytest
from pyspark.sql import types as T

from pacewell.llm import common

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (doc_id, text, lang, source) rows, with columns whose names clash on purpose."""
    common.importable(spark)

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows], DOCUMENTS)
        clash = ("key", "size", "place", "line", "id", "task", "klass", "score", "rank", "range", "block", "rid", "taken")
        return df.selectExpr("*", *[f"'{c}' AS {c}" for c in clash]) if extra else df

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a long text, ties and repeated rows."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
    return [
        (1, "Plain words in a first line.\nA second line follows here, with more words in it.", "en", "a"),
        (2, None, "en", "a"), (3, "", None, "b"), (4, " \n\t ", "en", None), (None, "A row without an id has words too.", "fr", "a"),
        (5, long, "en", "b"), (6, "Plain words in a first line.\nA second line follows here, with more words in it.", None, "b"),
        (6, "Plain words in a first line.\nA second line follows here, with more words in it.", None, "b"),
        (7, "one", "de", "c"), (8, "trailing  space  \n\n and <|endoftext|> marks é 日本 😀", "en", "c"), (None, None, None, None),
    ]


@pytest.fixture(scope="session")
def tokens():
    """Ids of a text by the tokenizer itself, whole."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(common.tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids
