"""Small documents with every awkward case, and helpers shared by these tests."""

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "kept boolean, `class` string, good int, __digest string, row int"
)
WORDS = "the quick brown fox jumps over the lazy dog and runs into the deep green wood".split()
LONG = " ".join(f"{word}{i % 97}" for i, word in enumerate(WORDS * 3000))
TEXTS = [
    (1, "Hello World, don't panic"), (2, "hello world, DON'T panic"), (3, ""), (4, None), (5, " \t\n "), (6, LONG), (7, LONG.upper()),
    (8, "é É ß straße 東京 😀 <|endoftext|> x"), (9, "É É ß straße 東京 😀 <|endoftext|> x"), (10, "one two"), (11, "12 34 !!"),
    (None, "no number"), (12, "no number"), (13, "a" * 5000), (14, "word " * 40), (14, "word " * 40), (None, None), (15, "x\r\ny  z \n"),
]


def docs(spark, texts=None, partitions=3):
    rows = [(i, t, "en", "s", None if t is None else len(t), True, "c", 1, "d", 2) for i, t in (TEXTS if texts is None else texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def plain(spark, texts):
    return spark.createDataFrame(list(texts), "doc_id bigint, text string")


def rows(df, *columns):
    """Rows as sorted tuples, nulls first."""
    found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda row: [(value is not None, value) for value in row])
