"""Documents that are out of the ordinary, and columns whose names get in the way."""

CLASHES = (
    "score shard grown_shard copy mix_key row key mark from lang_pred coverage secrets leaks fp kept "
    "clean_text predicted digest group start end data label verdict rule host path suffix _key _mark size"
).split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{c}` string" for c in CLASHES
)
LONG = "Some words that make a very long text, line by line.\n" * 6000
TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (None, "a text without an id", "en", "a"),
    (2, None, "en", None),
    (None, None, None, None),
    (3, "", "de", "b"),
    (4, " \n\t \r\x0b\x0c", None, "b"),
    (5, LONG, "en", "b"),
    (6, "twice the same row", "en", "b"),
    (6, "twice the same row", "en", "b"),
    (7, "ÀÉÎ ß 漢字 \U0001f600 İ ſ K", "xx", "c"),
    (8, "nul \0 inside", "en", "c"),
    (9, "1234 5678 !?", "en", "c"),
    (10, "a", "en", "c"),
]


def docs(spark, clashes=True):
    rows = [(i, t, l, s, len(t or ""), *(["x"] * len(CLASHES))) for i, t, l, s in TEXTS]
    df = spark.createDataFrame(rows, SCHEMA)
    return df if clashes else df.select("doc_id", "text", "lang", "source", "n_chars")


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def same_rows(a, b):
    order = lambda df: sorted(map(repr, df.collect()))
    return order(a) == order(b)
