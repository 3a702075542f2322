"""Small tables for the tests of annolake.llm."""

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


LONG = " ".join(f"word{k % 977} and{k % 13}" for k in range(40_000))
ODD = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r ", "en", None, 7),
    (4, LONG, "en", "a", len(LONG)), (5, "one two", None, "b", 7), (5, "one two", None, "b", 7),
    (None, "three four five six seven eight nine ten eleven twelve", "de", "b", 50),
    (6, "Été naïve \U0001f600\U0001f600 x́ Straße İ ΑΣ end", "fr", "cé", 20),
    (7, "a b c d e f g a b c d e f g\na b c d e f g\na b c d e f g\n#### $$ |", "en", None, 60),
    (8, "x" * 5000, "en", "a", 5000), (9, "<|endoftext|> it's <s> <0x41> ▁▁ mark   spaces", "en", "a", 40),
]


def odd(spark):
    """Nulls, empty and white texts, a very long text, one long word, repeated rows, and columns whose names clash
    with those the operators make."""
    return spark.createDataFrame(
        [(*r, "x", 1.5, 2, True) for r in ODD],
        DOCS + ", fp string, score double, _score int, kept boolean").withColumnsRenamed({})


def empty(spark):
    return spark.createDataFrame([], DOCS + ", size int, taken int")
