import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, rank bigint, part int, "
    "shard string, salt string, tie string, n_tokens string, kept string, length string, key string, words string"
)
PROSE = "Anat with by of nteres atre are, thnt eringing onheed with the.\nThe heerly es of that and onnt tionorre."


@pytest.fixture(scope="session")
def messy_texts():
    return [
        None, "", "   ", "\n\n\n", "a", PROSE, PROSE, PROSE.upper(), "x<|endoftext|>y <|startoftext|> z", "don't it's I'LL 's",
        "Tab\tand  two blanks \n and\r\nline", "Σας ΣΑΣ é é ŉ İx 日本語 テキスト 😀👍🏽", "no break narrow wide", "12 3² ½ #$%&|<>*",
        "a\x1cb \x1d c", "zz" * 30_000, "word " * 5_000, PROSE * 400, "é" * 2_000, " lead", "trail ", "<|endoftext|>",
    ]


@pytest.fixture(scope="session")
def messy(spark, messy_texts):
    """Nulls in every column, empty and very long texts, repeated rows, and columns whose names may clash."""
    rows = [(i, x, *("en", "s", 3), *[None] * 11) for i, x in enumerate(messy_texts)]
    rows += [(5, PROSE, "en", "s", 3, *[None] * 11)] * 2 + [(None, PROSE, *[None] * 14), (None, None, *[None] * 14)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
