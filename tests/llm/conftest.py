import os

import pytest

from doorstep.llm.shared import ship

SF = "/root/testdata/sf0.001"

#: Texts that operators have to take: null, empty, blank, odd, repeated, and long ones.
WORDS = "the river bank was quiet and the old boat lay still under a pale autumn sky"
ODD = [
    None, "", "", " \t\n", "a", "A b", "Don't  you'll\n\nI'm é,è 'S b　c", "×a é× ''s ('s 12,3",
    "<|endoftext|>", "x <|startoftext|> y", "🙂 naïve ﬁ Ω İSTANBUL", "line\nline\n\nline\r\nend",
    WORDS, WORDS, WORDS + " again", (WORDS + " ") * 400, "a" * 9000, "é" * 5000, "word " * 6000, "$$$ ### %%%",
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd texts, with repeated rows, a null id, and columns named like results."""
    ship(spark)
    rows = [(i, t, ["en", "de", None][i % 3], i * 1.0, "z") for i, t in enumerate(ODD)]
    rows += [rows[12], rows[12], (None, WORDS, "en", 0.5, "z"), (None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, score double, fp string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark, odd):
    return odd.where("doc_id < 0")


@pytest.fixture(scope="session")
def small(spark):
    ship(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture
def sf(tmp_path, odd, nothing):
    """Folders that hold tables as a query reads them."""

    def make(name="odd", **more):
        folder = str(tmp_path / name)
        (odd if name == "odd" else nothing).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
        for table, df in more.items():
            df.write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
        return folder

    return make


assert os.path.isdir(SF)
