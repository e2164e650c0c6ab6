import random

import pytest

SF_DIR = "/root/testdata/sf0.001"
STRUCT = "doc_id long, text string, lang string, source string, n_chars long, ids string, spans int, n_words int, _row string"


@pytest.fixture(scope="session")
def documents(spark):
    """The driver's documents and hard cases: null, empty, long, repeated, without key, strange characters, clashing columns."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    rnd = random.Random(7)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(60))
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    long = prose(30_000)
    extra = [
        None, "", " \n\t ", "one", "Two words", long, "the " * 3000, passage, f"{prose(50)} {passage} {prose(20)}", f"{passage}\n{prose(80)}",
        "mail a@b.c_x@d.e, 1.2.3.4.5.6.7.8 and 999.1.1.1 +1 (988) 555-2485 4111 1111 1111 1111 4111-1111-1111-1112",
        "it's we'll 'tis <|endoftext|> é漢\U0001F600 　 ͸ x\n\n  y  ", "# | $ % & < > *\n# | $ % & < > *\n\n", "a.a." * 4000 + "@" + "1" * 9000,
    ]
    copy = prose(400).split()
    for k in range(12):
        words = list(copy)
        for _ in range(k):
            words[rnd.randrange(len(words))] = "other"
        extra.append(" ".join(words))
    rows += [(100_000 + k, text) for k, text in enumerate(extra)]
    rows += [rows[0], rows[0], rows[-1], (None, "a text without a key"), (None, copy[0])]
    return rows


@pytest.fixture(scope="session")
def table(spark, documents):
    values = [(key, text, "en", "s" if k % 3 else None, None, "x", 1, 2, "y") for k, (key, text) in enumerate(documents)]
    return spark.createDataFrame(values, STRUCT).repartition(3)


@pytest.fixture
def empty(table):
    return table.limit(0)
