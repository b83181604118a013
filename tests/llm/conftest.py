import random

import pytest

SF = "/root/testdata/sf0.001"
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards boil magic potions"


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def corpus() -> dict[int, str | None]:
    """Copies, near copies, shared lines and passages, ties, null, empty and long texts."""
    rng = random.Random(5)
    word = lambda: rng.choice(["Alpha", "beta", "gamma", "Δelta", "x1", "e-f", "zeta,", "eta"])
    text = lambda n: " ".join(word() + str(rng.randint(0, 99)) for _ in range(n))
    docs: dict[int, str | None] = {1: None, 2: "", 3: " \n\t ", 4: "one", 5: "one", 6: "Two words"}
    base = text(120)
    for i in range(10, 30):
        docs[i] = base  # one group of exact copies
    for i in range(30, 45):
        near = base.split(" ")
        for _ in range(i % 5):
            near[rng.randrange(len(near))] = word()
        docs[i] = " ".join(near)
    line = "  A line that Many documents share, of well over forty characters \r"
    for i in range(45, 75):
        own = [text(rng.randint(1, 30)) for _ in range(4)]
        docs[i] = "\n".join([*own[:2], line if i % 2 else line.upper(), *own[2:], line])
    for i in range(75, 90):
        docs[i] = text(20) + f" {PASSAGE} " + text(20) + "\n" + PASSAGE.upper()
    docs[90] = text(6000)
    docs[91] = "a " * 200
    docs[92] = " nbsp　wide \x1c ctrl\x85 next"
    return docs


@pytest.fixture(scope="session")
def table(spark, corpus):
    """The corpus with extra columns whose names clash with working columns."""
    rows = [(i, t, "en", 7, -1) for i, t in corpus.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, row int, pos int")
    return df.repartition(3)


@pytest.fixture(scope="session")
def no_rows(table):
    return table.where("false")
