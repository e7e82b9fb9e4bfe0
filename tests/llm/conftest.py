import random

import pytest

SF = "/root/testdata/sf0.001"


def tricky_texts():
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Épsilon", "zeta", "eta", "theta", "ioTA", "kappa", "ñu", "漢字", "😀"]
    prose = lambda n: " ".join(rnd.choice(words) + str(rnd.randrange(1000)) for _ in range(n))
    passage = prose(80)
    base = prose(150)
    near = base.split()
    near[70] = "changed"
    out = [None, "", "   \t\n\x0b\x0c\r ", "one", "One", "two words", "a b c d", "a b c d e", base, base, base.replace(" ", "\n", 3), " ".join(near)]
    out += [passage, prose(20) + " " + passage, passage + "\n" + prose(30), prose(10) + " " + passage + " " + prose(10)]
    out += ["a" * 5000, "ab " * 3000, prose(9000), "line one here\nline one here\n\nline one here\nother", "x" * 199, "y" * 200, "y" * 201]
    out += ["    nbsp İstanbul Kelvin", "😀" * 300, "😀" * 300, "\0nul\0 byte " * 30]
    return out


@pytest.fixture(scope="session")
def tricky(spark):
    """Documents with nulls in any column, repeats, clashing extra columns."""
    rows = [(i, t, "en", f"s{i % 4}" if i % 5 else None, len(t or ""), "extra", 1) for i, t in enumerate(tricky_texts())]
    rows += [rows[8], rows[8], (None, "no id here " * 30, None, None, None, None, None), (None, None, None, None, None, None, None)]
    kind = "doc_id long, text string, lang string, source string, n_chars long, kept string, digest int"
    return spark.createDataFrame(rows, kind).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
