import random

import pytest

SCHEMA = "doc_id long, text string, source string, n_chars long, row int, gone string, id string, key double, lines array<int>"


def _prose(seed: int, n: int, each: int = 9) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    chosen = [rng.choice(words) for _ in range(n)]
    return "\n".join(" ".join(chosen[i : i + each]) for i in range(0, n, each))


@pytest.fixture(scope="session")
def texts():
    """Null, empty, blank, short, repeated, near and very long texts, shared passages and lines on many sites."""
    base = _prose(1, 300)
    words = base.split(" ")
    near = " ".join([*words[:100], "altered", *words[101:]])
    passage = " ".join(_prose(2, 30).split())
    out = [None, "", " \n\t ", "one", "one", "two words", "a b c d e", base, base, base, near, passage + " " + _prose(3, 80)]
    out += [_prose(4, 60) + "\n" + passage, passage, "echo " * 200, _prose(5, 30_000), "MIT License\nGNU General  Public License, apache license cc by"]
    out += ["# $ % é 漢字   x y <a|b> & naïve\r\n\x00 end", "gnu general public license gnu general public license"]
    out += [f"{_prose(100 + i, 70)}\nhome about contact\n{_prose(200 + i, 20)}\n\nshared by nine" if i < 9 else f"{_prose(100 + i, 70)}\nhome about contact" for i in range(12)]
    return out


@pytest.fixture(scope="session")
def rows(texts):
    """(id, text, source): ids out of order, one repeated, one null; one source null and one with a third of all rows."""
    out = [((i * 7) % 101, t, "hot" if i % 3 == 0 else f"site{i}") for i, t in enumerate(texts)]
    return out + [(None, texts[7], "site1"), (None, "null id", None), (7, "again", "hot"), (7, "again", "hot")]


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    data = [(i, t, s, len(t or ""), 1, "x", "y", 0.5, [1]) for i, t, s in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
