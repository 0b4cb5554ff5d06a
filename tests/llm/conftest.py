import random

import pytest

WORDS = [f"w{i}" for i in range(400)]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_rows(rng: random.Random) -> list[tuple]:
    """NULLs, blanks, a long text, ties and repeated rows."""
    long = prose(rng, 3000)
    text = prose(rng, 120)
    return [
        (1000, None),
        (1001, ""),
        (1002, " \t\n"),
        (1003, "one"),
        (1004, "One"),
        (1005, long),
        (1006, long),
        (None, text),
        (None, text),
        (1007, text),
        (1007, text),
    ]


@pytest.fixture(scope="session")
def corpus(spark):
    """Texts with copies, near copies, shared passages and odd rows, in a table with clashing column names."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        rows.append((i, prose(rng, rng.randint(1, 300))))
    for i in range(60, 75):
        words = rows[i - 60][1].split()
        for _ in range(len(words) // 60):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    passage = prose(rng, 55)
    for i in range(75, 85):
        rows.append((i, f"{prose(rng, rng.randint(0, 40))} {passage}\n{prose(rng, rng.randint(0, 40))}"))
    for i in range(85, 95):
        rows.append((i, rows[i - 85][1].upper() if i % 2 else rows[i - 85][1]))
    rows += odd_rows(rng)
    rows = [(i, t, "en", f"s{(i or 0) % 3}", 0, 1, 2, "x") for i, t in rows]
    names = "doc_id long, text string, lang string, source string, n_chars long, dropped_id long, component long, bucket string"
    return spark.createDataFrame(rows, names).repartition(4)


@pytest.fixture(scope="session")
def nothing(corpus):
    return corpus.limit(0)


def words_of(text: str | None) -> list[str]:
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
