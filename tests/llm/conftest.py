import random

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, text_ string, kept boolean, T string"


def prose(rng: random.Random, n: int) -> str:
    parts = ["the", "and", "of", "ren", "tion", "ing", "she", "our", "ble", "wan", "é", "que"]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", ". ", "\n", "  "]) for w in words).strip()


def corpus() -> list[tuple]:
    """Rows with nulls in any column, empty and long texts, copies, near copies, repeated rows and clashing columns."""
    rng = random.Random(7)
    texts = [None, "", "   ", "\n\n", "one", "a b c", "x" * 700, "ab" * 400, "Don't  stop\n\n'tis we'll <|endoftext|> 've\t end "]
    base = [prose(rng, rng.randint(60, 400)) for _ in range(40)]
    texts += base
    texts += [base[0]] * 6 + [base[1].replace("the", "THE")] + [base[2] + " tail"] + [base[3][:900] + prose(rng, 60)] * 1
    passage = prose(rng, 90).replace("\n", " ")
    line = "Licensed under the public terms of this site"
    for k in range(14):
        texts.append(prose(rng, 80) + "\n" + passage + "\n" + line + "\n" + prose(rng, 30))
    texts += ["### $$$ %%% " * 40 + prose(rng, 60), "same words here again " * 60, "line one is here\n" * 40 + prose(rng, 70)]
    texts.append(" ".join(base * 3))
    rows = []
    for i, t in enumerate(texts):
        rows.append((None if i in (12, 13) else i, t, rng.choice(["en", "de", None]), rng.choice([f"s{k}" for k in range(12)] + [None]),
                     None if t is None else len(t), "extra", i % 2 == 0, "clash"))
    rows += [rows[20], rows[20], rows[0]]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    # T differs from text by more than case, so names stay resolvable.
    return spark.createDataFrame(rows, COLUMNS).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
