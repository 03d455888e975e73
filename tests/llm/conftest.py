"""A small table of odd and ordinary documents."""

from __future__ import annotations

import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id string, chunk int, body string, n int, first string, line string, n_lines int, gone int, key string, component long"


def corpus(seed: int = 5) -> list[tuple[int | None, str | None]]:
    """Nulls, empty and long texts, exact and near copies, shared passages and lines, repeated rows and ids."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = say(70), "Shared line " + say(9)
    rows: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, " \n\t\x0b "), (4, "one"), (5, "one"), (6, "a b c d e"), (7, "A B C D E")]
    base = [say(rng.randint(20, 200)) for _ in range(12)]
    for k, text in enumerate(base):
        rows += [(10 + k, text), (40 + k, text), (70 + k, f"{say(5)} {text} {say(4)}")]
    for k in range(15):
        rows.append((100 + k, f"{say(30)}\n{line}\n{passage}\n{say(20)}"))
    rows += [(200, "x" * 3000), (201, "ab" * 500), (202, ("ha " * 400).strip()), (203, ("ha " * 420).strip()), (204, say(3000)), (205, "no\x00nul " * 30)]
    rows += [(200, "x" * 3000), (None, base[0]), (11, "other text for an id that is there " + say(30)), (300, "\n".join([line, "", " " + line + " "] * 3) + "\n" + say(60))]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


def table(spark, rows):
    full = [(i, t, None if k % 7 == 0 else "en", f"s{k % 14}" if k % 9 else None, len(t or ""), "id", k, None, 1, "f", "l", 2, 3, None, 4) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return table(spark, rows).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


def as_set(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(v is None, v) if not isinstance(v, str) else (False, v) for v in r])


def same(got, want):
    order = lambda r: [str(v) for v in r]
    assert sorted(map(tuple, got), key=order) == sorted(map(tuple, want), key=order)
