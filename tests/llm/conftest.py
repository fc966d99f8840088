import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, digest string, found string, state string, row string"


def words(draw: random.Random, n: int) -> list[str]:
    return ["".join(draw.choice(["th", "er", "on", "é", "an", "A", "ßt"]) for _ in range(draw.randint(1, 4))) for _ in range(n)]


def make_documents() -> list[tuple]:
    """Copies, near copies, shared passages, periodic and very long texts, nulls, blanks and repeated rows."""
    draw = random.Random(5)
    base = [words(draw, draw.choice([3, 12, 60, 200])) for _ in range(25)]
    passage = words(draw, 130)
    texts = [" ".join(w) for w in base]
    for w in base[:8]:
        near = list(w)
        near[len(near) // 2] = "changed"
        texts += [" ".join(w), " ".join(near), "\n".join(" ".join(near[i : i + 7]) for i in range(0, len(near), 7))]
    texts += [" ".join(words(draw, 10) + passage + words(draw, k)) for k in (0, 5, 40)]
    texts += ["\n".join([" ".join(passage[k : k + 9]) for k in range(0, 126, 9)] + [t]) for t in ("one", "two", "three")]
    texts += ["ab" * 900, "x " * 500, " ".join(words(draw, 6000)), "", " \t\n ", "\n\n\n", None, None, "Ab", "aB"]
    rows = [(k, t, "en" if k % 3 else None, f"src{k % 4}" if k % 5 else None, len(t) if t is not None else None) for k, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[1], None, None, None), (None, None, None, None, None)]
    return [(*r, "c", "d", "f", "s", "r") for r in rows]


@pytest.fixture(scope="session")
def rows():
    return make_documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row) -> tuple:
    return tuple((x is not None, x) if not isinstance(x, bool) else (True, int(x)) for x in row)


def same(df, expected: list[tuple]) -> None:
    assert sorted(map(key, map(tuple, df.collect()))) == sorted(map(key, expected))
