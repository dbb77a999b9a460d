"""Small stored tables with every awkward case: nulls in any column, empty and
very long texts, repeated rows and ids, and columns named like outputs."""

from __future__ import annotations

import random

import pytest

CLASH = "score double, fp long, row_id long, spans string, kept boolean, label int, ids string, n_words int, _row long, _dropped long"
CLASHING = (0.5, 1, 2, "x", True, 1, "y", 3, 4, 5)


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuv") for _ in range(rng.randint(2, 9))) for _ in range(n))


BENCH = words(900, 30)
PASSAGE = words(901, 70)


def texts() -> list[tuple[int | None, str | None]]:
    rows: list[tuple[int | None, str | None]] = [(i, words(i, 60 + 7 * i)) for i in range(1, 25)]
    rows += [(30, words(1, 67)), (31, words(1, 67)), (31, words(1, 67))]  # copies of 1, one row twice
    rows += [(40, None), (41, ""), (42, " \t\n"), (43, "one"), (44, "ein zwei"), (None, words(50, 90)), (None, None)]
    rows += [(45, "x" * 5000), (46, "long " * 30000), (47, "ü€𝄞" * 400)]
    rows += [(60 + i, f"{words(60 + i, 30)} {PASSAGE} {words(160 + i, 25)}") for i in range(4)]
    changed = BENCH.split()
    changed[7] = changed[19] = "replaced"
    rows += [(70, f"{words(70, 40)} {BENCH} {words(71, 40)}"), (71, f"{words(72, 40)} {' '.join(changed)}")]
    # One word changed in a long text: few fingerprint bits differ.
    near = words(80, 400).split()
    rows += [(80, " ".join(near)), (81, " ".join([*near[:200], "other", *near[201:]]))]
    return rows


@pytest.fixture(scope="session")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("llm")

    def write(df, name):
        df.write.parquet(str(root / name))
        return spark.read.parquet(str(root / name))

    return write


@pytest.fixture(scope="session")
def docs(spark, store):
    rows = [(d, t, "en", None, None, *CLASHING) for d, t in texts()]
    return store(spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}").repartition(3), "docs")


@pytest.fixture(scope="session")
def empty(docs, store):
    return store(docs.limit(0), "empty")


@pytest.fixture(scope="session")
def labels(spark, store):
    rows = [(i, i % 2, (i // 2) % 2) for i in range(1, 25)] + [(None, 1, 1), (3, None, None), (99999, 1, 0), (5, 1, 0)]
    return store(spark.createDataFrame(rows, "doc_id long, quality int, toxic int"), "labels")


@pytest.fixture(scope="session")
def benchmark(spark, store):
    rows = [(1, BENCH), (1, BENCH), (2, None), (3, ""), (4, "too short"), (None, words(999, 20)), (5, words(998, 6))]
    return store(spark.createDataFrame([(*r, *CLASHING) for r in rows], f"item_id long, text string, {CLASH}"), "benchmark")
