import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, id long, n_words string, hits int, h1 string, spans string"


def passage(seed: int, n: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Null, empty, blank and very long texts, copies, repeated rows, ties, shared lines and passages."""
    shared, item = passage(1, 60), passage(2, 30)
    found = [(0, None), (1, ""), (2, " \n\t\x0b "), (3, "one"), (4, "One  TWO"), (5, passage(5, 30_000)),
             (6, "x" * 50_000), (7, "ab " * 3_000), (8, "é É ß\nÄ " + passage(8, 40)), (8, "é É ß\nÄ " + passage(8, 40))]
    found += [(10 + k, f"{passage(100 + k, 40)} {shared} {passage(200 + k, 40)}") for k in range(5)]
    found += [(20 + k, passage(20, 200) + ("" if k < 3 else f" tail{k}")) for k in range(8)]
    found += [(40 + k, f"  Shared LINE {'' if k % 2 else ' '}\n{passage(300 + k, 25)}\nshared line\nrare {k % 6}") for k in range(12)]
    found += [(60, f"{passage(60, 50)} {item} {passage(61, 50)}"), (61, f"{item[:200]}"), (62, f"{item} {passage(62, 900)}")]
    found += [(70, "Write to a.b@x-y.org_c@d.com, 10.0.0.1 1.2.3.4.5.6.7.8 300.1.1.1 or +1 (212) 555-0100; "
                   "4111 1111 1111 1111 and 4111-1111-1111-1112, IBAN GB82 WEST 1234 5698 7654 32 (bank)"),
              (71, "1" * 30_000 + "." + "a." * 20_000 + "a@" + "b." * 20_000 + "c"), (72, "12.12.12 +12 é@é.com é 999.1.1.1")]
    return found


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with other columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 7, "n", 1, "h", "s") for i, t in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def unnamed(spark):
    """Rows whose id is null."""
    text = passage(20, 200)
    return spark.createDataFrame([(None, text, 7, "n", 1, "h", "s"), (None, text, 7, "n", 1, "h", "s"), (20, text, 7, "n", 1, "h", "s"),
                                  (None, None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(1, passage(2, 30)), (10, passage(2, 30)), (2, "one"), (3, None), (4, ""), (None, passage(2, 20))],
                                 "item_id long, text string")
