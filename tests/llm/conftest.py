import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import prose  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, _id string"
@pytest.fixture(scope="session")
def corpus():
    """(id, text) rows: nulls, empty and long texts, copies, near copies, shared passages, repeated rows and ids."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(5, 120)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(40, base[3]), (41, base[3]), (42, base[4] + " more"), (43, base[5][:-1] + "x"), (44, base[6].upper())]
    rows += [(50, base[7][20:160] + "\n" + base[8]), (51, "Shared line of some length here.\n" + base[9]), (52, "Shared line of some length herE.\n\n" + base[10])]
    rows += [(60, None), (61, ""), (62, " \n\t "), (63, "ñ"), (64, prose(rng, 6000)), (None, base[11] + "\n" + prose(rng, 30)), (None, "only here, no id")]
    rows += [(65, "漢字テスト " * 30), (66, "aaaa" * 60), (67, "aaaa" * 50), (-5, "aaaa" * 14 + " end")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with extra columns whose names operators use."""
    rows = [(i, t, "en", f"s{(i or 0) % 4}" if i != 7 else None, 0, 99, 0.5, "x") for i, t in corpus]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
