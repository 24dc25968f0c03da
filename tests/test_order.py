"""Queries that a sum's last bit decides, against their SQL on rows that lie in several files."""

import random

import duckdb
import pandas as pd
import pytest

from fringelake.plans import queries as Q

NAMES = ["rank_noise", "masked_phase", "coherence_mask", "gated_lines"]


@pytest.fixture(scope="module")
def parted(tmp_path_factory):
    """Groups of nine rows whose mean c is 0.3 or 0.5 and whose prices are the same ones in other orders, dealt to six files."""
    path, rng, rows = tmp_path_factory.mktemp("parted"), random.Random(5), []
    (path / "lineitem.parquet").mkdir()
    prices = [round(rng.uniform(900, 100_000), 2) for _ in range(9)]
    for pixel in range(10, 3010, 10):
        for scene in (1, 2):
            total = 25 if pixel % 20 else 45
            cents = [rng.randint(0, 10) for _ in range(9)]
            while sum(cents) != total:
                k = rng.randrange(9)
                cents[k] = min(10, max(0, cents[k] + (1 if sum(cents) < total else -1)))
            rng.shuffle(prices)
            rows += [(pixel, scene, x, c / 100) for x, c in zip(prices, cents, strict=True)]
    rng.shuffle(rows)
    table = pd.DataFrame(rows, columns=["l_partkey", "l_linenumber", "l_extendedprice", "l_discount"])
    for k in range(6):
        table.iloc[k * 900 : (k + 1) * 900].to_parquet(path / f"lineitem.parquet/part-{k}.parquet", index=False)
    return path


@pytest.mark.parametrize("name", NAMES)
def test_sums_in_row_order(spark, parted, name):
    con = duckdb.connect()
    con.execute("set threads = 1")  # several threads sum in an order of their own
    con.execute(f"create view lineitem as select * from '{parted}/lineitem.parquet/*.parquet'")
    want = con.execute(Q.oracle_sql()[name]).df()
    got = Q.queries()[name](spark, str(parted)).toPandas()[list(want.columns)]
    assert len(want)
    keys = [c for c in ("scene", "pixel") if c in want]
    pd.testing.assert_frame_equal(got.sort_values(keys, ignore_index=True), want.sort_values(keys, ignore_index=True), check_dtype=False)
