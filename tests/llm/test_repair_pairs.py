"""Re-Pair's exact pair counts, its lookup of chosen pairs, and the work of reading a block back."""

import time
from collections import Counter

import numpy as np
import pytest

from fringelake.llm import repair_tokens as R

FIRST = 49408


def block_of(ids, bounds):
    return R.Block(R.to_bytes(list(range(len(bounds) - 1)), ids, bounds, FIRST))


@pytest.fixture(scope="module")
def natural():
    """A block's worth of ids with frequencies like words' and repeated phrases."""
    rng = np.random.default_rng(3)
    phrases = rng.zipf(1.3, (20_000, 6)).clip(2, FIRST - 1).astype(np.uint16)
    ids = phrases[rng.zipf(1.2, 170_000).clip(1, 20_000) - 1].ravel()
    return ids, np.append(np.arange(0, len(ids), 700), len(ids))


def test_first_rules_are_the_most_frequent_pairs(natural):
    ids, bounds = natural
    across = set(bounds.tolist())
    count = Counter((int(a), int(b)) for i, (a, b) in enumerate(zip(ids[:-1], ids[1:], strict=True), 1) if i not in across)
    want = sorted((p for p, n in count.items() if n > 1), key=lambda p: (-count[p], p))[:500]
    assert [tuple(r) for r in R.compress(ids, bounds, FIRST, rules=500)[2][:500].tolist()] == want


def test_pairs_that_share_a_slot_are_told_apart():
    rng = np.random.default_rng(4)
    pair = rng.integers(0, 1 << 32, 300_000, dtype=np.uint32)
    keys = np.unique(pair[:50_000])  # many for the table's slots
    spots, at = R.located(pair, keys)
    assert (spots == np.flatnonzero(np.isin(pair, keys))).all() and (keys[at] == pair[spots]).all()


@pytest.mark.parametrize("text", ["one id", "long rules", "no rules", "one document each"])
def test_round_trip(text):
    ids = {"one id": np.full(100_000, 7), "long rules": np.tile(np.random.default_rng(1).integers(2, FIRST, 3000), 40), "no rules": np.arange(2, 40_000), "one document each": np.full(5000, 3)}[text].astype(np.uint16)
    bounds = np.arange(len(ids) + 1) if text == "one document each" else np.array([0, 10, len(ids)])
    b = block_of(ids, bounds)
    assert (b.expand(b.symbols) == ids).all()
    if text != "one document each":
        assert (b.ids(1, 5, 5000) == ids[15:5010]).all()


def test_a_block_is_read_back_without_a_pass_per_round(natural):
    b = block_of(*natural)
    assert (b.expand(b.symbols) == natural[0]).all()

    def least(f):
        times = []
        for _ in range(5):
            start = time.process_time()
            f()
            times.append(time.process_time() - start)
        return min(times)

    passes = least(lambda: np.cumsum(np.where(natural[0].astype(np.int64) > 5, 2, 1)))  # one pass over the block's ids
    assert least(lambda: b.expand(b.symbols)) < 4 * passes  # 2 now, 8 when each round of rules was a pass
