"""What the driver takes to learn the class model: its result and little besides."""

import tracemalloc

import numpy as np

from bookpipe.llm import quality
from bookpipe.llm.quality import CLASSES, ORDER, SIZE


def at_once(counts):
    """The same table with all numbers of a level at once."""
    levels = [counts]
    for _ in range(ORDER - 1):
        levels.append((levels[-1].reshape(CLASSES, -1) > 0).sum(axis=0))
    lower = np.full(1, 1.0 / CLASSES)
    for level in reversed(levels):
        table = level.reshape(-1, CLASSES).astype("float64")
        steps = quality.discounts(*(float((level == k).sum()) for k in (1, 2, 3, 4)))
        discount = np.select([table == 0, table == 1, table == 2], [0.0, steps[0], steps[1]], steps[2])
        total = table.sum(axis=1, keepdims=True)
        seen = np.maximum(total, 1.0)
        gamma = np.where(total > 0, discount.sum(axis=1, keepdims=True) / seen, 1.0)
        below = np.tile(lower, level.size // lower.size).reshape(-1, CLASSES)
        lower = ((table - discount) / seen + gamma * below).ravel()
    return np.log(lower).astype("float32")


def test_parts_give_the_same_table_in_less_memory():
    rng = np.random.default_rng(1)
    for counts in (rng.poisson(0.02, SIZE), rng.geometric(0.3, SIZE) * (rng.random(SIZE) < 0.1), np.zeros(SIZE), np.eye(1, SIZE, 7)[0]):
        counts = counts.astype("int64")
        want = at_once(counts)
        tracemalloc.start()
        got = quality.kneser_ney(counts)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert got.dtype == want.dtype and np.array_equal(got, want)
        assert peak < 2 * got.nbytes + 8 * SIZE // CLASSES * 20
        assert abs(np.exp(got.reshape(-1, CLASSES).astype("float64")).sum(axis=1) - 1).max() < 1e-4
