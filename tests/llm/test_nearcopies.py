"""The bounds that spare comparisons never lie below the truth."""

import numpy as np
from tidemark.llm import nearcopies


def some_sets(rng, sizes):
    pool = rng.integers(0, 1 << 63, 40_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sets = [np.unique(rng.choice(pool[: 3 * n + 1], n)) for n in sizes]
    return np.concatenate(sets), np.append(0, np.cumsum([len(x) for x in sets])), sets


def test_sketches_and_cells_bound_from_above():
    rng = np.random.default_rng(71)
    h, first, sets = some_sets(rng, [0, 1, 3, 15, 16, 17, 40, 60, 60, 200, 220, 900, 1100, 5000])
    sketches = [np.frombuffer(x, np.uint8) for x in nearcopies.sketches(h, first)]
    bits = nearcopies.cell_bits(h, first).view(np.uint64)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            shared = len(np.intersect1d(a, b))
            alone = sum(int(x & ~y).bit_count() for x, y in zip(bits[i], bits[j]))
            assert shared <= nearcopies.most_shared(sketches[i], sketches[j]) and shared <= len(a) - alone
        assert nearcopies.most_shared(sketches[i], sketches[i]) == len(a)


def test_a_full_cell_bounds_nothing():
    full = np.full(16, 255, np.uint8)
    assert nearcopies.most_shared(full, full) >= 1 << 30 and nearcopies.most_shared(full, np.zeros(16, np.uint8)) == 0
    assert nearcopies.most_shared(np.full(32, 200, np.uint8), full) >= 1 << 30
