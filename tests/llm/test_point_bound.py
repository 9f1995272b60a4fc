"""The bound of points by coarse groups first, in narrow integers: the pairs of the bound written out."""
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import jaccard_join as J


def brute(a, b, percent, same):
    least = np.minimum(a[:, None, :], b[None, :, :]).sum(axis=2)
    on = (100 + percent) * least >= percent * (a.sum(axis=1)[:, None] + b.sum(axis=1))
    if same:
        return {tuple(sorted(x)) for x in zip(*map(np.ndarray.tolist, np.nonzero(on))) if x[0] != x[1]}
    return set(zip(*map(np.ndarray.tolist, np.nonzero(on))))


def found(a, b, percent, same):
    got = [(i, j) for p, q in J.candidates(a, b, percent, same) for i, j in zip(p.tolist(), q.tolist())]
    assert len(got) == len(set(got))
    return {tuple(sorted(x)) for x in got} if same else set(got)


# 511.97 a group: sizes on both sides of what 16 bits hold
@pytest.mark.parametrize("mean, kind", [(0.1, np.int16), (5, np.int16), (100, np.int16), (511.97, np.int32), (5e4, np.int32), (4e7, np.int64)])
@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_candidates_are_those_of_the_bound(mean, kind, percent):
    rng = np.random.default_rng(int(mean))
    a, b = (rng.poisson(mean, (n, 64)).astype(np.int64) for n in (90, 70))
    b[:20] = a[:20]
    b[10:20, 3] += 1 + int(mean)
    assert J._Bound(a, b, percent).kind is kind
    assert found(a, b, percent, False) == brute(a, b, percent, False)
    assert found(a, a, percent, True) == brute(a, a, percent, True)


def test_groups_that_do_not_fold_evenly_and_single_points():
    a, b = np.array([[3, 0, 1, 0, 2]]), np.array([[3, 0, 1, 0, 2], [0, 0, 0, 0, 6], [3, 0, 1, 2, 0]])
    assert found(a, b, 85, False) == {(0, 0)}
    assert found(a, a, 85, True) == set()


def test_the_first_bound_leaves_little_to_the_second(monkeypatch):
    """Coordinates of pairs that are looked at: a quarter, and few whole ones, of unlike documents of usual length."""
    rng, seen = np.random.default_rng(5), []
    a, b = (rng.poisson(4, (256, 64)).astype(np.int64) for _ in range(2))
    minimum = np.minimum
    monkeypatch.setattr(J.np, "minimum", lambda x, y: seen.append(np.broadcast_shapes(np.shape(x), np.shape(y))) or minimum(x, y))
    assert not found(a, b, 85, False)
    pairs = [s for s in seen if len(s) == 2 and s[0] in (16, 64) and s[1] > 32 or len(s) == 2 and s[1] == 64]
    looked_at = sum(x * y for x, y in pairs)
    assert looked_at < 0.6 * 256 * 256 * 64


def test_matrix_has_a_row_per_point():
    assert J._matrix(pa.table({"v": pa.array([np.arange(64, dtype=np.int32).tobytes()])})).tolist() == [list(range(64))]
