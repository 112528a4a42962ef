"""What a block of the neighbour search hands on does not grow with copies."""

import pyarrow as pa

from adlytics.operators.neighbours import BlockSearch, KeyPlan


def test_copies_hand_on_k_donors():
    side = [{"miss": 0, "lo": 0.0, "hi": 1.0, "spread": 0.5}] * 2
    plan = KeyPlan(side, side)
    q = pa.table({"qid": [1, 2], "v": [[0.0, 0.0], [0.0, 1.0]], "kappa": pa.array([0, 0], pa.int32())})
    ids = list(range(999, -1, -1))
    d = pa.table({"did": ids, "v": [[0.0, 0.0]] * 1000})
    i, slot, j, dist = BlockSearch(plan, 3, None, False, False)(q, d)
    assert len(i) == 2 * 3
    for row in (0, 1):
        assert sorted(ids[x] for x in j[i == row]) == [0, 1, 2]
