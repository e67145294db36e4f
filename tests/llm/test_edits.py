import random

import pytest

from stallwise.llm import edits


def by_hand(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


@pytest.mark.parametrize("letters", ["ab", "abcdefgh é🙂"])
@pytest.mark.parametrize("short", [0, 64])
def test_distances(letters, short, monkeypatch):
    monkeypatch.setattr(edits, "_SHORT", short)
    rnd = random.Random(4)
    x, y, most = [], [], []
    for _ in range(250):
        one = [rnd.choice(letters) for _ in range(rnd.randint(0, 200))]
        two = list(one) if rnd.random() < 0.7 else [rnd.choice(letters) for _ in range(rnd.randint(0, 200))]
        for _ in range(rnd.randint(0, 40)):
            at = rnd.randint(0, len(two))
            two[at : at + rnd.randint(0, 1)] = rnd.choice(["", rnd.choice(letters)])
        x.append("".join(one))
        y.append("".join(two))
        most.append(rnd.choice([0, 3, 20, 60, 300, len(one) // 5]))
    want = [d if (d := by_hand(a, b)) <= m else -1 for a, b, m in zip(x, y, most)]
    assert edits.distances(x, y, most).tolist() == want
    assert edits.distances([], [], []).tolist() == []
