from __future__ import annotations

import pytest

from quipu.llm import pii
from tests.llm.test_text_operators import planted


@pytest.fixture(scope="module")
def model():
    return pii.learn([t[a:b] for t in planted() for a, b in pii.regions(t)])


@pytest.mark.parametrize(
    "cell, found",
    [
        ('"tel":"(578)555-6437","id":"ab",', "(578)555-6437"),
        ("電話、(578)555-6437、長い文" + "文" * 300, "(578)555-6437"),
        ("+1 (578) 555-6437 4918187128635271 ", "+1 (578) 555-6437"),
    ],
)
def test_long_runs_are_searched_to_their_end(model, cell, found):
    n = 100
    base, every = pii.spans(cell * n, model)
    more = sorted(set(every) - set(base))
    assert [s for s, e, k in more if k == 3 and (cell * n)[s:e] == found] == [i * len(cell) + cell.index(found) for i in range(n)]
    assert set(base) <= set(every) and len(every) == len(set(every))


def test_windows_cover_long_stretches_and_overlap():
    text = "see " + "7,x" * 900 + " and " + "文" * 2000 + "1" + "文" * 2000
    seen = list(pii.windows(text))
    assert all(end - start <= pii.REGION_CHARS and start <= first < last <= end for start, end, first, last in seen)
    owned = {i for _, _, first, last in seen for i in range(first, last)}
    assert all(i in owned for i, c in enumerate(text) if c.isdigit())
    assert sum(last - first for _, _, first, last in seen) == len(owned) < 2900
    for (_, end, _, last), (start, _, first, _) in zip(seen, seen[1:], strict=False):
        assert first >= end or (first == last and start <= first - pii.MAX_CHARS and end >= last + pii.MAX_CHARS)
