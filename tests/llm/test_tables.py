import sys

from hypothesis import given
from hypothesis import strategies as st

from tessera.llm.tables import Lately


@given(st.lists(st.sets(st.text("ab", max_size=7)), max_size=30), st.integers(0, 3000))
def test_lately_gives_what_is_made(batches, at_most):
    lately = Lately(at_most, 5)
    for keys in batches:
        assert lately.get(keys, lambda new: [k.upper() for k in new]) == {k: k.upper() for k in keys}
        assert lately.size <= lately.half and all(len(k) <= 5 for k in [*lately.newer, *lately.older])


def test_lately_is_bounded_and_keeps_what_is_asked_for():
    lately, made = Lately(1 << 20, 48), []

    def make(new):
        made.extend(new)
        return [b"x" * 40 for _ in new]

    for i in range(200):
        lately.get({"often", *(f"{i}-{j}" for j in range(300)), "y" * 100_000}, make)
        held = sum(100 + sys.getsizeof(k) + sys.getsizeof(v) for part in (lately.newer, lately.older) for k, v in part.items())
        assert held <= 1 << 20
    assert made.count("often") == 1 and made.count("y" * 100_000) == 200
