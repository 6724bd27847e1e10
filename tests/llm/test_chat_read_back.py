"""Reading formatted conversations back: exact, and in the memory of a turn."""

import random
import tracemalloc

import pytest

from tickbook.llm import chat

PARTS = ["\\", "\\\\", "###", "</turn>", ":", ": ", "\n", "### user: ", "</turn>\n", "a", "é", "<", "/", "#", "\\1", "\\g<0>"]


def test_round_trip_of_control_strings():
    rng = random.Random(2)
    for _ in range(3000):
        turns = [("".join(rng.choices(PARTS, k=rng.randrange(4))), "".join(rng.choices(PARTS, k=rng.randrange(9))))
                 for _ in range(rng.randrange(5))]
        assert chat.read_back(chat.render(turns)) == turns


@pytest.mark.parametrize("broken", ["x", "### a", "### a: b", "### a:b</turn>\n", "### a: b</turn>", "### a: b\\</turn>\n"])
def test_other_strings_are_no_conversations(broken):
    with pytest.raises(ValueError):
        chat.read_back(broken)


def test_a_long_turn_needs_a_few_copies_of_itself():
    text = "words and \\ marks </turn> " * (8 << 20 >> 4)
    formatted = chat.render([("user", text)])
    tracemalloc.start()
    got = chat.read_back(formatted)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [("user", text)]
    assert peak < 12 * len(formatted)
