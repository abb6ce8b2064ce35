import random
from collections import Counter

import pytest
from brute import prose

from brightloom.llm import merkle


def near(a, b):
    return merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(b))


@pytest.mark.parametrize("limit", [40, 200])
def test_near_copies_on_both_sides_of_a_former_limit(limit):
    rng = random.Random(limit)
    for _ in range(50):
        text = prose(rng, 80)[: limit + rng.randint(0, 5)]
        short = text[: limit - rng.randint(1, 8)]
        assert near(text, short) >= 0.5
    text = prose(rng, 80)[: limit + limit // 7]
    assert near(text, merkle.edited(text, "x")) > 0.5


def test_runs_without_white_space_keep_likeness_behind_an_edit():
    rng = random.Random(3)
    kinds = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(600)), "".join(chr(rng.randint(0xE01, 0xE2E)) for _ in range(600)), "".join(rng.choice("ABCDEFGHIJabcdefghij0123456789+/") for _ in range(600))]
    for text in kinds:
        assert 0.8 < near(text, text[:300] + "Z" + text[301:]) < 1
        assert 0.8 < near(text, text[:300] + text[303:]) < 1


def test_unlike_texts_have_little_in_common():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    assert near(" ".join(rng.choices(words, k=200)), " ".join(rng.choices(words, k=200))) < 0.1


def test_roots_differ_by_white_space_alone():
    same = ["a b\n\nc d", "a b\n \nc d", "a b\n   \t \nc d", "a b\nc d", "a b\n\n\nc d", "a b\n\nc d\n", "\na b\n\nc d", "a b\n\nc d\n\n"]
    assert len({merkle.fingerprint(t)[:32] for t in same}) == len(same)
    assert len({merkle.fingerprint(t)[:32] for t in ("", "\n", "\n\n", "\n\n\n", " ")}) == 5


def exact(a, b):
    """Share of common phrases, all of them."""
    x, y = (Counter(p for line in t.split("\n") for p in merkle._PIECES.findall(line)) for t in (a, b))
    return 2 * (x & y).total() / (x.total() + y.total())


def test_long_sections_keep_a_sketch_and_its_likeness():
    rng = random.Random(6)
    for sections in (1, 3):
        text = "\n\n".join(prose(rng, 6000 if i == 0 else 300) for i in range(sections))
        fp = merkle.fingerprint(text)
        assert len(fp) < 33 + sections * (16 + 8 * merkle.SKETCH) + 8 * (text.count("\n") + sections)
        for other in (merkle.edited(text, prose(rng, 9000)), prose(rng, 5000), text[: len(text) // 2]):
            assert abs(near(text, other) - exact(text, other)) < 0.1
        assert near(text, text[:-20]) > 0.95 and near(text, prose(rng, 6000)) < 1
    b = text.replace("\n\n", "\n\n\n", 1)
    assert 0.99 < near(text, b) < 1


def test_descent_finds_moved_and_changed_paragraphs():
    a = "one one one\ntwo two two\n\nthree three\nfour four\n\nfive five"
    b = "one one one\ntwo TWO two\n\nfive five\n\nthree three\nfour four"
    assert merkle.changed(merkle.fingerprint(a), merkle.fingerprint(b)) == [(0, 1)]
    assert merkle.changed(merkle.fingerprint(""), merkle.fingerprint(a)) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]
