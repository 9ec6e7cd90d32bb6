"""Evidence beside a stretch is found word by word as the pattern finds it."""

import random

from tallyforge.llm import pii


def test_evidence_equals_the_pattern():
    r = random.Random(4)
    pieces = ["at", "AT", "one", "Two", "phone", "seven", "ſeven", "fıve", "SİX", "_at", "at_", "caféat", "İ", "٣", "²", "K", "7", "@", ".", " ", "\n", "-", "e", "１", "oh", "that", "eight", "\U0001d7d8", "Σ"]
    for i in range(4000):
        t = "".join(r.choice(pieces if i % 2 else pieces[:6] + pieces[16:21]) + r.choice(["", " ", " "]) for _ in range(r.randint(0, 14)))
        lo, hi = sorted((r.randint(0, len(t)), r.randint(0, len(t))))
        assert pii.evidence(t, lo, hi).tolist() == [m.start() for m in pii.EVIDENCE.finditer(t, lo, hi)], (t, lo, hi)


def test_evidence_is_not_searched_by_the_pattern(monkeypatch):
    monkeypatch.setattr(pii, "EVIDENCE", None)
    assert pii.evidence("call 5 at nine, Nina", 0, 20).tolist() == [5, 7, 10]


def test_evidence_of_plain_text_is_found_with_its_ends(monkeypatch):
    r = random.Random(5)
    pieces = ["at", "AT", "one", "Two", "phone", "that", "_at", "at_", "7", "@", ".", " ", "\n", "-", "e", "oh", "\x1f", "\x7f"]
    texts = ["".join(r.choice(pieces) + r.choice(["", " "]) for _ in range(r.randint(0, 14))) for _ in range(3000)] + ["at at at", "one\tone"]
    want = []
    for t in texts:
        lo, hi = sorted((r.randint(0, len(t)), r.randint(0, len(t))))
        want.append((t, lo, hi, [m.start() for m in pii.EVIDENCE.finditer(t, lo, hi)]))
    monkeypatch.setattr(pii, "_in_word", None)  # no hit inside another word is looked at
    for t, lo, hi, found in want:
        assert pii.evidence(t, lo, hi).tolist() == found, (t, lo, hi)
