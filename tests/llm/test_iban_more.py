"""Account numbers beside each other and of all countries of the registry."""

from __future__ import annotations

from seriesmill.llm import pii


def spans(text: str) -> list[str]:
    return [text[s:e] for s, k, e, _ in pii.find(text) if k == "iban"]


def test_neighbours():
    assert spans("BE68539007547034 BE43068999999501") == ["BE68539007547034", "BE43068999999501"]
    assert spans("XX00 BE68 5390 0754 7034 BE43068999999501 more") == ["BE68 5390 0754 7034", "BE43068999999501"]
    assert pii.masked("BE68539007547034 BE43068999999501") == "<IBAN> <IBAN>"
    assert spans("BE685390075470341 BE68539007547034x") == []


def test_countries():
    numbers = ["TR330006100519786457841326", "AE070331234567890123456", "SA0380000000608010167519", "IL620108000000099999999", "UA213223130000026007233566001", "RS35260005601001611379", "BR1800360305000010009795493C1"]
    for n in numbers:
        assert spans(f"pay {n}, please") == [n]
