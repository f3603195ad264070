"""The buckets of a word's beginnings, whatever way they are computed."""

import zlib

import numpy as np

from starmill.llm import toxicity


def test_features_are_the_checksums_of_beginnings_and_word():
    for word in ["a", "ab", "abc", "abcd", "abcdefgh", "abcdefghij", "straße", "äb", "жжжжжжжжжж", "一二三"]:
        marks = [f"^{word[:k]}" for k in range(3, 9) if k <= len(word)] + [f"={word}"]
        assert toxicity.features(word) == [zlib.crc32(m.encode()) % toxicity.FEATURES for m in marks]


def test_a_beginning_goes_on_from_the_one_before(monkeypatch):
    """An ASCII word of 8 letters takes a checksum of 3 letters, five of one letter, and its own."""
    seen, crc32 = [], zlib.crc32
    monkeypatch.setattr(toxicity.zlib, "crc32", lambda data, *start: seen.append(len(data)) or crc32(data, *start))
    toxicity.features("abcdefghij")
    assert sorted(seen) == [1, 1, 1, 1, 1, 3, 10]


def test_plain_words_need_no_search(monkeypatch):
    reader = toxicity.Reader(toxicity.log_probabilities(np.zeros(toxicity.SYMBOLS ** 4)))
    monkeypatch.setattr(toxicity, "_CORE", None)
    assert reader.read("Straße") == ("straße",) and reader.read("plain") == ("plain",)
