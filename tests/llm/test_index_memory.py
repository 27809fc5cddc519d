"""What the index keeps of a segment while it reads it."""

from meterlake.llm.decontaminate import numbered, words_of


def test_words_of_a_segment_are_kept_as_numbers_of_four_bytes():
    numbers: dict[bytes, int] = {}
    first = numbered(words_of("One two, one THREE"), numbers)
    second = numbered(words_of("three four"), numbers)
    assert first.tolist() == [0, 1, 0, 2] and second.tolist() == [2, 3]
    assert list(numbers) == [b"one", b"two", b"three", b"four"]
    assert first.nbytes == 16 and numbered([], numbers).tolist() == []
