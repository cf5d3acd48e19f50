"""Words as the operators on word grams see them."""

from __future__ import annotations

#: Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space. Bytes of other
#: letters in UTF-8 are above 0x7F and stay.
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased."""
    return text.translate(_TO_WORDS).split()
