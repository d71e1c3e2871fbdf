"""Single-byte charsets on top of the reader's ISO-8859-1.

The delimited reader decodes ISO-8859-1, which maps every byte to the character of the same number. A
charset that differs from it only above 0x7F is then a character-for-character translation, which stays
inside the JVM and keeps large files splittable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _differences(charset: str) -> tuple[str, str]:
    latin, target = [], []
    for number in range(0x80, 0x100):
        char = bytes([number]).decode(charset, errors="ignore")
        if char and char != chr(number):
            latin.append(chr(number))
            target.append(char)
    return "".join(latin), "".join(target)


def from_latin(text: Column, charset: str) -> Column:
    """Text read as ISO-8859-1 to what ``charset`` meant."""
    latin, target = _differences(charset)
    return F.translate(text, latin, target)


def to_latin(text: Column, charset: str) -> Column:
    """Inverse of :func:`from_latin`, for writing a file in ``charset``."""
    latin, target = _differences(charset)
    return F.translate(text, target, latin)
