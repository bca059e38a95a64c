"""Words and word-window hashes of UTF-8 texts, as bytes and NumPy arrays.

Separators are ASCII in every definition here, so splitting the UTF-8 bytes gives the same words as
splitting the text.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Upper-case ASCII letters fold to lower case; other ASCII signs separate; bytes of non-ASCII letters stay.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Distinct words whose hashes one worker keeps before it starts anew; bounds its memory, not the result.
CACHED_WORDS = 1_000_000

_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
NO_HASHES = np.empty(0, np.uint64)


def folded_words(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of letters and digits: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; null has none."""
    return text.translate(FOLD).split() if text else []


def plain_words(text: bytes | None) -> list[bytes]:
    """Runs of anything but white space, unchanged: ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return text.split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers, every output bit depending on every input bit."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of ``width`` consecutive words, by its start; windows are joined from halves."""
    return mixed(_joined(hashes, width)) if len(hashes) >= width else NO_HASHES


def _joined(hashes: np.ndarray, width: int) -> np.ndarray:
    if width == 1:
        return hashes
    half = width // 2
    part = _joined(hashes, half)
    n = len(hashes) - width + 1
    out = part[:n] * np.uint64(pow(_STEP, half, 1 << 64)) + part[half:half + n]
    if width % 2:
        out = out * np.uint64(_STEP) + hashes[width - 1:width - 1 + n]
    return out


def signed(value: int) -> int:
    """The same 64 bits as a signed long."""
    value &= _MASK
    return value - (1 << 64) if value >> 63 else value
