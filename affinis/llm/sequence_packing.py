"""Token sequences packed first-fit decreasing, in randomised groups, with a tournament tree over bin capacities.

Documents are dealt to groups of about ``group_bytes`` of text by a hash of the row's place in the input, whatever
their id, source or text, so a hot source or a large set of copies is spread evenly and each group has the corpus'
mix of lengths. A group is tokenised and packed by one call with bounded memory; ids never travel.

1. A document of ``width`` ids or more gives full sequences of its own and a remainder.
2. Remainders, longest first, each go to the first open bin that has room. Bins are leaves of a tournament tree: every
   inner node holds the larger room of its two children, so the first bin with room is found from the root in
   log(bins) steps.
3. Whole ids / ``width`` bins, the fullest, stay. The others are emptied, and their documents are cut to fill what
   room is left in the bins that stay.
4. The rest of the group, less than one ``width``, is cut into sequences of the powers of two that sum up to it.

So no sequence needs padding, and only the documents of a few bins of a group are cut. Ids are 32-bit.

Defined results: a document is its ids and the end id; null and empty texts have the end id alone. Repeated rows are
packed as often as they occur. A text is tokenised between ASCII white space, where the vocabulary's own splitting
rule always ends a token, so a worker meets each distinct word once; words of small letters, which the rules leave as they
are, go to the model alone. Tests hold that against whole texts. A vocabulary
file has a fixed size of a few MB and goes to the tasks as text.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 2048
END_ID = 1
GROUP_BYTES = 8_000_000
#: Distinct words whose ids one worker keeps before it starts anew; bounds its memory, not the result.
CACHED_WORDS = 500_000


class RoomTournament:
    """Open bins by number; finds the first one with enough room."""

    def __init__(self, width: int, n_bins: int):
        self.leaves = 1
        while self.leaves < n_bins:
            self.leaves *= 2
        self.room = [width] * (2 * self.leaves)
        self.used = 0

    def place(self, size: int) -> tuple[int, int]:
        """(bin, room before) of the first bin that takes ``size``."""
        node, room = 1, self.room
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        number, before = node - self.leaves, room[node]
        room[node] = before - size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        self.used = max(self.used, number + 1)
        return number, before


def first_fit_decreasing(lengths: Iterable[int], width: int) -> list[int]:
    """The bin of each length (1 to ``width``, falling)."""
    lengths = list(lengths)
    bins = RoomTournament(width, max(1, len(lengths)))
    return [bins.place(length)[0] for length in lengths]


def powers_of_two(n: int) -> list[int]:
    """The powers of two that sum up to ``n``, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack_group(lengths: list[int], width: int = WIDTH) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; no sequence but of full width or a power of two.

    ``lengths`` are positive.
    """
    out, n = [], 0
    rest = []
    for at, length in enumerate(lengths):
        for start in range(0, length - width + 1, width):
            out.append((at, start, width, n, 0))
            n += 1
        if length % width:
            rest.append((length % width, at, length - length % width))
    rest.sort(key=lambda r: (-r[0], r[1]))
    bins: dict[int, list[tuple[int, int, int]]] = {}
    for item, number in zip(rest, first_fit_decreasing((r[0] for r in rest), width), strict=True):
        bins.setdefault(number, []).append(item)
    filled = sorted(bins.values(), key=lambda items: -sum(r[0] for r in items))
    stay = sum(r[0] for r in rest) // width
    loose = [item for items in filled[stay:] for item in items]
    rooms = [(items, width) for items in filled[:stay]]
    rooms += [([], size) for size in powers_of_two(sum(r[0] for r in rest) % width)]
    for items, size in rooms:
        offset = 0
        for length, at, start in items:
            out.append((at, start, length, n, offset))
            offset += length
        while offset < size:
            length, at, start = loose.pop()
            taken = min(length, size - offset)
            out.append((at, start, taken, n, offset))
            offset += taken
            if taken < length:
                loose.append((length - taken, at, start + taken))
        n += 1
    return out


#: Bytes that texts are cut at; ASCII capitals fold, as the vocabulary's own normaliser does first of all.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPECIAL = b"<|"  # special tokens are found before folding
#: ASCII signs that may be cut from a word's end; not those of special tokens, nor the apostrophe, which may join letters.
_SIGNS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_BETWEEN, _JOIN = b"\x01", b" \x01 "
#: UTF-8 lead bytes of U+00C0 to U+023F: letters, but for two signs.
_LATIN = range(0xC3, 0xC9)
#: Words of small letters a to z and U+00DF to U+00FF alone, which the vocabulary's normaliser and splitting rule leave whole.
_LETTERS = re.compile(rb"(?:[a-z]|\xC3[\x9F-\xB6\xB8-\xBF])+").fullmatch


def _head(word: bytes) -> bytes:
    """The word without the signs at its end, if it ends there in a letter or digit that nothing joins to them.

    The vocabulary's own rule then makes at least one token of the head and one of the signs.
    """
    head = word.rstrip(_SIGNS)
    if not head or len(head) == len(word):
        return word
    last = head[-1]
    if last < 0x80:
        return head if head[-1:].isalnum() else word
    if len(head) > 1 and head[-2] in _LATIN and head[-2:] not in (b"\xc3\x97", b"\xc3\xb7"):
        return head
    return word


class WordIds(dict):
    """Ids of words as bytes, each tokenised once."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(vocabulary)
        # The same model for words of letters: no normaliser, and white space for the splitting rule.
        parts = json.loads(vocabulary)
        parts["normalizer"], parts["pre_tokenizer"]["pretokenizers"][0] = None, {"type": "WhitespaceSplit"}
        self.of_letters = Tokenizer.from_str(json.dumps(parts))
        names, suffix = parts["model"]["vocab"], parts["model"]["end_of_word_suffix"]
        self.ends_word = np.zeros(max(names.values()) + 1, bool)
        self.ends_word[[number for name, number in names.items() if name.endswith(suffix)]] = True
        (self.between,) = self.tokenizer.encode(_BETWEEN.decode(), add_special_tokens=False).ids

    def learn(self, words: set[bytes]) -> None:
        """Adds ids of new words; signs after a word are tokenised apart from it, so the word is met once."""
        new = words - self.keys()
        if len(self) + len(new) > CACHED_WORDS:
            known = {word: self[word] for word in words - new}
            self.clear()
            self.update(known)
        heads = {word: _head(word) for word in new}
        plain = set(heads.values())
        plain.update(word[len(head):] for word, head in heads.items() if len(head) < len(word))
        plain -= self.keys()
        letters = set(filter(_LETTERS, plain))
        self._tokenise_letters(list(letters))
        self._tokenise(list(plain - letters))
        for word, head in heads.items():
            if len(head) < len(word):
                self[word] = self[head] + self[word[len(head):]]

    def _tokenise_letters(self, words: list[bytes]) -> None:
        """Ids of words of letters, each of which is one token to the rules: its last id alone ends a word."""
        if not words:
            return
        texts = [b" ".join(words[k:k + 64]).decode() for k in range(0, len(words), 64)]
        found = self.of_letters.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(f.ids, "<u4") for f in found])
        raw, ends = ids.tobytes(), (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist()
        self.update(zip(words, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))

    def _tokenise(self, words: list[bytes]) -> None:
        """Ids of many words a call, told apart by the id of a sign between them that none of them has."""
        encode = self.tokenizer.encode_batch_fast
        some = [w for w in words if _BETWEEN not in w]
        lines = [some[k:k + 64] for k in range(0, len(some), 64)] + [[w] for w in words if _BETWEEN in w]
        texts = [_JOIN.join(line).decode() for line in lines]
        for line, found in zip(lines, encode(texts, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            raw, at = ids.tobytes(), 0
            ends = np.flatnonzero(ids == self.between) if len(line) > 1 else ()
            for word, end in zip(line, [*(4 * k for k in ends), len(raw)], strict=True):
                self[word] = raw[at:end]
                at = end + 4

    def of(self, texts: list[bytes | None], end_id: int) -> list[np.ndarray]:
        """Little-endian 32-bit ids of UTF-8 texts, each with the end id."""
        split = [spaced_words(t) for t in texts]
        self.learn(set().union(*split))
        end = np.array([end_id], "<u4").tobytes()
        return [np.frombuffer(b"".join(map(self.__getitem__, words)) + end, "<u4") for words in split]


def spaced_words(text: bytes | None) -> list[bytes]:
    """Runs of anything but ASCII white space."""
    if not text:
        return []
    return text.split() if _SPECIAL in text else text.translate(_FOLD).split()


PIECE = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def read_vocabulary(path: str) -> str:
    """The text of a tokenizer file."""
    with open(path, encoding="utf-8") as lines:
        return lines.read()


def grouped_documents(docs: DataFrame, doc_id: str, text: str, group_bytes: int) -> DataFrame:
    """(part, row, doc_id, text), part being a random group."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    size = narrow.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    n_groups = max(1, -(-size // group_bytes))
    numbered = narrow.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return numbered.select(F.pmod(F.xxhash64("row"), F.lit(n_groups)).alias("part"), "row", "doc_id", "text")


def pack_sequences(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
    end_id: int = END_ID, group_bytes: int = GROUP_BYTES, with_ids: bool = False,
) -> DataFrame:
    """One row per piece (``PIECE``); ``with_ids`` adds the piece's ids as little-endian 32-bit numbers.

    ``sequence_id`` is unique over the corpus; a sequence's pieces fill it from offset 0 without a gap.
    """
    grouped = grouped_documents(docs, doc_id, text, group_bytes)
    schema = PIECE.format(id=grouped.schema["doc_id"].dataType.simpleString()) + (", ids binary" if with_ids else "")
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def place(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(sent.value)
        rows, names, ids = [], [], []
        for batch in batches:
            rows += batch.column("row").to_pylist()
            names.append(batch.column("doc_id"))
            ids += encode.of(batch.column("text").to_pylist(), end_id)
        # rows arrive in any order: their place in the input decides
        order = np.argsort(np.array(rows, np.int64), kind="stable").tolist()
        pieces = pack_group([len(ids[k]) for k in order], width)
        own = [(ids[order[p[0]]], p) for p in pieces]
        cut = [whole[p[1]:p[1] + p[2]].tobytes() for whole, p in own]
        base = key[0].as_py() << 32
        columns = [
            pa.chunked_array(names).combine_chunks().take(pa.array([order[p[0]] for p in pieces], pa.int64())),
            pa.array([p[1] for p in pieces], pa.int64()), pa.array([p[2] for p in pieces], pa.int64()),
            pa.array([zlib.crc32(c) for c in cut], pa.int64()), pa.array([len(whole) for whole, _ in own], pa.int64()),
            pa.array([base + p[3] for p in pieces], pa.int64()), pa.array([p[4] for p in pieces], pa.int64()),
        ] + ([pa.array(cut, pa.binary())] if with_ids else [])
        fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        yield pa.RecordBatch.from_arrays(columns, names=fields[:len(columns)])

    return grouped.groupBy("part").applyInArrow(place, schema)


_ENCODERS: dict[int, WordIds] = {}


def _encoder(vocabulary: str) -> WordIds:
    """One encoder per worker and vocabulary, whatever the number of groups."""
    name = hash(vocabulary)
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = WordIds(vocabulary)
    return _ENCODERS[name]
