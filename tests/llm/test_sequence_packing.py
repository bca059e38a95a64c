"""Sequence packing against whole-text tokenising and a plain first fit."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from affinis.llm import queries, sequence_packing
from tests.llm.test_operators import SCHEMA, corpus

PATH = public_tokenizers.path(queries.WORD_VOCABULARY)
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole_ids():
    tokenizer = Tokenizer.from_file(PATH)

    def of(text):
        return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]

    return of


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(rows, texts, whole_ids, width=2048):
    """Every id in one piece, sequences gapless and without padding, checksums of the ids of whole texts."""
    wanted = defaultdict(list)
    for name, text in texts:
        wanted[name].append(whole_ids(text))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(wanted)
    for name, ids in wanted.items():
        cut = Counter((start, start + r["length"]) for r in pieces[name] for start in [r["start"]])
        assert sum(len(i) for i in ids) == sum(r["length"] for r in pieces[name])
        known = Counter(len(i) for i in ids)
        assert all(r["doc_tokens"] in known for r in pieces[name])
        if len(ids) == 1:
            at = 0
            for r in sorted(pieces[name], key=lambda r: r["start"]):
                assert r["start"] == at and r["length"] > 0
                assert r["ids_crc32"] == crc(ids[0][at:at + r["length"]])
                at += r["length"]
            assert at == len(ids[0]) and max(cut.values()) == 1
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
        total = own[-1][0] + own[-1][1]
        assert total <= width and (total == width or total & (total - 1) == 0)


def test_query_equals_whole_text_tokenising(spark, whole_ids):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op12_sequence_packing(spark, SF_DIR).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs], whole_ids)


def test_odd_rows(spark, whole_ids):
    odd = [
        (9000, "a\x0bb\x0cc\x85d e f\x1cg"), (9001, "x" * 5000), (9002, "İΣ ΟΔΟΣ ς"), (9003, "e ́é"),
        (9004, "<|endoftext|>word <|startoftext|> <|ENDOFTEXT|>"), (9005, "it's I'M 12 3!? 中文 字"), (9006, "\t\r\n "),
    ]
    odd += [(9007, "a\x01b \x01 \x01\x01. c\x01"), (9008, "é., é×. ×. 9!? e\u0301. ŉ. ß.), x)., ."), (9009, "Word. WORD, word; WoRd:?! <|")]
    texts = corpus() + odd
    docs = spark.createDataFrame([(i, t, "s", "en", "r", 1, 2, 0.5) for i, t in texts], SCHEMA).repartition(3)
    vocabulary = sequence_packing.read_vocabulary(PATH)
    for group_bytes in (8_000_000, 2_000):
        packed = sequence_packing.pack_sequences(docs, vocabulary, group_bytes=group_bytes, with_ids=True)
        rows = packed.collect()
        check(rows, texts, whole_ids)
        assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    assert packed.columns == "doc_id start length ids_crc32 doc_tokens sequence_id offset ids".split()


def test_same_result_again(spark):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string").repartition(3)
    vocabulary = sequence_packing.read_vocabulary(PATH)
    packed = [sorted(map(str, sequence_packing.pack_sequences(docs, vocabulary, group_bytes=9_000).collect()))
              for _ in range(2)]
    assert packed[0] == packed[1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert sequence_packing.pack_sequences(docs, sequence_packing.read_vocabulary(PATH)).collect() == []


def test_first_fit_equals_a_plain_search():
    rng = random.Random(2)
    for width in (1, 7, 64, 2048):
        lengths = sorted((rng.randint(1, width) for _ in range(300)), reverse=True)
        rooms, plain = [], []
        for length in lengths:
            at = next((k for k, room in enumerate(rooms) if room >= length), len(rooms))
            rooms[at:at + 1] = [(rooms[at] if at < len(rooms) else width) - length]
            plain.append(at)
        assert sequence_packing.first_fit_decreasing(lengths, width) == plain


def test_few_documents_are_cut():
    rng = random.Random(4)
    lengths = [int(rng.expovariate(1 / 300)) + 1 for _ in range(3000)] + [2048, 4096, 5000, 1]
    pieces = sequence_packing.pack_group(lengths)
    whole = Counter(p[0] for p in pieces)
    assert sum(p[2] for p in pieces) == sum(lengths)
    assert sum(n > 1 for at, n in whole.items() if lengths[at] < 2048) < 0.02 * len(lengths)


def words_of(text):
    return sequence_packing.spaced_words(text.encode())


def test_words_of_letters_skip_the_rules_with_the_same_ids(whole_ids):
    letters = ["thetionané", "ßüÿàöø", "a", "ÉtÉ", "x÷y", "×", "naïve%%%", "naïve", "word&&&", "schön)\"", "it's#", "l'", "ét"]
    signs = [f"{word}{sign}" for word in ("ab", "né", "a1", "'s", "ŉ") for sign in "!\"#$%&()*+,-./:;=?@[\\]^_`{}~<>|'"]
    signs += [f"ab{a}{b}" for a in "!#'|>_" for b in "!#'|>_"] + ["a<|endoftext|>", "a<|endoftext|>#", "<|x|>%", "#<|startoftext|"]
    ids = sequence_packing.WordIds(sequence_packing.read_vocabulary(PATH))
    rules = []
    whole = ids._tokenise
    ids._tokenise = lambda words: (rules.extend(words), whole(words))
    texts = [" ".join(letters), *letters, " ".join(signs), *signs]
    for text, found in zip(texts, ids.of([t.encode() for t in texts], 1), strict=True):
        assert found.tolist() == whole_ids(text), text
    assert not {"thetionané".encode(), "naïve".encode(), "naïve%%%".encode(), b"word"} & set(rules)
    assert "x÷y".encode() in rules and "×".encode() in rules


def test_a_full_store_keeps_the_words_of_the_batch(monkeypatch):
    monkeypatch.setattr(sequence_packing, "CACHED_WORDS", 6)
    ids = sequence_packing.WordIds(sequence_packing.read_vocabulary(PATH))
    ids.learn(set(words_of("one two three four")))
    met = []
    whole = ids._tokenise_letters
    ids._tokenise_letters = lambda words: (met.extend(words), whole(words))
    ids.learn(set(words_of("three four five six seven")))
    assert sorted(met) == [b"five", b"seven", b"six"] and b"one" not in ids
