"""Packing against plain tokenization, all subsets, and the rules that a packing must keep."""

import random
import zlib
from itertools import product

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import packing
from ledgerlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def fullest(left, capacity):
    sums = {0}
    for n, count in left.items():
        sums = {a + k * n for a in sums for k in range(count + 1) if a + k * n <= capacity}
    return max(sums)


def test_every_combination_is_the_fullest():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.randrange(5, 40)
        counts = {rng.randrange(1, capacity + 1): rng.randrange(1, 9) for _ in range(rng.randrange(1, 8))}
        left = dict(counts)
        for times, chosen in packing.combinations(counts, capacity):
            for _ in range(times):
                assert sum(n * k for n, k in chosen) == fullest(left, capacity)
                for n, k in chosen:
                    left[n] -= k
                    assert left[n] >= 0
        assert not any(left.values())


def test_steps_do_not_grow_with_the_counts():
    counts = {n: 3 + n % 7 for n in range(1, 200, 3)}
    bound = len(counts) + sum(200 // n for n in counts)
    for times in (1, 1000, 10**9):
        assert len(packing.combinations({n: c * times for n, c in counts.items()}, 200)) <= bound


@pytest.fixture(scope="module")
def packed(spark):
    return [r.asDict() for r in QUERIES["op11_pack_sequences"](spark, SF).collect()]


def test_pieces_are_the_tokens_of_whole_documents(spark, packed):
    tokenizer = Tokenizer.from_file(packing.Settings().vocabulary)
    expected = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for i, start in enumerate(range(0, len(ids), 4096)):
            run = ids[start : start + 4096]
            expected[r["doc_id"], i] = (start, len(run), zlib.crc32(np.array(run, "<u4").tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in packed} == expected
    assert len(packed) == len(expected)


def rules_hold(rows, capacity=4096):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(by) == list(range(len(by)))
    return len(by)


def test_sequences_are_few_and_without_gaps(packed):
    assert rules_hold(packed) <= 1.01 * sum(r["length"] for r in packed) / 4096 + 1


def test_edges(spark, edges):
    rows = [r.asDict() for r in QUERIES["op11_pack_sequences"](spark, edges).collect()]
    rules_hold(rows)
    assert [r["length"] for r in rows if r["doc_id"] in (1, 2, 3)] == [1, 1, 1]
    copies = [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == 6]
    assert len(copies) == 2 * len(set(copies)) == 2 * len([r for r in rows if r["doc_id"] == 5])


def test_one_length_for_all(spark, tmp_path):
    """A length that all rows have is numbered across partitions."""
    docs = spark.range(0, 4001, numPartitions=9).selectExpr("id AS doc_id", "repeat('one two ', 300) AS text")
    rows = [r.asDict() for r in packing.packed(docs).collect()]
    assert rules_hold(rows) == -(-4001 // (4096 // 601))


def test_words_split_like_whole_texts():
    with open(packing.Settings().vocabulary, encoding="utf-8") as file:
        words = packing.WordIds(file.read(), packing.Settings())
    tokenizer = Tokenizer.from_file(packing.Settings().vocabulary)
    rng = random.Random(1)
    signs = ["<|endoftext|>", " ", "\n", "\x1c", "\x85", "　", "̈", "é", "e", "ΑΣ", "'ll", "don't", "5", "½", "한", "中文", "\t", "!?", "ﬁ", "İ"]
    signs += ["àÀß", "Straße,", "ÿ", "µ", "ªº", "e\u0301)", "I\u0307", "ñandú:", "×÷", ".$$$", "-", "_", "<", "|>", "a"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(30))) for _ in range(2000)] + ["".join(p) for p in product(signs, repeat=2)]
    for text, ids in zip(texts, words.ids_of(texts), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
