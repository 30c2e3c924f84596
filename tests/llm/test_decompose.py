"""Power-of-two decomposition: round trip to the library's ids, exact lengths, consecutive numbers."""

import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from chatloom.llm.decompose import batches, binary_lengths, cut_documents, decomposed_documents, numbered

PATH = P.path("word_bpe_49k.json")
TEXTS = ["The cat's mat", "", None, "x", "naïve CAFÉ <|endoftext|> 漢字 42", "word " * 9000, "a b c " * 683 + "d", "\n\t ", "it's they're"]


def library_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def test_lengths_are_the_binary_digits():
    sizes = np.array([1, 2, 3, 2047, 2048, 2049, 6149])
    lengths, count = binary_lengths(sizes, 2048)
    assert count.tolist() == [1, 1, 2, 11, 1, 2, 5]
    assert lengths[-5:].tolist() == [2048, 2048, 2048, 4, 1]
    ends = np.cumsum(count)
    assert [int(lengths[e - c : e].sum()) for c, e in zip(count, ends, strict=True)] == sizes.tolist()
    assert binary_lengths(np.zeros(0, np.int64), 8)[0].tolist() == []


def test_round_trip(spark):
    docs = spark.createDataFrame([(i, t, 7, "n") for i, t in enumerate(TEXTS)], "doc_id long, text string, length int, task string").repartition(3)
    got = decomposed_documents(docs, PATH).collect()
    for i, text in enumerate(TEXTS):
        ids = library_ids(text)
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        at = 0
        for r in mine:
            assert r.start == at and r.doc_tokens == len(ids) and r.offset == 0
            assert r.length & (r.length - 1) == 0 and r.length <= 2048
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
        assert [r.length for r in mine] == sorted((r.length for r in mine), reverse=True)
        assert sum(r.length < 2048 for r in mine) == bin(len(ids) % 2048).count("1")


def test_numbers_run_without_gaps_by_length(spark):
    docs = spark.createDataFrame([(i, "word " * (i * 37 % 3000)) for i in range(120)], "doc_id long, text string").repartition(7)
    got = sorted(decomposed_documents(docs, PATH).collect(), key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in got] == list(range(len(got)))
    assert [r.length for r in got] == sorted(r.length for r in got)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None)], "doc_id long, text string")
    got = decomposed_documents(docs, PATH).collect()
    assert sorted((str(r.doc_id), r.start, r.length) for r in got) == [("1", 0, 4)] * 2 + [("None", 0, 1), ("None", 0, 4)]
    assert len({r.sequence_id for r in got}) == 4
    assert decomposed_documents(docs.limit(0), PATH).collect() == []


def test_other_capacities(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert [r.length for r in decomposed_documents(docs, PATH, capacity=1).collect()] == [1] * 7
    with pytest.raises(ValueError, match="power of two"):
        decomposed_documents(docs, PATH, capacity=2000)


def test_batches_hold_one_length(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 9)) for i in range(90)], "doc_id long, text string").repartition(4)
    got = batches(decomposed_documents(docs, PATH, capacity=8), 16).collect()
    size = {}
    for r in got:
        size.setdefault((r.length, r.batch), []).append(r.length)
    assert all(sum(x) <= 16 for x in size.values())
    for length in {r.length for r in got}:
        of_length = sorted(b for n, b in size if n == length)
        assert of_length == list(range(len(of_length)))
        assert all(len(size[length, b]) == 16 // length for b in of_length[:-1])


def test_numbering_equals_any_order_of_tasks(spark):
    docs = spark.createDataFrame([(i, "word " * i) for i in range(20)], "doc_id long, text string").repartition(6)
    pieces = numbered(cut_documents(docs, PATH, 1, 16)).collect()
    assert sorted(r.sequence_id for r in pieces) == list(range(len(pieces)))
