"""Alignment of two tokenizers against a plain walk over all token ends, by the libraries themselves."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from chatloom.llm import align
from chatloom.llm.align import aligned_tokens, gallop, run_starts, windows

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
#: White space of all kinds, special strings, characters beyond the vocabulary, the pieces' own space, runs without spaces.
TEXTS = [
    "The cat sat  on\n the mat.", "a", " ", "  ", "x ", " x", "\n", "tab\there \t there", "a <|endoftext|> b<|endoftext|>", "<s> </s><unk> <0x41>",
    "naïve café – “quoted”   end   ", "漢字かな交じり文 テスト", "wide　space thin  x  y\u0085 z  q  r", "a▁b c", "emoji 😀😀 🏳️‍🌈 done", "I'll we've don't 'S",
    "x" * 3000 + " " + "ab" * 500, "1234567 89.01e-5", "def f(x):\n    return x\r\n\r\n  end", "\x00 null\x00 byte", "\x1c\x1d sep \x1f x", "word " * 700, None, "",
]


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = align.byte_letters()
    per, count = [], Counter()
    for key, text in rows:
        if not text:
            per.append((key, [], [], []))
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            per.append((key, [], [], []))
            continue
        groups, links, i, j, at_a, at_b, now_a, now_b = [], [], 0, 0, 0, 0, [], []
        while i < len(ids_a) and j < len(ids_b):  # a step per stretch of bytes inside one token of either side
            links.append((ids_a[i], ids_b[j]))
            if not now_a or now_a[-1][0] != i:
                now_a.append((i, ids_a[i]))
            if not now_b or now_b[-1][0] != j:
                now_b.append((j, ids_b[j]))
            end_a, end_b = at_a + len(bytes_a[i]), at_b + len(bytes_b[j])
            if end_a <= end_b:
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                j, at_b = j + 1, end_b
            if end_a == end_b:
                groups.append(",".join(str(x) for _, x in now_a) + "|" + ",".join(str(x) for _, x in now_b))
                now_a, now_b = [], []
        count.update(links)
        per.append((key, ids_a, ids_b, links, groups))
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for key, ids_a, ids_b, links, *groups in per:
        digest = hashlib.sha256(";".join(groups[0]).encode()).hexdigest() if links else ""
        out.append((key, len(ids_a), len(ids_b), len(groups[0]) if links else 0, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), digest))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]


def order(rows):
    return sorted(rows, key=str)


def test_equals_a_walk_over_all_ends(spark):
    rows = [*enumerate(TEXTS), (3, "The cat sat  on\n the mat."), (None, "a b c"), (None, "a b c")]
    docs = spark.createDataFrame([(k, t, 1, "n") for k, t in rows], "doc_id long, text string, n_a int, block string").repartition(3)
    assert order(rows_of(aligned_tokens(docs, A, B))) == order(brute(rows))


def test_small_windows_and_blocks_give_the_same(spark, monkeypatch):
    """In this process, as workers have their own constants."""
    texts = [t for t in TEXTS if t] * 3
    runs = align.Runs(A, B)
    whole, size = runs.entries([t.encode() for t in texts])
    ends = np.cumsum(size)
    monkeypatch.setattr(align, "WINDOW_BYTES", 64)
    again = align.Runs(A, B)
    parts, size_again = again.entries([t.encode() for t in texts])
    for i, t in enumerate(texts):
        a, b = whole[ends[i] - size[i] : ends[i]], parts[np.cumsum(size_again)[i] - size_again[i] :][: size_again[i]]
        assert b"".join(runs.text[e] for e in a) == b"".join(again.text[e] for e in b), t
        assert runs.n_links[a].sum() == again.n_links[b].sum()
        assert b"".join(windows(t.encode())) == t.encode()


def test_gallop_equals_binary_search():
    rng = np.random.default_rng(1)
    for n, m in ((1, 1), (5, 50), (100, 100), (700, 9000)):
        long = np.unique(rng.integers(0, 3 * m, m))
        short = np.sort(rng.choice(np.arange(long[-1] + 1), n))
        want = np.searchsorted(long, short)
        low = np.maximum(want - rng.integers(0, 40, n), 0)
        assert (gallop(short, long, low) == want).all()
        assert (gallop(short, long, np.zeros(n, int)) == want).all()


@pytest.mark.parametrize("white", ["\u0085", " ", " ", " ", " ", " ", " ", "　", " ", "\n", "\t"])
def test_no_run_begins_behind_white_space(white):
    text = f" a{white} b".encode()
    assert run_starts(np.frombuffer(text, np.uint8)).tolist() == ([2] if white == " " else [])


def test_letters_at_word_ends_let_runs_begin():
    assert len(run_starts(np.frombuffer(" né ß 漢 д x".encode(), np.uint8))) == 4


def test_one_run_of_many_links(spark):
    """A third of all rows are one text without spaces."""
    rows = [(i, "z" * 2000) for i in range(30)] + [(100 + i, f"text number {i} of many") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert order(rows_of(aligned_tokens(docs, A, B))) == order(brute(rows))


def test_empty_table(spark):
    assert rows_of(aligned_tokens(spark.createDataFrame([], "doc_id long, text string"), A, B)) == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert order(rows_of(aligned_tokens(docs, A, B))) == order(brute(rows))
