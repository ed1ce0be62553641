"""Token alignment against whole encodes and byte by byte overlap."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lakemill.llm import token_align
from lakemill.llm.tokens import byte_alphabet

SCHEMA = "doc_id long, text string, chunk int, pairs string, n_a string, `a.b` int"
FILES = token_align.Vocabularies(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def cases():
    long = " ".join(f"word{i % 313} naïveté, {i}" + ("\n" if i % 40 == 0 else "") for i in range(4000))
    found = [
        "the quick brown fox jumps over the lazy dog", "the  quick   brown\tfox\n\n jumps ", " lead", "  two lead", "tail  ",
        "x▁y", "a ▁b", "<|endoftext|> and <s> x </s> <0x41> <unk>", "Ünïcödé ß 日本語 \U0001F600 don't  stop\x0bhere",
        "ａ　ﬁne  x", "\x00a\x00 b", "x" * 5000, long, "", None, " ", "\n", "日本語のテキスト" * 30, "don't the the the",
        "the quick brown fox jumps over the lazy dog", "12345 67,890.12 a_b-c(d)[e]{f}", "é ́x",
    ]
    return [(None if k == 4 else k % 19, t) for k, t in enumerate(found)]


def plain(found):
    a_model = Tokenizer.from_file(FILES.a)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=FILES.b)
    letters = {c: b for b, c in enumerate(byte_alphabet())}
    a_bytes = lambda i: bytes(letters[c] for c in a_model.id_to_token(i))
    b_bytes = lambda i: bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
    docs = []
    for doc_id, text in found:
        a = a_model.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_model.encode(text or "", num_threads=1)
        want = (" " + (text or "")).encode()
        if not text or b"".join(map(a_bytes, a)) != want or b"".join(map(b_bytes, b)) != want:
            docs.append((doc_id, [], [], [], []))
            continue
        # Which token each byte belongs to.
        of_a = [k for k, i in enumerate(a) for _ in a_bytes(i)]
        of_b = [k for k, i in enumerate(b) for _ in b_bytes(i)]
        links = sorted(set(zip(of_a, of_b)))
        ends = lambda of: {p + 1 for p in range(len(of)) if p + 1 == len(of) or of[p + 1] != of[p]}
        cuts = sorted(ends(of_a) & ends(of_b))
        groups = []
        for start, end in zip([0, *cuts], cuts):
            part = lambda of, ids: ",".join(str(ids[k]) for k in sorted(set(of[start:end])))
            groups.append(part(of_a, a) + "|" + part(of_b, b))
        docs.append((doc_id, a, b, [(a[i], b[j]) for i, j in links], groups))
    counts = collections.Counter(p for *_, links, _ in docs for p in set(links))
    most = {}
    for (i, _), n in counts.items():
        most[i] = max(n, most.get(i, 0))
    return [
        (d, len(a), len(b), len(g), len(l), sum(counts[p] == most[p[0]] for p in l), sum(counts[p] for p in l),
         hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
        for d, a, b, l, g in docs
    ]


@pytest.mark.parametrize("docs_in_chunk", [2, 4096])
def test_alignment_equals_brute_force(spark, monkeypatch, docs_in_chunk):
    monkeypatch.setattr(token_align, "CHUNK_DOCS", docs_in_chunk)
    df = spark.createDataFrame([(i, t, 1, "p", "x", 2) for i, t in cases()], SCHEMA).repartition(3)
    got = [tuple(r) for r in token_align.token_align(df, FILES).collect()]
    assert collections.Counter(got) == collections.Counter(plain(cases()))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert token_align.token_align(none, FILES).collect() == []
    only = spark.createDataFrame([(1, None, 1, "p", "x", 2)], SCHEMA)
    assert [tuple(r) for r in token_align.token_align(only, FILES).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_windows_are_remembered_and_small():
    aligner = token_align.Aligner(FILES)
    text = "the quick brown fox and the quick brown dog " * 200
    a, b = aligner.tokens(text)
    windows, _ = token_align.windows_of(aligner, a, b)
    assert len(windows) > 1500 and len(set(windows)) < 15
    assert np.array_equal(np.frombuffer(b"".join(w[0] for w in windows), "uint32"), a)
    assert np.array_equal(np.frombuffer(b"".join(w[1] for w in windows), "uint32"), b)
    chunk = token_align.Chunk(0, aligner)
    chunk.add("1", text)
    chunk.add("2", text + text)
    assert len(chunk.groups) == len(set(windows)) and chunk.docs[0][4] != chunk.docs[1][4]


@pytest.mark.parametrize("whole", [0, 10**6])
def test_pieces_of_whole_texts(monkeypatch, whole):
    """Word by word or whole, B gives the library's ids; whole texts leave the cache of words alone."""
    monkeypatch.setattr(token_align, "WHOLE_CHARS", whole)
    pieces = token_align.PieceTokenizer(public_tokenizers.path("piece_bpe_32k.model"))
    for text in ["a", " two  spaces ", "tab\tand\nline", "Straße 東京 😀 don't", "word " * 50, "x" * 300]:
        assert pieces.ids(text).tolist() == pieces.model.encode(text), text
    assert bool(pieces.cache) == (whole == 0)
