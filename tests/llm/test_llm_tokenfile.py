import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixture import corpus, frame

from corvid.llm import tokenfile

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

BPE = public_tokenizers.path("word_bpe_49k.json")


def brute(rows):
    """(doc_id, start, n_tokens, crc) in file order; equal ids only need equal id lists."""
    tok, out, start = Tokenizer.from_file(BPE), [], 0
    for i, t in sorted(((r[0], r[1] or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = tok.encode(t, add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_against_the_tokenizer(spark, tmp_path):
    rows = [r for r in corpus(n=80) if r[0] is not None and r[0] != 1004]
    folder = str(tmp_path / "t")
    m = tokenfile.write(frame(spark, rows), folder, BPE, seq_len=64, batch_rows=8).collect()
    got = sorted(tuple(r) for r in tokenfile.read_documents(spark, folder).collect())
    assert got == sorted(brute(rows))
    assert sum(r["n_ids"] for r in m) == sum(g[2] for g in got) and sum(r["n_docs"] for r in m) == len(rows)
    # The sequences of all files, masks applied, are the documents' ids in order.
    seqs = sorted(tokenfile.sequences(spark, folder).collect(), key=lambda r: r["sequence"])
    assert [r["sequence"] for r in seqs] == list(range(len(seqs))) and all(len(r["ids"]) == len(r["mask"]) == 64 for r in seqs)
    flat = np.concatenate([np.array(r["ids"])[np.array(r["mask"]) == 1] for r in seqs]).astype("<u4")
    for _, start, n, crc in got:
        assert zlib.crc32(flat[start: start + n].tobytes()) == crc


def test_random_access_copies_nothing(spark, tmp_path):
    folder = str(tmp_path / "t")
    m = tokenfile.write(frame(spark, corpus(n=60)), folder, BPE, seq_len=32, batch_rows=4).collect()
    name = max(m, key=lambda r: r["n_ids"])["file"]
    f = tokenfile.TokenFile(folder, name)
    before = pa.total_allocated_bytes()
    pieces = [f[i] for i in range(len(f))]
    assert pa.total_allocated_bytes() - before < 64 * 32 and not pieces[0][0].flags.owndata and len(pieces) > 8
    assert all(len(ids) == len(mask) == 32 and ids.dtype == np.uint16 for ids, mask in pieces)
    assert all(mask.true_count == 32 for _, mask in pieces[:-1])
    ids = np.concatenate([i[k.to_numpy(zero_copy_only=False)] for i, k in pieces])
    assert np.array_equal(ids, np.concatenate(list(f.runs())))
    with pytest.raises(IndexError):
        f[len(f)]


def test_nulls_repeats_empty_and_string_ids(spark, tmp_path):
    rows = corpus(n=30) + [(5, "same id", "x", "y"), (5, "same id", "x", "y"), (5, "other", "x", "y")]
    tokenfile.write(frame(spark, rows), str(tmp_path / "a"), BPE)
    got = tokenfile.read_documents(spark, str(tmp_path / "a")).collect()
    assert sorted((str(g[0]), g[2], g[3]) for g in got) == sorted((str(b[0]), b[2], b[3]) for b in brute(rows))
    spans = sorted((g["start"], g["start"] + g["n_tokens"]) for g in got)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert min(g["start"] for g in got if g["doc_id"] is not None) >= max(g["start"] for g in got if g["doc_id"] is None)
    again = str(tmp_path / "b")
    tokenfile.write(frame(spark, rows, 3), again, BPE, file_bytes=1 << 12)
    assert sorted(map(str, tokenfile.read_documents(spark, again).collect())) == sorted(map(str, got))
    tokenfile.write(frame(spark, []), str(tmp_path / "c"), BPE)
    assert tokenfile.read_documents(spark, str(tmp_path / "c")).collect() == []
    text = spark.createDataFrame([("b", "two"), ("a", None), ("é", "x")], "doc_id string, text string")
    tokenfile.write(text, str(tmp_path / "d"), BPE)
    out = tokenfile.read_documents(spark, str(tmp_path / "d")).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == ["a", "b", "é"] and out[0]["n_tokens"] == 1


def test_words_of_any_text(monkeypatch):
    """Word by word, in small caches, equals the whole text at once."""
    monkeypatch.setattr(tokenfile, "CACHE_WORDS", 50)
    monkeypatch.setattr(tokenfile, "CACHE_WORD", 6)
    monkeypatch.setattr(tokenfile, "JOINED", 40)
    rng = random.Random(1)
    parts = ["a", "B", "'s", " ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "　", "̈", "̧", "é", "Σ", "1", "23", "#", ".", ",",
             "!", "<|endoftext|>", "<|ENDOFTEXT|>", "😀", "ᄒ", "ᅡ", "İ", "'", "S", "​", "\x00", ")", "word", "Lower"]
    for words in (True, False):
        enc = tokenfile.WordEncoder(BPE, "<u2", words)
        for _ in range(20):
            texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(100)]
            flat, counts = enc(pa.array(texts, pa.large_string()))
            for t, ids in zip(texts, np.split(flat, np.cumsum(counts)[:-1])):
                assert ids.tolist() == enc.tok.encode(t, add_special_tokens=False).ids
    assert tokenfile.id_type(BPE, 2) == "<u2" and tokenfile.id_type(BPE, 70000) == "<u4"
