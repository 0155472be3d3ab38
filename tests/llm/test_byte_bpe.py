"""Byte-level BPE against the tiktoken library, and its pre-tokens against the pattern."""

import base64
import hashlib
import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from matchloom.llm import byte_bpe, queries

PATH = public_tokenizers.path(queries.RANKS)
SIGNS = list("abstrevmldSTl''''''  \n\t\r 12é漢٣½!?.,-_\x85\xa0　​́\x1c\x1f😀 ͅ")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        out.append((doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())))
    return Counter(out)


def random_texts(rng, n):
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_pre_tokens_are_the_matches_of_the_pattern(monkeypatch):
    rng = random.Random(1)
    for block in (2, 5, 64):
        monkeypatch.setattr(byte_bpe, "BLOCK", block)
        for _ in range(1500):
            texts = random_texts(rng, rng.randrange(5))
            points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
            ends = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
            wanted = [a + m.start() for a, t in zip(ends, texts, strict=False) for m in regex.finditer(public_tokenizers.PATTERN, t)]
            assert byte_bpe.pre_tokens(points, ends).tolist() == wanted, texts


def test_ids_of_random_texts(library):
    rng, known = random.Random(2), byte_bpe.Vocabulary(PATH)
    for _ in range(3000):
        texts = random_texts(rng, rng.randrange(5))
        ids, counts = byte_bpe.encode_texts(texts, known)
        wanted = [library.encode_ordinary(t) for t in texts]
        assert ids.tolist() == [i for w in wanted for i in w] and counts.tolist() == [len(w) for w in wanted], texts


def test_ids_of_every_character(library):
    known = byte_bpe.vocabulary(PATH)
    texts = [f"a{chr(c)}a1{chr(c)}1 {chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 7 == 0)]
    ids, counts = byte_bpe.encode_texts(texts, known)
    wanted = library.encode_ordinary_batch(texts, num_threads=4)
    assert counts.tolist() == [len(w) for w in wanted] and ids.tolist() == [i for w in wanted for i in w]


def test_memory_of_pieces_is_bounded(library, monkeypatch):
    known = byte_bpe.Vocabulary(PATH)
    monkeypatch.setattr(byte_bpe.Vocabulary, "CACHED_PIECES", 50)
    text = " ".join(f"word{i} {i}th" for i in range(500))
    for _ in range(3):
        assert byte_bpe.encode_texts([text], known)[0].tolist() == library.encode_ordinary(text)
        assert len(known.cache) <= 50 + len(set(text.split())) * 2


def test_long_pieces_and_texts_in_seconds(library):
    known, start = byte_bpe.Vocabulary(PATH), time.time()
    for text in ("a" * 300_000, "ab" * 100_000 + " " * 100_000, "\n" * 200_000 + "x", "it's " * 200_000):
        ids, _ = byte_bpe.encode_texts([text], known)
        assert ids.tolist() == library.encode_ordinary(text)
    assert time.time() - start < 60


def test_any_run_of_tokens_decodes():
    known = byte_bpe.Vocabulary(PATH)
    text = "Étion dans 漢字 it's   fine\n\n😀 1234."
    ids, _ = byte_bpe.encode_texts([text], known)
    offsets = np.concatenate([[0], np.cumsum(known.sizes[ids])])
    for a in range(len(ids) + 1):
        for b in range(a, len(ids) + 1):
            assert known.decoded(ids[a:b], offsets[a : b + 1]).tobytes() == text.encode()[offsets[a] : offsets[b]]
    with pytest.raises(ValueError, match="offsets"):
        known.decoded(ids, offsets + np.arange(len(offsets)))


def test_query_over_documents(spark, library):
    directory = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in queries.op12_byte_bpe(spark, directory).collect()) == expected(library, rows)


def test_query_over_awkward_rows(spark, library, tmp_path):
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate([None, "", " ", "\n", "'s", "x" * 200_000, " \x00 ", "don't 'LL 'll", *random_texts(rng, 200)])]
    rows += [(3, "again"), (3, "again"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("ids", "offsets", "decoded", "n_tokens")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert Counter(tuple(r) for r in queries.op12_byte_bpe(spark, str(tmp_path)).collect()) == expected(library, rows)
    again = byte_bpe.decode(byte_bpe.encode(docs, PATH), PATH).select("doc_id", "decoded").collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in again) == Counter((i, (t or "").encode()) for i, t in rows)


def test_query_over_no_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op12_byte_bpe(spark, str(tmp_path)).count() == 0
