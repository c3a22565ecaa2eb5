"""Token counts, byte-level BPE and token files against the libraries themselves."""

import base64
import hashlib
import random
import struct
import zlib

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from orderloom.llm import byte_bpe, token_counts, token_output

from .cases import EDGES, documents

PARTS = (
    "a b e th ing 's 're 'll ' ! é ß 日本 😀 1 23 <|endoftext|> <|endo <unk> ́ ½ ² _ ǅ A THE the . , Σ İ É"
).split() + [" ", "  ", "\n", "\t", "\r\n", " the", "\x1c", "\x85", " ", "\xa0", "\x00", "▁"]


def texts(n: int, length: int = 14) -> list[str]:
    pick = random.Random(5)
    return ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, length))) for _ in range(n)]


@pytest.fixture(scope="module")
def json_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def rank_encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_counts_equal_the_library(json_tokenizer):
    count = token_counts.PrefixCounter(public_tokenizers.path("byte_bpe_50k.json")).count
    for t in texts(1500):
        assert count(t) == len(json_tokenizer.encode(t, add_special_tokens=False).ids), repr(t)


def test_every_prefix_count_is_exact(json_tokenizer):
    counter = token_counts.PrefixCounter(public_tokenizers.path("byte_bpe_50k.json"))
    for t in texts(300):
        ids = [json_tokenizer.encode(t[:i], add_special_tokens=False).ids for i in range(len(t) + 1)]
        assert counter.prefix_counts(t).tolist() == [len(x) for x in ids], repr(t)


def test_count_and_truncate_stand_edge_cases(spark, json_tokenizer):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = documents(spark, EDGES)
    found = token_counts.count_tokens(docs, path, limit=40).collect()
    want = [
        (i, len((t or "").encode()), len(json_tokenizer.encode(t or "", add_special_tokens=False).ids))
        for i, t in EDGES
    ]
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in found] == want
    assert [r.over_limit for r in found] == [n > 40 for _, _, n in want]
    for (_, t), r in zip(EDGES, token_counts.truncate(docs, path, 10).collect(), strict=True):
        assert (t or "").startswith(r.fitting_text) and r.n_tokens <= 10
        again = json_tokenizer.encode(r.fitting_text, add_special_tokens=False).ids
        assert len(again) == r.n_tokens
    assert token_counts.count_tokens(docs.limit(0), path).count() == 0


def test_byte_bpe_equals_the_library_and_decodes(rank_encoding):
    bpe = byte_bpe.ByteBPE(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for t in texts(1500):
        ids = bpe.encode(t)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == rank_encoding.encode_ordinary(t), repr(t)
        assert bpe.decode(ids) == t.encode()


def test_round_trip_stands_edge_cases(spark, rank_encoding):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = documents(spark, EDGES)
    for (i, t), r in zip(EDGES, byte_bpe.round_trip(docs, path).collect(), strict=True):
        ids = rank_encoding.encode_ordinary(t or "")
        assert (r.doc_id, r.n_tokens) == (i, len(ids))
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = byte_bpe.decode(byte_bpe.encode(docs, path), path)
    assert [bytes(r.decoded).decode() for r in back.collect()] == [t or "" for _, t in EDGES]
    assert "Text" in back.columns and "text" not in back.columns
    assert byte_bpe.encode_checked(docs, path).count() == len(EDGES)
    assert byte_bpe.round_trip(docs.limit(0), path).count() == 0


def test_ranks_with_gaps_are_refused(tmp_path):
    (tmp_path / "ranks").write_bytes(base64.b64encode(b"a") + b" 0\n" + base64.b64encode(b"b") + b" 2\n")
    with pytest.raises((ValueError, IndexError)):
        byte_bpe.read_ranks(str(tmp_path / "ranks"))


def test_word_tokens_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = token_output.WordTokens(path), Tokenizer.from_file(path)
    for t in texts(1500):
        ids = own.encode(t)
        want = library.encode(t, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, repr(t)


def test_token_files_keep_order_ids_and_starts(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = documents(spark, EDGES).repartition(3)
    files = token_output.write(docs, path, file_bytes=200)
    assert len(files) > 3
    found = token_output.read(spark, files).collect()
    library = Tokenizer.from_file(path)
    encode = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 1]
    want = sorted((i is not None, i or 0, t is not None, t or "") for i, t in EDGES)
    start, rows = 0, []
    for known, i, _, t in want:
        ids = encode(t)
        data = struct.pack(f"<{len(ids)}I", *ids)
        rows.append((i if known else None, start, len(ids), zlib.crc32(data)))
        start += len(ids)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found), key=lambda r: r[1])
    assert got == rows
    some = token_output.read(spark, files, wanted=[7, 9]).collect()
    assert sorted(r.doc_id for r in some) == [7, 9, 9]
    assert token_output.stored(docs.limit(0), path).count() == 0


def test_damaged_token_files_are_found(tmp_path):
    good = tmp_path / "good.zst"
    out = token_output.SeekableWriter(f"file://{good}")
    out.add(1, b"\1\0\0\0" * 50)
    out.add(None, b"")
    out.close()
    reader = token_output.SeekableReader(f"file://{good}")
    assert list(reader.documents()) == [(1, 0, b"\1\0\0\0" * 50), (None, 50, b"")]
    data = bytearray(good.read_bytes())
    for cut in (data[:-1], data[:20], data[3:]):
        (tmp_path / "bad.zst").write_bytes(bytes(cut))
        with pytest.raises(ValueError):
            token_output.SeekableReader(f"file://{tmp_path / 'bad.zst'}")
    # another checksum in the table than that of the frame
    at = len(data) - token_output.FOOTER.size - 3 * token_output.ENTRY.size + 8
    data[at] ^= 1
    (tmp_path / "bad.zst").write_bytes(bytes(data))
    with pytest.raises(ValueError, match="checksum"):
        list(token_output.SeekableReader(f"file://{tmp_path / 'bad.zst'}").documents())


def test_marks_after_words_are_tokenised_once():
    import public_tokenizers

    words = token_output.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    asked, of_ids = [], words._ids
    words._ids = lambda letters: asked.append(letters) or of_ids(letters)
    text = "One, two, three, four."
    assert words.encode(text) == token_output._pack(words.tokenizer.encode(text, add_special_tokens=False).ids)
    assert asked.count(",") == 1
