import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from thermoweave.llm import coder, packing, tokenfiles, tokens
from thermoweave.llm.tokens import Encoder, encoder

ODD = list("abAB  \n\t .,'s!12é ñİßǅΣς_²") + [
    "<|endoftext|>", "́", " ", " ", "\x1c", "\x85", "\r", "don't", "   ", "🙂", "中文", "'LL", "　", "._-",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name):
    encode, chance = encoder(name), random.Random(3)
    for _ in range(4000):
        text = "".join(chance.choice(ODD) for _ in range(chance.randint(0, 14)))
        ids = np.frombuffer(encode(text), "<u4").tolist()
        assert ids == encode.library.encode(text, add_special_tokens=False).ids, text


def test_plain_texts_equal_the_library_and_keep_a_chunk_once():
    encode, chance = Encoder(public_tokenizers.path("word_bpe_49k.json")), random.Random(4)
    encode("Word word WORD\nwOrd,  Word, ")
    assert len(encode.heads) == 2
    signs = list("aBcé ÄÖß\n  .,'!12_<|>\"&") + ["'S", "'re", "<|endoftext|>", "\xa0", "\xad", "\t", "µ", "word", "The"]
    for _ in range(3000):
        text = "".join(chance.choice(signs) for _ in range(chance.randint(0, 20)))
        ids = np.frombuffer(encode(text), "<u4").tolist()
        assert ids == encode.library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_long_texts_equal_the_library_without_kept_chunks(name):
    encode, chance = Encoder(public_tokenizers.path(name)), random.Random(6)
    signs = list("aBcé ÄÖß   \n  .,'!12_<|>\"&") + ["'S", "'re", "''ll", "'", "_'t", "'d's", "\xa1", "\xad", "µª", "word", "The "]
    for k in range(300):
        text = "".join(chance.choice(signs) for _ in range(400)).replace("<|endoftext|>", "") + " " * (k % 3)
        ids = np.frombuffer(encode(text), "<u4").tolist()
        assert ids == encode.library.encode(text, add_special_tokens=False).ids, text
    assert not (encode.heads or encode.tails or encode.pieces)


def test_texts_encoded_together_equal_the_library(monkeypatch):
    monkeypatch.setattr(tokens, "TOGETHER", 300)
    chance = random.Random(8)
    signs = list("aBcé ÄÖß   \n  .,'!12_<|>\"&") + ["'S", "'re", "''ll", "'", "_'t", "'d's", "\xa1", "µª", "word", "The "]
    rows = ["".join(chance.choice(signs) for _ in range(chance.randint(0, 40))) for _ in range(1500)]
    rows += ["", "", "'s", "5", "'ll 's", "<|endoftext|>", "a\0b", "\0", "Ünï\tcode", "中文", "word " * 200, "'t" * 10]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encode = encoder(name)
        for _ in range(3):
            chance.shuffle(rows)
            for text, ids in zip(rows, encode.many(rows), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == encode.library.encode(text, add_special_tokens=False).ids, text
        assert encode.many([]) == [] and encode.many(["", ""]) == [b"", b""]


def test_texts_encoded_together_encode_a_shared_piece_once():
    encode = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    plain, asked = encode.marked, []

    class Marked:
        def encode_to_numpy(self, text):
            asked.extend(text.split("\0")[:-1])
            return plain.encode_to_numpy(text)

        def encode_ordinary(self, text):
            asked.extend(text.split("\0")[:-1])
            return plain.encode_ordinary(text)

    encode.marked = Marked()
    texts = ["Long words, more WORDS and the same words. " * 20, "the Same more and " * 30, "and the rest 7 7"] * 4
    got = encode.many(texts)
    assert sorted(asked) == sorted({"long", "words", "more", "and", "the", "same", "rest", ",", ".", "7"})
    assert [np.frombuffer(x, "<u4").tolist() for x in got[:3]] == [
        encode.library.encode(x, add_special_tokens=False).ids for x in texts[:3]
    ]


def test_coder_keeps_class_frequencies_whole():
    chance = np.random.default_rng(1)
    blocks = [chance.zipf(1.05 + k / 40, coder.BLOCK - 37 * k) % coder.MAX_ID for k in range(40)]
    blocks += [np.tile(chance.integers(0, 49408, 300), 7)[: coder.BLOCK], np.arange(coder.BLOCK) * 64 % coder.MAX_ID]
    payloads = coder.encode(blocks)
    for one, back in zip(blocks, coder.decode(payloads, [len(b) for b in blocks]), strict=True):
        assert one.tolist() == back.tolist()
    assert len(payloads[40]) < 2 * len(blocks[40])  # later rounds are predicted
    assert [coder.encode([b])[0] for b in blocks[-3:]] == payloads[-3:]  # alone as beside others
    bad = bytes(chance.integers(0, 256, 40, np.uint8))  # a damaged payload gives some ids, and no error of its own
    assert len(coder.decode([bad, payloads[0]], [900, len(blocks[0])])[0]) == 900


def test_coder_round_trip():
    chance = np.random.default_rng(0)
    blocks = [chance.integers(0, 49408, n) for n in (0, 1, 2, 5, 700, coder.BLOCK)]
    blocks += [np.zeros(900, int), np.arange(900) % 7, np.full(10, coder.MAX_ID - 1), chance.zipf(1.3, 1500) % 5000]
    payloads = coder.encode(blocks)
    for one, back in zip(blocks, coder.decode(payloads, [len(b) for b in blocks]), strict=True):
        assert one.tolist() == back.tolist()
    assert len(payloads[6]) < 100 and len(payloads[9]) < 2 * len(blocks[9])
    with pytest.raises(ValueError):
        coder.encode([np.array([coder.MAX_ID])])


def library_ids(name, rows, end):
    encode = encoder(name).library.encode
    return [(i, [*encode(t or "", add_special_tokens=False).ids, end]) for i, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, frame, odd_rows, tmp_path):
    path = str(tmp_path / "files")
    tokenfiles.write_tokens(frame(odd_rows), path)
    got = sorted((r.start, r.doc_id or 0, r.n_tokens, r.ids_crc32, r.ids) for r in tokenfiles.read_tokens(spark, path).collect())
    rows = sorted(odd_rows, key=lambda r: (r[0] or 0, r[1] or ""))
    start = 0
    for (at, doc, n, check, ids), (want_doc, want) in zip(got, library_ids("word_bpe_49k.json", rows, 1), strict=True):
        assert (at, doc, n, check, ids) == (start, want_doc or 0, len(want), crc(want), want)
        start += n


def test_damaged_block_fails(spark, frame, tmp_path):
    path, other = str(tmp_path / "files"), str(tmp_path / "damaged")
    tokenfiles.write_tokens(frame([(1, "one two three")]), path)
    spark.read.parquet(path).selectExpr("* except (checksum)", "checksum + 1 AS checksum").write.parquet(other)
    with pytest.raises(Exception, match="damaged"):
        tokenfiles.read_tokens(spark, other).collect()


def test_empty_table(spark, frame):
    assert tokenfiles.token_file_report(spark, frame([])).count() == 0
    assert packing.packing_report(frame([])).count() == 0


def check_packed(rows, got, window):
    want: dict = {}
    for doc, ids in library_ids("byte_bpe_50k.json", rows, 0):
        want.setdefault(doc, []).append(ids)
    by_doc: dict = {}
    by_sequence: dict = {}
    for r in got:
        assert crc(r.ids) == r.ids_crc32 and len(r.ids) == r.length
        by_doc.setdefault(r.doc_id, []).append((r.start, r.ids))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, lists in want.items():
        assert sorted(x for _, ids in by_doc.pop(doc) for x in ids) == sorted(x for ids in lists for x in ids)
    assert not by_doc
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return sum(len(ids) for lists in want.values() for ids in lists), len(by_sequence)


def test_packing(frame, odd_rows, prose):
    rows = odd_rows + [(100 + i, prose(i, 5 + i % 90)) for i in range(120)]
    tokens, sequences = check_packed(rows, packing.pack(frame(rows), window=128).collect(), 128)
    assert tokens / (128 * sequences) > 0.98


@pytest.mark.parametrize("lengths", [[], [700] * 50, [1] * 3000, [1023], [512] * 7, list(range(1, 1024)) * 3])
def test_plan_places_every_remainder_once(lengths):
    counts = np.bincount(lengths, minlength=1024) if lengths else np.zeros(1024, int)
    plan = packing.make_plan(counts, 1024, 5)
    taken: dict = {}
    for length in np.flatnonzero(counts):
        for rank in range(counts[length]):
            parts = packing.placed(plan, int(length), rank)
            assert sum(p[1] for p in parts) == length
            for _, part, sequence, offset in parts:
                taken.setdefault(sequence, []).append((offset, part))
    for parts in taken.values():
        ends = np.cumsum([p[1] for p in sorted(parts)])
        assert [p[0] for p in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(taken) <= -(-int((np.arange(1024) * counts).sum()) // 1018) + 1


def test_padded_length():
    assert [packing.padded_length(n) for n in (1, 3, 512, 513, 1024)] == [1, 1024, 512, 1024, 1024]
