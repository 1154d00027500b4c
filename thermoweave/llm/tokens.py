"""Fast token ids of whole texts, the same as the tokenizers library gives."""

from __future__ import annotations

import functools
import json
import os
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Chunks kept per Python worker. A chunk that finds no room is encoded again when it comes back.
CACHED_CHUNKS = 500_000
# Parts of a text between two of these places get the same ids alone as within the text: a space
# with visible characters on at least one side never lies inside a pre-token.
SAFE_SPACE = regex.compile(r"(?<=\S) | (?=\S)")
UNSAFE = regex.compile(r"\s \s|\s \Z|\A \s")
# Characters whose lower case, normal form and class are the same for every library.
PLAIN = re.compile(r"[\x21-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\xff]*")
PLAIN_TEXT = re.compile(r"[\n\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\xff]*")
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")  # the same on plain characters
MARK = b"\xff"  # stands for the end of a word; no UTF-8 text has this byte
PLAIN_MARK = "\0"  # the same in plain texts, which do not hold it
SHORT = 256  # characters; a shorter plain text is put together from kept chunks, a longer one encoded whole
# What a plain character is to WORD_PATTERN: white space, a letter, a digit, a sign.
KINDS = np.array([0 if c.isspace() else 1 if c.isalpha() else 2 if c.isdecimal() else 3 for c in map(chr, range(256))], np.uint8)
KINDS[0] = 2  # PLAIN_MARK is a piece of its own, as a digit is
SPACES = np.flatnonzero(KINDS == 0).astype(np.uint8).tobytes()
LOWER = bytes(ord(c.lower()) if PLAIN.fullmatch(c) else ord(c) for c in map(chr, range(256)))
CONTRACTION = re.compile(r"'(?:(?<=[^\W_]')|(?<=[\s\0]')|(?<=\A'))(?:[stmd]|re|ve|ll)")
KEPT_PIECES, KEPT_BYTES = 200_000, 1 << 24  # of texts encoded together, per Python worker
TOGETHER = 1 << 23  # characters of plain texts whose pieces are looked at together; a longer text is encoded alone


class Encoder:
    """Ids of texts under a byte-level BPE file of the tokenizers library.

    Texts without special tokens take the merges by the ranks of the file in one call, where a tokenizer
    lower-cases words only plain ones. Other texts are cut at spaces that cannot lie inside a pre-token, each
    distinct chunk is encoded once per worker, and the results are joined; so are short plain texts, whose
    chunks are kept once for all their spellings. Chunks with anything unusual (special tokens, characters
    beyond Latin-1 in a normalising tokenizer) go through the tokenizers library itself.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.words = bool(suffix)
        skip = set(special)
        to_byte = _byte_of_char()
        ranks = {}
        for token, rank in spec["model"]["vocab"].items():
            if token in skip:
                continue
            ends = bool(suffix) and token.endswith(suffix)
            core = token[: -len(suffix)] if ends else token
            ranks[bytes(to_byte[c] for c in core) + MARK * ends] = rank
        if self.words:
            pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        else:
            pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.whole = pattern == WORD_PATTERN  # its pieces are the same in lower case and hold no white space
        self.split = PIECES.findall if self.whole else regex.compile(pattern).findall
        self.ranked = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        if self.whole:
            mark = PLAIN_MARK.encode()
            plain = {k.replace(MARK, mark): v for k, v in ranks.items() if mark not in k}
            pattern = f"[^{PLAIN_MARK}]+{PLAIN_MARK}"
            self.marked = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=plain, special_tokens={})
            # Pieces that texts encoded together held, and their ids.
            self.kept, self.kept_ids = pa.array([mark], pa.binary()), pa.array([b""], pa.binary())
            self.ends = np.zeros(max(plain.values()) + 1, bool)  # ids that end a piece
            self.ends[[rank for token, rank in plain.items() if token.endswith(mark)]] = True
        self.heads, self.tails = _Cache(self._chunk), _Cache(lambda c: self._chunk(" " + c))
        self.pieces = _Cache(self._piece)
        self.hint = os.path.commonprefix(special)  # "" is in every chunk

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        special = self.hint in text and self.special.search(text)
        if self.words:
            if self.whole and not special and PLAIN_TEXT.fullmatch(text):
                if len(text) < SHORT:
                    return b"".join(map(self.heads.__getitem__, text.lower().split()))
                return _bytes(self.marked.encode_ordinary(marked_pieces(text.lower())))
            return b"".join(map(self.heads.__getitem__, text.replace("\n", " ").split(" ")))
        if not special:
            return _bytes(self.ranked.encode_ordinary(text))
        if UNSAFE.search(text):
            return self._with_runs(text)
        parts = text.split(" ")
        return self.heads[parts[0]] + b"".join(map(self.tails.__getitem__, parts[1:]))

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of every text. Plain texts are cut together, and a piece that they share is encoded once."""
        out, together, size = [b""] * len(texts), [], 0
        for i, text in enumerate(texts):
            special = self.hint in text and self.special.search(text)
            if special or not self.whole or len(text) > TOGETHER or not PLAIN_TEXT.fullmatch(text):
                out[i] = self(text)
                continue
            if size + len(text) > TOGETHER:
                self._fill(out, together, texts)
                together, size = [], 0
            together.append(i)
            size += len(text)
        self._fill(out, together, texts)
        return out

    def _fill(self, out: list[bytes], places: list[int], texts: list[str]) -> None:
        """The ids of the plain texts at these places."""
        if not places:
            return
        # A mark before every text: it is the first of the distinct pieces, and tells where a text begins.
        chars, stops = _pieces(PLAIN_MARK + PLAIN_MARK.join([texts[i] for i in places]))
        pieces = _binary(stops, chars).dictionary_encode()
        at = pc.index_in(pieces.dictionary, value_set=self.kept)
        new = at.is_null()
        fresh = pieces.dictionary.filter(new)
        values = pa.concat_arrays([self.kept_ids, self._spelled(fresh)])
        at = at.fill_null(0).to_numpy().copy()
        at[new.to_numpy(zero_copy_only=False)] = np.arange(len(self.kept), len(values))
        spelled = values.take(pa.array(at.take(pieces.indices.to_numpy())))
        if len(self.kept) < KEPT_PIECES and values.nbytes < KEPT_BYTES:
            self.kept = pa.concat_arrays([self.kept, fresh.slice(0, KEPT_PIECES - len(self.kept))])
            self.kept_ids = values.slice(0, len(self.kept))
        stops = np.frombuffer(spelled.buffers()[1], np.int32, len(spelled) + 1)
        begins = stops[:-1][pieces.indices.to_numpy() == 0].tolist()
        data = memoryview(spelled.buffers()[2]) if stops[-1] else b""
        for i, begin, end in zip(places, begins, [*begins[1:], int(stops[-1])], strict=True):
            out[i] = bytes(data[begin:end])

    def _spelled(self, pieces: pa.BinaryArray) -> pa.BinaryArray:
        """The ids of every piece."""
        if not len(pieces):
            return pa.array([], pa.binary())
        stops = np.frombuffer(pieces.buffers()[1], np.int32)[1 : len(pieces) + 1]
        marked = _marked(np.frombuffer(pieces.buffers()[2], np.uint8)[: stops[-1]], stops)
        ids = self.marked.encode_to_numpy(marked)
        stops = np.flatnonzero(self.ends.take(ids)) + 1
        if len(stops) != len(pieces):
            raise ValueError("a piece has no id at its end")
        return _binary(4 * stops, ids.astype("<u4"))

    def _with_runs(self, text: str) -> bytes:
        """A text in which spaces stand beside other white space: only safe spaces cut it."""
        out, at = [], 0
        for found in SAFE_SPACE.finditer(text):
            if found.start() > at:
                out.append(self.heads[text[at : found.start()]])
                at = found.start()
        out.append(self.heads[text[at:]])
        return b"".join(out)

    def _chunk(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if self.hint in chunk and self.special.search(chunk):
            return self._by_library(chunk)
        if not self.words:
            return _bytes(self.ranked.encode_ordinary(chunk))
        if chunk[:-1].isascii() and chunk[:-1].isalpha() and chunk[-1] in ".,":
            return self.pieces[chunk[:-1].lower()] + self.pieces[chunk[-1]]
        if PLAIN.fullmatch(chunk):
            return b"".join(map(self.pieces.__getitem__, self.split(chunk.lower())))
        return self._by_library(chunk)

    def _piece(self, piece: str) -> bytes:
        return _bytes(self.ranked._encode_single_piece(piece.encode() + MARK))

    def _by_library(self, chunk: str) -> bytes:
        return _bytes(self.library.encode(chunk, add_special_tokens=False).ids)


def marked_pieces(text: str) -> str:
    """The pieces of ``WORD_PATTERN`` in a lower-case plain text, each with ``PLAIN_MARK`` behind it."""
    chars, stops = _pieces(text)
    return _marked(chars, stops)


def _pieces(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The characters of the pieces of a plain text, in lower case, and where each piece ends among them."""
    chars = text.encode("latin-1").translate(LOWER)
    kinds = np.frombuffer(chars.translate(KINDS.tobytes()), np.uint8)
    ends = kinds == 2
    ends[:-1] |= kinds[1:] != kinds[:-1]
    ends[-1:] = True
    if "'" in text:
        for found in CONTRACTION.finditer(chars.decode("latin-1")):
            ends[found.start() : found.end() - 1] = False
            ends[found.end() - 1] = True
    return np.frombuffer(chars.translate(None, SPACES), np.uint8), np.flatnonzero(ends[kinds > 0]) + 1


def _marked(chars: np.ndarray, stops: np.ndarray) -> str:
    """The characters with ``PLAIN_MARK`` behind each piece."""
    out = np.zeros(len(chars) + len(stops), np.uint8)
    out[np.arange(len(chars)) + np.repeat(np.arange(len(stops)), np.diff(stops, prepend=0))] = chars
    return out.tobytes().decode("latin-1")


def _binary(stops: np.ndarray, data: np.ndarray) -> pa.BinaryArray:
    """Strings of bytes that lie end to end."""
    offsets = np.append(0, stops).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(stops), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _bytes(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class _Cache(dict):
    def __init__(self, compute) -> None:
        super().__init__()
        self.compute = compute

    def __missing__(self, chunk: str) -> bytes:
        value = self.compute(chunk)
        if len(self) < CACHED_CHUNKS and len(chunk) < 64:
            self[chunk] = value
        return value


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies spell bytes as printable characters; the rest moves up from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(moved)}


@functools.lru_cache(maxsize=2)
def encoder(tokenizer: str) -> Encoder:
    """One encoder per Python worker. ``tokenizer`` is a path, or the name of an installed file."""
    if os.path.sep not in tokenizer:
        import public_tokenizers

        tokenizer = public_tokenizers.path(tokenizer)
    return Encoder(tokenizer)
