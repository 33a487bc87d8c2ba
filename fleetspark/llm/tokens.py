"""Token ids of whole texts by a tokenizer of the tokenizers library, many texts at a time.

The library spends most of its time on the words of prose again and again. A
text of ASCII and Latin letters in which single spaces and line breaks stand
between words is cut there, many texts at once as Arrow arrays; each distinct
piece among them is split into words as the tokenizer's pre-tokenizer does, and
the library's model encodes each distinct word once per worker, as long as the
worker keeps it. Every other text goes to the library whole. Both ways give the
ids that the library gives for the text.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of Latin-1 that plain texts are made of: line breaks, printable ASCII and letters.
PLAIN_BYTES = bytes([10, *range(32, 127), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
#: What plain texts do not hold: white space that is not single, and strings like special tokens.
NOT_PLAIN = ("  ", "\n\n", " \n", "\n ", "<|")


def is_plain(text: str) -> bool:
    """Whether a text may be cut at its spaces and line breaks."""
    if text.isascii():
        raw = text.encode("ascii")
    else:
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return False
    if raw.translate(None, PLAIN_BYTES) or text[0] in " \n" or text[-1] in " \n":
        return False
    return not any(x in text for x in NOT_PLAIN)


#: Pieces kept per worker, some 200 bytes each: half of them new, half those from before.
MOST_PIECES = 800_000
#: Texts, and characters of texts, that are encoded at once; one longer text goes alone.
TEXTS_AT_ONCE, CHARS_AT_ONCE = 2048, 1 << 22
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Words of plain texts: the two pre-tokenizers' patterns with their classes written out for those letters.
WORDS = {
    "byte": re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+"),
    "word": re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+"),
}
#: Pieces of a word and one sign or digit, as "end.".
WORD_AND_SIGN = r"^[A-Za-z]+[!-@\[-`{-~]$"


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte: itself where it prints, else the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids as little-endian unsigned 32-bit integers.

    Two kinds of tokenizers are known: "byte" (no normalizer, spaces belong to
    words) and "word" (lower case, white space vanishes).
    """

    def __init__(self, spec: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.bytewise = self.tokenizer.normalizer is None
        self.words = WORDS["byte" if self.bytewise else "word"]
        self.letters = byte_letters()
        self.shown_space = self.letters[32]
        self.bytes_of = [n.to_bytes(4, "little") for n in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        """The library's ids of whole texts."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _cut(self, text: str) -> str:
        """A plain text with a space between its pieces; for "byte", a carriage return or line break marks those without a space before them."""
        return ("\r" + text).replace("\n", " \n") if self.bytewise else text.lower().replace("\n", " ")

    def _tokens(self, shown: str) -> bytes:
        bytes_of = self.bytes_of
        return b"".join([bytes_of[t.id] for t in self.model.tokenize(shown)])

    def _word(self, word: str) -> bytes:
        """A word's ids; kept as those of the piece that is this word."""
        if not self.bytewise:
            piece = word
        else:
            piece = word[1:] if word[0] == " " else "\r" + word
        got = self.known.get(piece)
        if got is None and (got := self.old.pop(piece, None)) is None:
            if word.isascii():  # printable, as texts are plain: only the space and the line break have other letters
                shown = word.replace(" ", self.shown_space).replace("\n", self.letters[10])
            else:
                shown = word.encode().decode("latin-1").translate(self.letters)
            got = self._tokens(shown)
        self.known[piece] = got
        return got

    def _piece(self, piece: str) -> bytes:
        """The ids of a piece that is not among the known ones, which it joins."""
        got = self.old.pop(piece, None)
        if got is None:
            if piece.isascii() and piece.isalpha():  # one word, whose letters stand for themselves
                got = self._tokens(self.shown_space + piece if self.bytewise else piece)
            elif not self.bytewise:
                got = b"".join(map(self._word, self.words.findall(piece)))
            else:
                mark, rest = (piece[0], piece[1:]) if piece[0] in "\r\n" else ("", " " + piece)
                got = (self._word("\n") if mark == "\n" else b"") + b"".join(map(self._word, self.words.findall(rest)))
        self.known[piece] = got
        return got

    def _ids_of(self, pieces: pa.Array) -> pa.Array:
        """The ids of pieces, of which each distinct one is looked up once."""
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, distinct))
        for k in [k for k, got in enumerate(ids) if got is None]:
            ids[k] = self._piece(distinct[k])
        return pa.array(ids, pa.large_binary()).take(coded.indices)

    def _plain_ids(self, texts: list[str]) -> list[bytes]:
        """The ids of plain texts, by their distinct pieces; a word and a sign after it are two words to both tokenizers."""
        pieces = pc.split_pattern(pa.array(map(self._cut, texts), pa.large_string()), " ")
        coded = pieces.flatten().dictionary_encode()
        distinct = coded.dictionary
        signed = pc.match_substring_regex(distinct, WORD_AND_SIGN)
        ids = self._ids_of(pc.if_else(signed, pc.utf8_slice_codeunits(distinct, 0, -1), distinct))
        mark, nothing = (pa.scalar(x, pa.large_string()) for x in ("\r" if self.bytewise else "", ""))
        signs = pc.binary_join_element_wise(mark, pc.utf8_slice_codeunits(distinct.filter(signed), -1), nothing)
        none = pa.array(np.full(len(distinct), b"", object), pa.large_binary())
        ids = pc.binary_join_element_wise(ids, pc.replace_with_mask(none, signed, self._ids_of(signs)), pa.scalar(b"", pa.large_binary()))
        # The ids of all pieces in their order lie in one buffer.
        all_ids = ids.take(coded.indices)
        ends = np.frombuffer(all_ids.buffers()[1], "int64")[pieces.offsets.to_numpy()].tolist()
        data = memoryview(all_ids.buffers()[2])
        return [bytes(data[a:b]) for a, b in itertools.pairwise(ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        # What has been met since the last change of generations outlives the next one; the rest is forgotten.
        if len(self.known) > MOST_PIECES // 2:
            self.known, self.old = {}, self.known
        out = [b""] * len(texts)
        plain = [k for k, text in enumerate(texts) if text and is_plain(text)]
        odd = sorted({k for k, text in enumerate(texts) if text}.difference(plain))
        for places, ids_of in ((plain, self._plain_ids), (odd, self._ids)):
            for k, got in zip(places, ids_of([texts[k] for k in places]) if places else [], strict=True):
                out[k] = got
        return out


@functools.lru_cache(maxsize=4)
def _encoder(spec: str) -> Encoder:
    return Encoder(spec)


def read_spec(path: str) -> str:
    """The tokenizer's file as text; read on the driver and sent with the job."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def token_batches(spec: str, end_id: int) -> Callable[[list], Iterator[list[bytes]]]:
    """A function that yields, for parts of a list of texts (None: empty), their ids with ``end_id`` appended."""
    end = np.array([end_id], "<u4").tobytes()

    def batches(texts: list) -> Iterator[list[bytes]]:
        encoder = _encoder(spec)
        part: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            if part and (len(part) == TEXTS_AT_ONCE or size + len(text) > CHARS_AT_ONCE):
                yield [x + end for x in encoder.encode(part)]
                part, size = [], 0
            part.append(text)
            size += len(text)
        if part:
            yield [x + end for x in encoder.encode(part)]

    return batches
