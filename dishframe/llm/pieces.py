"""Pre-tokens and ids of public tokenizer files, remembered per distinct chunk of text.

A text is cut where no pre-token can span, and a chunk or pre-token that is remembered is neither split
nor given to the tokenizer's model again. Chunks of plain Latin characters are
split by an equivalent expression here; any other chunk goes through the library's own splitter.
Memories are emptied when they reach a fixed size, so a worker's memory is bounded. Whole columns of
texts whose characters all have a class that no Unicode version changed are split by Arrow, whose compute
functions are loaded only there: workers that pack do without them (7 MB each).
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Letters, numbers and the rest below U+0250, where all Unicode versions agree.
_LETTER, _NUMBER, _REST = r"[^\W\d_²³¹¼½¾]", r"[\d²³¹¼½¾]", r"(?:[^\w\s]|_)"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_ODD = re.compile("[\x00-\x08\x0e-\x1f\x7f-\xa0ɐ-\U0010ffff]")
_WORD_SPLIT = re.compile(f"{_SHORT}|{_LETTER}+|{_NUMBER}|{_REST}+")
_BYTE_SPLIT = re.compile(rf"{_SHORT}| ?{_LETTER}+| ?{_NUMBER}+| ?{_REST}+|\s+(?!\S)|\s+")
_UNEVEN = re.compile(r" \s|\s ")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
LIMIT = 500_000
RUN_BYTES = 8 << 20

# The same split for whole columns: white space, letters, numbers and other characters by their ranges. It knows no
# look-ahead, so _SPACES first marks (1) where a run of white space gives its last character to what follows.
_COLUMN_SPACE, _COLUMN_NUMBER = r"\t-\r ", "0-9²³¹¼½¾"
_COLUMN_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏΑ-ΡΣ-ώЀ-џぁ-ゖァ-ヺー一-龥가-힣"
_COLUMN_ODD = f"[^{_COLUMN_SPACE}!-~¡-ɏ‐-‧‰-⁞₠-₵、-〃〈-】！（），：；？{_COLUMN_LETTER}]"
_COLUMN_REST = rf"[^{_COLUMN_SPACE}{_COLUMN_LETTER}{_COLUMN_NUMBER}\x00\x01]"
_COLUMN_SPLIT = f"{_SHORT}| ?[{_COLUMN_LETTER}]+| ?[{_COLUMN_NUMBER}]+| ?{_COLUMN_REST}+|[{_COLUMN_SPACE}]+"
_SPACES = f"([{_COLUMN_SPACE}])([{_COLUMN_SPACE}][^{_COLUMN_SPACE}])"


def _byte_letters() -> dict[int, str]:
    """Byte-level letters: printable bytes stand for themselves, the others for U+0100 onwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()
_BYTES = {ord(letter): b for b, letter in _LETTERS.items()}


def byte_letters(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(_LETTERS)


def from_byte_letters(piece: str) -> str:
    return piece.translate(_BYTES).encode("latin-1").decode()


def runs(texts: pa.Array, size: int = RUN_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive texts of about `size` bytes together, and the number of texts before them."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
    cuts = (np.flatnonzero(np.diff(ends // size)) + 1).tolist()
    for start, stop in zip([0, *cuts], [*cuts, len(texts)]):
        yield start, texts.slice(start, stop - start)


def _column_split(texts: pa.Array) -> pa.ListArray:
    """Pre-tokens of texts without odd characters; none of an empty text."""
    import pyarrow.compute as pc

    texts = pc.if_else(pc.equal(texts, ""), None, texts)
    marked = pc.any(pc.match_substring_regex(texts, _SPACES)).as_py()
    if marked:
        texts = pc.replace_substring_regex(texts, _SPACES, "\\1\x01\\2")
    texts = pc.replace_substring_regex(texts, _COLUMN_SPLIT, "\\0\x00")
    if marked:
        texts = pc.replace_substring(texts, "\x01", "")
    return pc.split_pattern(pc.utf8_rtrim(texts, "\x00"), "\x00")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds(dict):
    """Chunk between ASCII white space (bytes) to its ids as little-endian unsigned 32-bit bytes.

    For lower-casing tokenizers with word ends, whose pre-tokens hold no white space. A pre-token is
    remembered as the chunk that it would be, so both share one memory of at most LIMIT entries; a
    special string alone is another thing as a chunk, so such a pre-token is not remembered.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.library = load(path)
        self.model = self.library.model
        self.special = tuple(t.content for t in self.library.get_added_tokens_decoder().values())

    def _keep(self, chunk: bytes, ids: bytes) -> bytes:
        if len(self) >= LIMIT:
            self.clear()
        self[chunk] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        chunk = piece.encode()
        special = piece in self.special
        if special or (ids := self.get(chunk)) is None:
            ids = array("I", [t.id for t in self.model.tokenize(byte_letters(piece))]).tobytes()
            if not special:
                self._keep(chunk, ids)
        return ids

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if _ODD.search(text) or any(s in text for s in self.special):
            ids = array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        else:
            ids = b"".join([self._piece(p) for p in _WORD_SPLIT.findall(text.lower())])
        return self._keep(chunk, ids)


class BytePretokens(dict):
    """Chunk after one space (which belongs to it) to its pre-tokens, as byte-level letters."""

    def __init__(self, path: str) -> None:
        super().__init__()
        library = load(path)
        self.splitter, self.model = library.pre_tokenizer, library.model
        added = library.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("added tokens that strip or need word borders are not supported")
        contents = sorted((t.content for t in added), key=len, reverse=True)
        self.contents = contents
        self.special = re.compile("|".join(map(re.escape, contents))) if contents else None

    def pieces(self, chunk: str) -> tuple[str, ...]:
        """Pre-tokens of a chunk as it stands."""
        if _ODD.search(chunk):
            return tuple(p for p, _ in self.splitter.pre_tokenize_str(chunk))
        return tuple(map(byte_letters, _BYTE_SPLIT.findall(chunk)))

    def __missing__(self, chunk: str) -> tuple[str, ...]:
        if len(self) > LIMIT:
            self.clear()
        self[chunk] = found = self.pieces(" " + chunk)
        return found

    def chunks(self, text: str) -> tuple[list[str], list[str], int]:
        """Chunks whose pre-tokens together are those of the text: those that begin it (or follow a
        special token), those that follow a space, and the number of special tokens inside."""
        if self.special is None or not self.special.search(text):
            parts = self._cut(text)
            return parts[:1], parts[1:], 0
        segments = self.special.split(text)
        cut = [self._cut(s) for s in segments]
        return [c for parts in cut for c in parts[:1]], [c for parts in cut for c in parts[1:]], len(segments) - 1

    def split(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Pre-tokens of a column of texts, as they stand there: the text (its place) of each, the
        pre-tokens themselves, and the number of special tokens inside every text."""
        import pyarrow.compute as pc

        odd = pc.match_substring_regex(texts, _COLUMN_ODD)
        for content in self.contents:
            odd = pc.or_(odd, pc.match_substring(texts, content))
        special = np.zeros(len(texts), np.int64)
        lists = _column_split(texts.filter(pc.invert(odd)))
        odd = odd.to_numpy(zero_copy_only=False)
        places, lengths = [np.flatnonzero(~odd), np.flatnonzero(odd)], pc.list_value_length(lists).fill_null(0).to_numpy().tolist()
        pieces: list[str] = []
        for place in places[1].tolist():
            first, rest, special[place] = self.chunks(texts[place].as_py())
            before = len(pieces)
            for chunk in first:
                pieces += self.pieces(chunk)
            for chunk in rest:
                pieces += self[chunk]
            lengths.append(len(pieces) - before)
        coded = pa.array(pieces, pa.string()).dictionary_encode()
        plain = pa.array([from_byte_letters(p) for p in coded.dictionary.to_pylist()], pa.string())
        found = pa.concat_arrays([lists.flatten(), plain.take(coded.indices)]) if pieces else lists.flatten()
        return np.repeat(np.concatenate(places), lengths), found, special

    @staticmethod
    def _cut(text: str) -> list[str]:
        if not text:
            return []
        if text[0] == " " or text[-1] == " " or _UNEVEN.search(text):
            return _BETWEEN.split(text)
        return text.split(" ")

    def count(self, pretoken: str) -> int:
        return len(self.model.tokenize(pretoken))
