"""Token ids of whole texts, and token counts (operator 5).

A text is cut only at safe boundaries: places where no token of the vocabulary's pre-split pattern can
reach across, so that the ids of the pieces, put together, are the ids of the whole text.

* Word vocabularies drop white space: every ASCII blank or line feed is a boundary.
* Byte-level vocabularies attach one blank to the word behind it.  The place between a character that is
  not white space and one that is, is a boundary; a piece is a run of white space with the run behind it.

Pieces repeat, so their ids are kept in a cache of bounded size and only new pieces are encoded.  Texts are handled in
groups: Arrow finds the different pieces of a group, so each is looked up once for the group, and puts the ids in a row.
"""

from __future__ import annotations

import re
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, pre_tokenizers

#: Pieces that a worker remembers in each of two generations, in counting and in encoding; an entry takes some 160 bytes.
CACHE_PIECES = 300_000
CACHE_IDS = 400_000

_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾"
_BLANKS = r" \t\n\r\f\v"
#: Characters that the short way knows; a piece with any other, or with a special string, goes to the library.
_KNOWN = re.compile(rf"[\n!-~¡-ſ]*\Z")
_ONE_WORD = re.compile(rf" ?[{_LETTERS}]+\Z")
_BYTE_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
    rf"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)
_WORD_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
)
#: White space beyond ASCII, and the separators that only Python takes for white space.
_OTHER_BLANKS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BYTE_PIECES = re.compile(rf"[{_BLANKS}]*[^{_BLANKS}]+|[{_BLANKS}]+\Z")


class Remembered(dict):
    """A mapping that fills itself by ``make`` and keeps the latest one to two times ``size`` entries."""

    def __init__(self, make, size: int = CACHE_PIECES):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = self.copy()
            self.clear()
        self[key] = value
        return value


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers, equal to ``Tokenizer.encode(text, False).ids``."""

    def __init__(self, path: str):
        self.tokenizer = tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        self.by_byte = isinstance(tok.pre_tokenizer, pre_tokenizers.ByteLevel)
        self.model = tok.model
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        spelt = {b: spell.pre_tokenize_str(chr(b))[0][0] for b in range(128)}
        spelt |= {0x80 + b: x for b, x in enumerate(spell.pre_tokenize_str(chr(0x80 + b))[0][0][1] for b in range(64))}
        spelt |= {0xC0 + b: spell.pre_tokenize_str(chr(b << 6))[0][0][0] for b in range(2, 32)}
        #: The spelling of each byte; the others are in no known character.
        self.spelt = "".join([spelt.get(b, "\ufffe") for b in range(256)])
        self.blank = spelt[32] if self.by_byte else ""
        self.words = Remembered(self._word, 50_000)
        self.first = Remembered(self._piece, 50_000)
        self.after_blank = Remembered(self._after_blank, CACHE_IDS)

    def _word(self, word: str) -> bytes:
        """Of a pre-split word with known characters."""
        if not (word.isascii() and word.isalpha()):
            word = charmap_decode(word.encode(), "strict", self.spelt)[0]
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        if "<|" in piece or not _KNOWN.match(piece[piece[:1] == " " :]):
            return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        if not self.by_byte:
            piece = piece.lower()
        if _ONE_WORD.match(piece):
            return self._word(piece)
        found = _BYTE_WORDS.findall(piece) if self.by_byte else _WORD_WORDS.findall(piece)
        return b"".join([self.words[w] for w in found])

    def _after_blank(self, piece: str) -> bytes | None:
        """Of a piece that follows a blank, which is left out unless a line feed begins it.

        None if white space beside the blank makes it part of a longer run.
        """
        if piece.isalpha() and (piece.isascii() or _ONE_WORD.match(piece)):  # most are: a word of known letters needs no further look
            word = piece if self.by_byte else piece.lower()
            if word.isascii():
                return array("I", [t.id for t in self.model.tokenize(self.blank + word)]).tobytes()
            if _ONE_WORD.match(word):  # a capital may have no single small letter
                word = charmap_decode(word.encode(), "strict", self.spelt)[0]
                return array("I", [t.id for t in self.model.tokenize(self.blank + word)]).tobytes()
        if piece[-1:] in (".", ",") and piece[-2:-1].isalpha() and piece[-2] < "\u0180" and piece[-2] != "\u0130":
            head = self.after_blank[piece[:-1]]
            return head and head + self.first[piece[-1]]
        if not self.by_byte:
            return self._piece(piece)
        if piece in ("", "\n") or piece[-1].isspace() or piece[piece[0] == "\n"].isspace():
            return None
        return self._piece(piece if piece[0] == "\n" else " " + piece)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_byte:
            return b"".join([self.after_blank[x] for x in text.replace("\n", " ").split(" ") if x])
        found = text.replace("\n", " \n").split(" ")
        head = found[0]
        if head and not head[0].isspace() and not head[-1].isspace():
            out = list(map(self.after_blank.__getitem__, found))
            out[0] = self.first[head]
            if None not in out:
                return b"".join(out)
        if _OTHER_BLANKS.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join([self.first[x] for x in _BYTE_PIECES.findall(text)])

    def ids_of_group(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts in a row, each text's followed by ``end``, and how many each has.  No text may be null.

        Each different piece of the group is looked up once.
        """
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n" if self.by_byte else " "), " ")
        found = cut.flatten().dictionary_encode()
        size = pc.list_value_length(cut).to_numpy()
        first = np.cumsum(size) - size
        known = list(map(self.after_blank.__getitem__, found.dictionary.to_pylist()))
        entry = found.indices.to_numpy().astype(np.int64)
        if self.by_byte and len(texts):
            heads = cut.flatten().take(pa.array(first)).to_pylist()
            whole = np.array([not x or x[0].isspace() or x[-1].isspace() for x in heads])
            absent = np.array([x is None for x in known])
            hard = absent[entry]
            hard[first] = False  # the head of a text follows no blank
            whole |= np.logical_or.reduceat(hard, first)
            known = [x or b"" for x in known]
            entry[np.repeat(whole, size)] = len(known)
            entry[first] = len(known) + 1 + np.arange(len(texts))
            starts = [b"" if w else self.first[x] for x, w in zip(heads, whole.tolist(), strict=True)]
            for i in np.flatnonzero(whole).tolist():
                starts[i] = self.ids(texts[i].as_py())
            known += [b"", *starts]
        entry = np.insert(entry, first + size, len(known))
        known.append(np.uint32(end).tobytes())
        each = np.fromiter(map(len, known), np.int64, len(known)) // 4
        lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum(each)].astype(np.int32), np.frombuffer(b"".join(known), "<i4"))
        counts = np.add.reduceat(each[entry], first + np.arange(len(texts))) if len(texts) else np.zeros(0, np.int64)
        return lists.take(pa.array(entry)).flatten().to_numpy(), counts


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """One encoder for each vocabulary and worker."""
    return PieceEncoder(path)


# --- operator 5: token counts -------------------------------------------------------------------------------


class PieceCounter:
    """Numbers of tokens; new pieces are encoded together, in batches of about ``batch_bytes``."""

    def __init__(self, path: str, batch_bytes: int):
        self.encoder, self.batch_bytes = encoder(path), batch_bytes
        self.known: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def _cut(self, text: str) -> list[str]:
        """At safe boundaries; the pieces together are the text, but for blanks that a word vocabulary drops."""
        if not self.encoder.by_byte:
            return [x for x in text.replace("\n", " ").split(" ") if x]
        return [text] if _OTHER_BLANKS.search(text) else _BYTE_PIECES.findall(text)

    def _learn(self, new: list[str]) -> None:
        """Count the tokens of new pieces; the batches are balanced by bytes."""
        batch, size = [], 0
        for piece in [*new, None]:
            if piece is None or size >= self.batch_bytes:
                found = self.encoder.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
                self.known.update(zip(batch, map(len, found), strict=True))
                batch, size = [], 0
            if piece is not None:
                batch.append(piece)
                size += len(piece)

    def counts(self, texts: list[str | None]) -> list[int]:
        """Of one group of texts, whose size in bytes is bounded by the caller but for a single longer text."""
        if len(self.known) > CACHE_PIECES:
            self.old, self.known = self.known, {}
        cut = [self._cut(x) if x else [] for x in texts]
        new = set().union(*cut).difference(self.known)
        seen = {x: self.old[x] for x in new if x in self.old}
        self.known.update(seen)
        self._learn(sorted(new.difference(seen)))
        get = self.known.__getitem__
        return [sum(map(get, x)) for x in cut]


def by_bytes(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes together, or of one longer row."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


@lru_cache(maxsize=4)
def _counter(path: str, batch_bytes: int) -> PieceCounter:
    return PieceCounter(path, batch_bytes)


def token_counts(
    docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 16, group_bytes: int = 4 << 20
) -> DataFrame:
    """Tokens of every whole text, without special tokens added: id, n_bytes, n_tokens, over_limit.

    Only lengths leave the tasks.  A null text counts as empty; a null id stays; equal rows give equal
    rows; other columns are not read, so their names can't clash; an empty table gives an empty result.
    Texts are handled in groups of at most ``group_bytes`` and cut at safe boundaries, and new pieces are
    encoded in batches of about ``batch_bytes``.
    """

    def count(batches):
        counter = _counter(path, batch_bytes)
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0)
            rows = sizes.to_pylist()
            out: list[int] = []
            for a, b in by_bytes(rows, group_bytes):
                out += counter.counts(texts.slice(a, b - a).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes.cast(pa.int64()), pa.array(out, pa.int64())], names=["id", "n_bytes", "n_tokens"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        count, f"id {kind}, n_bytes bigint, n_tokens bigint"
    )
    return found.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
