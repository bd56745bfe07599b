"""Operator 7: BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens.  It starts with one state and an arc for each symbol.  The merges are applied one
after another; the gadget of a merge (a, b) makes a token ab:

* each state with an arc a that leads to a state with an arc b gets an arc ab to where b leads;
* the state behind a loses its arc b, since a followed by b is now ab.

All arcs of one label lead to one state, so a state is named by the token read last: the state of ab begins as
a copy of the state of b, and arcs ab lie where arcs a lie.  These copies aren't made; a gadget is kept as
(left, right, number), and whether state s has arc t follows from the gadgets on the right edge of s and on the
left edge of t, newest first.  Answers go into the transition table, so each is worked out once.

The words that the automaton accepts are exactly the encodings, one for each spelling.  So a word is encoded by
following, from each position reached, the arcs whose labels come next in it.  Decoding emits the labels.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from ledgerline.llm.tokens import _KNOWN, _WORD_WORDS, Remembered, by_bytes

START = -1


class Automaton:
    """The automaton of a list of merges over an alphabet of symbols; ``ids`` has the id of each token."""

    def __init__(self, alphabet: list[str], merges: list[tuple[str, str]], ids: dict[str, int], suffix: str = ""):
        self.ids, self.suffix = {}, suffix
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.lost: dict[tuple[int, int], int] = {}
        for symbol in alphabet:
            self.ids[symbol] = ids[symbol]
            self.born[ids[symbol]] = -1
        self.met = set(self.born)
        for number, (a, b) in enumerate(merges):
            self._gadget(number, ids[a], ids[b], a + b, ids[a + b])
        self.labels = {ids[x]: x for x in (*alphabet, *(a + b for a, b in merges))}
        self.longest = max(map(len, self.ids), default=0)
        self.table = Remembered(self._has_arc, 400_000)

    def _gadget(self, number: int, a: int, b: int, label: str, token: int) -> None:
        if token in self.born or (a, b) in self.lost:
            raise ValueError(f"merge {number} makes a token or joins a pair that an earlier one does")
        # Where an earlier gadget took the arc b from behind a, no text has the two side by side.
        if a in self.met and b in self.met and self._has_arc((a, b)):
            self.ids[label] = token
            self.met.add(token)
        self.lost[a, b] = number
        self.left[token], self.right[token], self.born[token] = a, b, number

    def _has_arc(self, pair: tuple[int, int]) -> bool:
        """Whether state s has arc t, all gadgets so far being in place.

        Back in time: before gadget ``until`` the newer of both didn't exist and stood for one of its halves.
        """
        s, t = pair
        born, lost = self.born, self.lost
        until = len(lost)
        while True:
            if lost.get((s, t), until) < until:
                return False
            a, b = born[s], born[t]
            if a == b == -1:
                return True
            if a > b:
                s, until = self.right[s], a
            elif b > a:  # a state that this same gadget takes arc b from gets no arc ab
                t, until = self.left[t], b + 1
            else:
                s, t, until = self.right[s], self.left[t], a

    def encode(self, word: str) -> list[int]:
        """The only path whose labels spell the word.  ``word`` is not empty and spelt in the alphabet.

        From each position the longest arc goes first.  At most one path leads to a position, so one from which
        no arc goes on is never entered again.
        """
        n, ids, table, longest, suffix = len(word), self.ids, self.table, self.longest, self.suffix
        path: list[int] = []
        ends: list[int] = []
        dead: set[int] = set()
        at, state, end = 0, START, min(n, longest)
        while at < n:
            while end > at:
                t = ids.get(word[at:end]) if end < n else ids.get(word[at:] + suffix)
                if t is not None and end not in dead and (state == START or table[state, t]):
                    break
                end -= 1
            if end > at:
                path.append(t)
                ends.append(end)
                at, state, end = end, t, min(n, end + longest)
            else:  # back to the position before, with the next shorter arc
                dead.add(at)
                path.pop()
                end = ends.pop() - 1
                at, state = (ends[-1], path[-1]) if path else (0, START)
        return path


class AutomatonTokenizer:
    """Encoding and decoding as the tokenizers library does for a word-level BPE file without a decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None:
            raise ValueError("a BPE file without a decoder is expected")
        self.library = Tokenizer.from_file(path)
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        made = {a + b for a, b in merges}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        alphabet = [x for x in model["vocab"] if x not in made and x not in self.special]
        self.automaton = Automaton(alphabet, merges, model["vocab"], model["end_of_word_suffix"] or "")
        self.labels = self.automaton.labels | {i: x for x, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.pieces = Remembered(self._piece, 200_000)

    def _words(self, text: str) -> list[str]:
        """Normalised, pre-split and spelt in the alphabet, which has printable ASCII as it is."""
        if text.isascii() and text.isprintable():
            text = text.lower()
            return [text] if text.isalpha() else _WORD_WORDS.findall(text)
        return [x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]

    def _piece(self, piece: str) -> tuple[int, str, str]:
        """Of text without blanks at its ends: number of ids, ids and labels as written in the digests."""
        if piece[-1] in ".," and piece[:-1].isalpha() and _KNOWN.match(piece):  # two words, each met before most of the time
            head, tail = self.pieces[piece[:-1]], self.pieces[piece[-1]]
            return head[0] + tail[0], f"{head[1]} {tail[1]}", f"{head[2]} {tail[2]}"
        ids: list[int] = []
        for part in self.cut.split(piece) if "<|" in piece else (piece,):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                for word in self._words(part):
                    ids += self.automaton.encode(word)
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    def decode(self, ids: list[int]) -> str:
        """Emit the arcs' labels; the file has no decoder, so blanks stand between them."""
        return " ".join([self.labels[i] for i in ids])

    def encoded(self, text: str | None) -> list[tuple[int, str, str]]:
        """White space is dropped, so a text is cut at blanks and line feeds."""
        found = [self.pieces[x] for x in (text or "").replace("\n", " ").split(" ") if x]
        return [x for x in found if x[0]]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> AutomatonTokenizer:
    return AutomatonTokenizer(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = 4 << 20) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256 (of the ids as text), decoded_sha256 (of the decoded text).

    A null text is empty: no tokens and the digests of no bytes.  Null ids stay, equal rows give equal rows,
    other columns aren't read, and an empty table gives an empty result.
    """

    def run(batches):
        tok = tokenizer(path)
        for batch in batches:
            texts = batch.column(1)
            for a, b in by_bytes(pc.binary_length(texts).to_pylist(), group_bytes):
                n, ids, decoded = [], [], []
                for text in texts.slice(a, b - a).to_pylist():
                    found = tok.encoded(text)
                    n.append(sum([x[0] for x in found]))
                    ids.append(hashlib.sha256(" ".join([x[1] for x in found]).encode()).hexdigest())
                    decoded.append(hashlib.sha256(" ".join([x[2] for x in found]).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                    names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
