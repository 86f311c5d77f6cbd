"""SentencePiece merge-type (BPE) encoding and decoding without the library's encoder.

Method: exact encoding by backtracking. From left to right the longest piece is
taken, found by a walk down a trie of the pieces (a scan that reports all pieces at
all positions costs several times as much); it is accepted when it may stand beside its left neighbour, which is
checked by re-merging the text of the two (and remembered). Otherwise the next
shorter prefix piece is tried, and when none is left the left neighbour is
taken back. A bitfield marks positions from which no encoding continues, so
that no position is tried twice and the work stays linear in the word.

Why pairs suffice: merges are chosen by score, then from the left. Until the
first merge over a token border, the merges inside a token do not depend on
its neighbours; so a sequence of tokens is the encoding exactly if every token
encodes to itself and no two neighbours merge differently.

Pieces of such a model never hold the space mark after another character
(checked when the model is loaded), so no token spans a word's start and words
are encoded on their own; a bounded memory of words saves repeated work.

Defined results: null or empty text gives the begin and end id alone and an
empty decoded text; characters outside the model become their UTF-8 byte
pieces; a space mark in the text is a space after decoding, as in the library.
Any other column of the input is left alone; null ids, repeated rows and empty
tables pass through.
"""
from __future__ import annotations

import hashlib
import re
import struct
from functools import lru_cache

from pyspark.sql import DataFrame

from .common import arrow_schema, as_batches, rows_of

MARK = "▁"                       # the model's space mark
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6   # piece types of the file format
WORDS_KEPT = 400_000                  # words remembered by a worker before it starts anew
PAIRS_KEPT = 1_000_000


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes):
    """(field number, value) of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class PieceModel:
    """Pieces and settings of a merge-type model file, and its encoder."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3) != 2 or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1):
            raise ValueError("only merge-type models with identity normalisation, a leading space and kept white space")
        if any(kind in (USER, UNUSED) for _, _, kind in pieces):
            raise ValueError("user-defined and unused pieces aren't supported")
        self.pieces = pieces
        self.id_of = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        #: Place of each piece by score, best first; equal scores have equal places.
        scores = sorted({pieces[i][1] for i in self.id_of.values()}, reverse=True)
        places = {score: k for k, score in enumerate(scores)}
        self.order = {text: places[pieces[i][1]] for text, i in self.id_of.items()}
        if any(MARK in text.lstrip(MARK) for text in self.id_of):
            raise ValueError("a piece holds a space mark after another character")
        control = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == CONTROL}
        self.begin, self.end = control["<s>"], control["</s>"]
        self.byte_id = {int(text[1:-1], 16): i for i, (text, _, kind) in enumerate(pieces) if kind == BYTE}
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte pieces")
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        known = {c for text in self.id_of for c in text}
        #: Characters without a piece of their own stand alone, unless longer pieces hold them.
        self.loose = {c for c in known if c not in self.id_of}
        if self.loose:
            raise ValueError("a piece holds a character that isn't a piece")
        self.known = known
        #: The pieces by their characters, the id of a piece under "".
        self.trie: dict = {}
        for text, i in self.id_of.items():
            node = self.trie
            for c in text:
                node = node.setdefault(c, {})
            node[""] = i
        #: The longest shorter piece that a piece begins with, or -1.
        self.shorter = [-1] * len(pieces)
        for text, i in self.id_of.items():
            self.shorter[i] = next((self.id_of[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.id_of), -1)
        self.length = [len(text) for text, _, _ in pieces]
        self.reach = max(map(len, self.id_of), default=0)
        self.packed = [struct.pack("<I", i) for i in range(len(pieces))]
        self.shown = [text.replace(MARK, " ") for text, _, _ in pieces]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[bytes, str]] = {}
        bars = "".join(c for c in "\n\t\r" if c not in known)   # stand alone, so they end a word
        self.word = re.compile(f"{MARK}+[^{MARK}{bars}]*|[^{MARK}{bars}]+|[{bars}]+")

    # ------------------------------------------------------------- merging
    def merged(self, text: str) -> list[int]:
        """The definition: merge the best-scored adjacent pair, leftmost first, while there is one."""
        parts, order = list(text), self.order.get
        none = len(self.pieces)
        made = [order(a + b, none) for a, b in zip(parts, parts[1:])]     # what each part and the next would make
        while made:
            best = min(made)
            if best == none:
                break
            at = made.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del made[at]
            if at:
                made[at - 1] = order(parts[at - 1] + parts[at], none)
            if at < len(made):
                made[at] = order(parts[at] + parts[at + 1], none)
        return [self.id_of[part] for part in parts]

    def fits(self, left: int, right: int) -> bool:
        """May the two pieces stand side by side? By merging their text anew."""
        got = self.pairs.get((left, right))
        if got is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            text = self.pieces[right][0]
            if left < 0:
                got = self.merged(text) == [right]
            else:
                got = self.merged(self.pieces[left][0] + text) == [left, right]
            self.pairs[left, right] = got
        return got

    def longest(self, text: str, at: int) -> int:
        """The longest piece that the text goes on with; every character of the text is a piece."""
        node, piece = self.trie, -1
        for c in text[at:at + self.reach]:
            node = node.get(c)
            if node is None:
                break
            piece = node.get("", piece)
        return piece

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text of known characters."""
        n = len(text)
        open_ = bytearray(b"\1") * (n + 1)      # the bitfield of positions that haven't failed
        ids: list[int] = []
        at, piece, last = 0, self.longest(text, 0), -1
        longest, length, shorter, fits, known = self.longest, self.length, self.shorter, self.fits, self.pairs.get
        while at < n:
            while piece >= 0:
                after = at + length[piece]
                if open_[after]:
                    fit = known((last, piece))
                    if fit or fit is None and fits(last, piece):
                        break
                piece = shorter[piece]
            if piece >= 0:
                ids.append(piece)
                at, last = after, piece
                piece = longest(text, at) if at < n else -1
            elif ids:
                open_[at] = 0
                piece = ids.pop()
                at -= length[piece]
                last = ids[-1] if ids else -1
                # the piece itself ends where nothing continues now
                piece = shorter[piece]
            else:
                raise AssertionError("no encoding")
        return ids

    def word_ids(self, word: str) -> list[int]:
        """Ids of a word; characters outside the model are byte pieces."""
        if self.known.issuperset(word):
            return self.backtrack(word) if word else []
        ids: list[int] = []
        start = 0
        for i, c in enumerate(word):
            if c not in self.known:
                if i > start:
                    ids += self.backtrack(word[start:i])
                ids += [self.byte_id[b] for b in c.encode()]
                start = i + 1
        if start < len(word):
            ids += self.backtrack(word[start:])
        return ids

    def pieces_text(self, ids: list[int]) -> str:
        """Text of ids: runs of byte pieces are UTF-8, space marks are spaces."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join(map(self.shown.__getitem__, ids))
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(self.pieces[i][0])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")

    def _miss(self, word: str) -> tuple[bytes, str]:
        if len(self.words) >= WORDS_KEPT:
            self.words.clear()
        ids = self.word_ids(word)
        got = b"".join(map(self.packed.__getitem__, ids)), self.pieces_text(ids)
        if len(word) <= 64:
            self.words[word] = got
        return got

    def encode_decode(self, text: str | None) -> tuple[bytes, str]:
        """(ids with begin and end as little-endian 32-bit integers, decoded text)."""
        begin, end = struct.pack("<I", self.begin), struct.pack("<I", self.end)
        if not text:
            return begin + end, ""
        words, miss = self.words, self._miss
        got = [words.get(w) or miss(w) for w in self.word.findall(MARK + text.replace(" ", MARK))]
        decoded = "".join([d for _, d in got])
        return begin + b"".join([i for i, _ in got]) + end, decoded[1:]   # without the leading space

    def encode(self, text: str | None) -> list[int]:
        ids = self.encode_decode(text)[0]
        return list(struct.unpack(f"<{len(ids) // 4}I", ids))

    def decode(self, ids: list[int]) -> str:
        """Text of ids; begin, end and other control ids have none."""
        text = self.pieces_text([i for i in ids if self.pieces[i][2] != CONTROL])
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def load_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     keep_ids: bool = False, keep_text: bool = False) -> DataFrame:
    """Per document its token count and the SHA-256 of its ids and of the decoded text.

    ``keep_ids`` adds ``ids`` (array of long), ``keep_text`` adds ``decoded``.
    A map over rows: no shuffle, memory bounded by the longest text.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    ddl = f"{id_col} {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    ddl += ", ids array<bigint>" * keep_ids + ", decoded string" * keep_text
    schema = arrow_schema(ddl)

    def encode(batches):
        model = load_model(model_path)

        def results():
            for key, text in rows_of(batches, [id_col, text_col]):
                ids, decoded = model.encode_decode(text)
                row = (key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                if keep_ids:
                    row += (list(struct.unpack(f"<{len(ids) // 4}I", ids)),)
                yield row + (decoded,) * keep_text
        yield from as_batches(results(), schema, 200 if keep_ids or keep_text else 2000)

    return docs.select(id_col, text_col).mapInArrow(encode, ddl)
