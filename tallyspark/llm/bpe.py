"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece of text exactly one token can be the last one of its
encoding.  It is found among the vocabulary tokens that end the prefix (reported by
a suffix-matching automaton over the vocabulary): the one that is compatible with
the last token of the prefix before it.  Two tokens are compatible if merging their
joined bytes gives the same two tokens again; that is decided by undoing merges at
the seam, without running the merges.  Following the stored last tokens back from
the end gives the ids.

Defined results: a null text counts as empty and has no ids; null ids decode to an
empty text; ids outside of the vocabulary decode to nothing; bytes that are no
UTF-8 decode to U+FFFD.  Repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import by_batch

# Fixed value: the pattern by which the byte-level pre-tokenizer cuts texts.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Entries that a worker remembers before it starts anew; bounds its memory, not its results.
REMEMBERED = 1_000_000
LONG_PIECE = 60
# A blank between two other blanks may belong to either side; elsewhere a piece starts at each blank or before it.
UNCLEAR = regex.compile(r"\s \s")


def default_vocabulary() -> str:
    """The place of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes: themselves where printable, else the next free code points from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class PrefixBpe:
    """Encoder and decoder of one vocabulary file (tokenizers' JSON, byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, alphabet = data["model"], byte_alphabet()
        vocabulary = model["vocab"]
        raw = {token: bytes(alphabet[c] for c in token) for token in vocabulary}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # Nodes: the single bytes, then the merged tokens in order of their merge.
        node: dict[str, int] = {}
        self.ids: list[int] = []
        self.length: list[int] = []
        self.pairs: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int]] = []

        def add(token: str, left: int, right: int) -> None:
            node[token] = number = len(self.ids)
            self.ids.append(vocabulary[token])
            self.length.append(len(raw[token]))
            self.parts.append((left, right))

        for token in sorted((t for t in vocabulary if len(raw[t]) == 1), key=vocabulary.__getitem__):
            add(token, len(self.ids), len(self.ids))
        for left, right in merges:
            if left + right not in node:
                add(left + right, node[left], node[right])
            self.pairs.setdefault((node[left], node[right]), node[left + right])
        self.whole: dict[int, bool] = {}
        self._suffixes({number: raw[token] for token, number in node.items()})
        self.bytes = {vocabulary[token]: b for token, b in raw.items()}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.bytes |= {number: text.encode() for text, number in self.special.items()}
        self.decimal = {number: str(number) for number in self.bytes}
        longest_first = sorted(self.special, key=lambda t: (-len(t), t))
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.pieces = regex.compile(PIECES)
        self.known: dict[str, list[int]] = {}
        self.fits: dict[int, bool] = {}

    def _suffixes(self, tokens: dict[int, bytes]) -> None:
        """An automaton whose state after some bytes knows all tokens that end there, longest first.

        Tokens that never come out of the merges are left out.  Moves are stored as they are
        first taken: from a state without such a child, the move of its longest suffix state.
        """
        self.moves: dict[int, int] = {}
        own, level, suffix = {}, [0], [0]
        for number, data in tokens.items():
            state = 0
            for byte in data:
                state = self.moves.setdefault(state << 8 | byte, len(self.moves) + 1)
            own[state] = (number, len(data))
        children: dict[int, list[tuple[int, int]]] = {}
        for key, child in self.moves.items():
            children.setdefault(key >> 8, []).append((key & 255, child))
        self.suffix = suffix = [0] * (len(self.moves) + 1)
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(suffix)
        while level:
            below = []
            for state in level:
                found = own.get(state)
                good = found is not None and self.alone(found[0])
                self.ending[state] = ((found,) if good else ()) + (self.ending[suffix[state]] if state else ())
                for byte, child in children.get(state, ()):
                    suffix[child] = self.move(suffix[state], byte) if state else 0
                    below.append(child)
            level = below

    def move(self, state: int, byte: int) -> int:
        """The state after one more byte."""
        passed = []
        while (found := self.moves.get(state << 8 | byte)) is None and state:
            passed.append(state)
            state = self.suffix[state]
        found = found or 0
        for state in passed:
            self.moves[state << 8 | byte] = found
        return found

    def compatible(self, left: int, right: int, below: int) -> bool:
        """Whether no merge older than ``below`` crosses the seam while the two tokens form."""
        while True:
            merged = self.pairs.get((left, right))
            if merged is not None and merged < below:
                return False
            # Undo the younger of the two tokens; what crossed the seam before it formed must be older.
            if left > right:
                below, part = left, self.parts[left][1]
                if part != left:
                    left = part
                    continue
                below, part = right + 1, self.parts[right][0]
                if part == right:
                    return True
                right = part
            else:
                below, part = right + 1, self.parts[right][0]
                if part != right:
                    right = part
                    continue
                below, part = left, self.parts[left][1]
                if part == left:
                    return True
                left = part

    def alone(self, token: int) -> bool:
        """Whether the bytes of a token encode to just this token."""
        known = self.whole.get(token)
        if known is None:
            left, right = self.parts[token]
            known = left == token or self.alone(left) and self.alone(right) and self.compatible(left, right, token)
            self.whole[token] = known
        return known

    def encode_piece(self, piece: str) -> list[int]:
        """The ids of one piece: last tokens of all prefixes from left to right, then back from the end."""
        moves, ending, fits, top = self.moves, self.ending, self.fits, len(self.ids)
        if len(fits) > REMEMBERED:
            fits.clear()
        last: list[tuple[int, int]] = []
        state = 0
        for end, byte in enumerate(piece.encode(), 1):
            found = moves.get(state << 8 | byte)
            state = self.move(state, byte) if found is None else found
            for match in ending[state]:
                token, size = match
                if size == end:
                    break
                left = last[end - size - 1][0]
                good = fits.get(left * top + token)
                if good is None:
                    good = fits[left * top + token] = self.compatible(left, token, top)
                if good:
                    break
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
            last.append(match)
        out, end, ids = [], len(last), self.ids
        while end:
            token, size = last[end - 1]
            out.append(ids[token])
            end -= size
        out.reverse()
        return out

    def encode_run(self, run: str) -> list[int]:
        """The ids of text that holds whole pieces and no added token."""
        ids: list[int] = []
        for piece in self.pieces.findall(run):
            ids += self.known.get(piece) or self.encode_piece(piece)
        return ids

    def encode(self, text: str | None) -> list[int]:
        """The ids of a whole text; the added tokens of the vocabulary count where they stand in the text."""
        ids: list[int] = []
        known = self.known
        parts = self.special_split.split(text or "") if self.special_split else [text or ""]
        for part in parts:
            if part in self.special:
                ids.append(self.special[part])
                continue
            if not part:
                continue
            if UNCLEAR.search(part):
                runs = self.pieces.findall(part)
            else:
                first, *rest = part.split(" ")
                runs = [first, *[" " + x for x in rest]] if rest else [first]
            for run in runs:
                found = known.get(run)
                if found is None:
                    found = self.encode_run(run)
                    if len(run) <= LONG_PIECE:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[run] = found
                ids += found
        return ids

    def decode(self, ids: list[int] | None) -> str:
        get = self.bytes.get
        return b"".join([get(i, b"") for i in ids or ()]).decode("utf-8", "replace")


_coders: dict[str, PrefixBpe] = {}


def coder(path: str) -> PrefixBpe:
    """The coder of a vocabulary file, built once per worker process."""
    if path not in _coders:
        _coders[path] = PrefixBpe(path)
    return _coders[path]


def encode(col: Column, path: str | None = None) -> Column:
    """Text -> array of token ids."""
    path = path or default_vocabulary()

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return texts.map(coder(path).encode)

    return ids(col)


def decode(col: Column, path: str | None = None) -> Column:
    """Array of token ids -> text."""
    path = path or default_vocabulary()

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: coder(path).decode(None if x is None else list(x)))

    return text(col)


def n_tokens(col: Column, path: str | None = None) -> Column:
    """Text -> number of its token ids."""
    path = path or default_vocabulary()

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: len(coder(path).encode(x)))

    return count(col)


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Encode each text, decode the ids again, and return both sides' digests, one row per document.

    Columns: ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas),
    ``decoded_sha256`` (of the decoded text in UTF-8) and, on request, ``ids``.  Texts are
    encoded where they are read; nothing is shuffled.
    """
    path = path or default_vocabulary()

    def make():
        one = coder(path)
        name = one.decimal.__getitem__

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            all_ids = []
            for text in batch.column(1).to_pylist():
                ids = one.encode(text)
                rows["n_tokens"].append(len(ids))
                rows["ids_sha256"].append(hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(one.decode(ids).encode()).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            columns = [batch.column(0), pa.array(rows["n_tokens"], pa.int64())]
            columns += [pa.array(rows[n], pa.string()) for n in ("ids_sha256", "decoded_sha256")]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names=names)

        return step

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(by_batch(make), schema)
