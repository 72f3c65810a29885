"""Secret scan: an Aho-Corasick prefilter, anchored expressions near its hits, and embedded checksums.

An automaton of keywords runs over each text once, letters of ASCII in lower case; only where it reports a
keyword is the kind's expression tried, at the keyword's place (``match`` there, never a search).  Runs of hexadecimal digits have
no keyword; for them the text is reduced to *digit* and *other*, and the keyword is as many digits as a run needs.  So texts without a
hit cost two passes in C, and a text with hits costs time in proportion to its length: a place inside an earlier match of the
kind is not tried again.

Kinds.  *Base* ones count by their form: ``assign`` (a value given to a name such as password), ``access`` (access
key ids), ``hex`` (long runs of hexadecimal digits).  Further ones count only if the checksum inside them is right, so that
look-alikes and keys with a changed character are left alone: ``github`` and ``npm`` tokens (CRC-32 in base 62), ``extended`` private
keys (base 58 with a double SHA-256) and ``bech32`` secret keys (its own code over names and data).

Places are code points, ends exclusive.  Whole texts are read.  Defined results: a null text is empty; a text without secrets has counts
of 0 and empty ``spans``; spans of different kinds may overlap and are all listed; repeated rows are scanned one by one; an empty
table gives no rows; columns other than the id and the text are not read (``redact`` keeps them).
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import by_batch

# Fixed values.
DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
DIGITS58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
DIGITS32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
EXTENDED_BYTES = 82


def crc62(value: str) -> bool:
    """Whether the last six digits to the base 62 are the CRC-32 of what stands between the prefix and them."""
    body, said = value[value.index("_") + 1 : -6], value[-6:]
    total = 0
    for c in said:
        total = total * 62 + DIGITS62.index(c)
    return total == zlib.crc32(body.encode())


def base58(value: str) -> bool:
    """Whether an extended key's last four bytes are the checksum of the others."""
    total = 0
    for c in value:
        total = total * 58 + DIGITS58.index(c)
    if total >> 8 * EXTENDED_BYTES:
        return False
    data = total.to_bytes(EXTENDED_BYTES, "big")
    return hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


def bech32(value: str) -> bool:
    """Whether a key in one case only fulfils its code over name and data."""
    if value not in (value.lower(), value.upper()):
        return False
    name, _, data = value.lower().rpartition("1")
    check = 1
    for v in [ord(c) >> 5 for c in name] + [0] + [ord(c) & 31 for c in name] + [DIGITS32.index(c) for c in data]:
        top = check >> 25
        check = (check & 0x1FFFFFF) << 5 ^ v
        for i, step in enumerate(BECH32_STEPS):
            check ^= step if top >> i & 1 else 0
    return check == 1


@dataclass(frozen=True)
class Kind:
    """Keywords in lower case at which the expression is tried; a match counts if ``valid`` says so."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: Callable[[re.Match], bool]


KINDS = [
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
        re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII),
        lambda m: m.end(1) - m.start(1) >= 6,
    ),
    Kind("access", ("akia",), re.compile("AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 20),
    Kind("hex", (), re.compile("[0-9a-f]+"), lambda m: m.end() - m.start() >= 24),
    Kind("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile("gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: crc62(m[0])),
    Kind("npm", ("npm_",), re.compile("npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: crc62(m[0])),
    Kind("extended", ("xprv", "tprv"), re.compile(f"[xt]prv[{DIGITS58}]{{107}}(?![A-Za-z0-9])"), lambda m: base58(m[0])),
    Kind("bech32", ("age-secret-key-1", "nsec1"), re.compile(f"(?i:AGE-SECRET-KEY-1|nsec1)(?i:[{DIGITS32}]{{58}})(?![A-Za-z0-9])"), lambda m: bech32(m[0])),
]
BASE = ["assign", "access", "hex"]
HEX = next(i for i, kind in enumerate(KINDS) if kind.name == "hex")
HEX_LEAST = 24
_DIGIT = bytes(1 if b in b"0123456789abcdef" else 0 for b in range(256))

Span = tuple[int, int, int]


def automaton(kinds: list[Kind] = KINDS) -> ahocorasick.Automaton:
    """The automaton of all keywords; each reports its length and the number of its kind."""
    made = ahocorasick.Automaton()
    for number, kind in enumerate(kinds):
        for keyword in kind.keywords:
            made.add_word(keyword, (len(keyword), number))
    made.make_automaton()
    return made


def _hits(keywords: ahocorasick.Automaton, data: bytes) -> Iterator[tuple[int, int]]:
    """Places (bytes) and kinds of all keywords, each kind's from left to right."""
    # A text of one character for each byte: places are bytes, and no letter beyond ASCII changes.
    for last, (length, number) in keywords.iter(data.lower().decode("latin-1")):
        yield last - length + 1, number
    digits = data.translate(_DIGIT)
    at = digits.find(b"\x01" * HEX_LEAST)
    while at >= 0:
        yield at, HEX
        end = digits.find(b"\x00", at)
        at = digits.find(b"\x01" * HEX_LEAST, end) if end >= 0 else -1


def spans(text: str | None, keywords: ahocorasick.Automaton) -> list[Span]:
    """``start``, number of the kind and ``end`` of all secrets, in code points and in order."""
    data = (text or "").encode()
    plain, reached, found = None, [0] * len(KINDS), []
    for at, number in _hits(keywords, data):
        if at < reached[number]:
            continue
        plain = data.decode("latin-1") if plain is None else plain
        match = KINDS[number].pattern.match(plain, at)
        if not match:
            continue
        reached[number] = match.end()
        if KINDS[number].valid(match):
            found.append((at, number, match.end()))
    if found and len(data) != len(text):
        # From bytes to code points: the bytes that begin one are counted up to each place, in order.
        places, points, before = {}, 0, 0
        for place in sorted({p for at, _, end in found for p in (at, end)}):
            points += len(data[before:place].decode())
            places[place], before = points, place
        found = [(places[at], number, places[end]) for at, number, end in found]
    return sorted(found)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (structs of ``start``, ``kind``, ``end``) of every row."""

    def make():
        keywords = automaton()
        names = pa.array([kind.name for kind in KINDS])

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [spans(text, keywords) for text in batch.column(1).to_pylist()]
            flat = [s for each in found for s in each]
            start, number, end = (pa.array([s[k] for s in flat], pa.int32()) for k in range(3))
            offsets = [0]
            for each in found:
                offsets.append(offsets[-1] + len(each))
            items = pa.StructArray.from_arrays([start, names.take(number), end], ["start", "kind", "end"])
            return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)], names=["doc_id", "spans"])

        return step

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(by_batch(make), "doc_id long, spans array<struct<start:int,kind:string,end:int>>")


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of base spans of each kind, the digest of all base spans, and all ``spans``."""
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def covered(text: str, found: list[Span]) -> str:
    """``text`` with each stretch of spans replaced by the kind of its first one."""
    out, at = [], 0
    for start, number, end in found:
        if start >= at:
            out += [text[at:start], f"[{KINDS[number].name}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced by their kinds; all rows and other columns stay as they are."""
    place = docs.columns.index("text")

    def make():
        keywords = automaton()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t and covered(t, spans(t, keywords)) for t in batch.column(place).to_pylist()]
            return batch.set_column(place, batch.schema.names[place], pa.array(texts, pa.string()))

        return step

    plain = docs.withColumn("text", F.col("text").cast("string"))
    return plain.mapInArrow(by_batch(make), plain.schema)
