"""Word n-gram scores of whole texts by a weighted backoff automaton.

Tokens are words (cut at blanks and ASCII control white space, A-Z in lower case) and one
end per text, which also is the history of a text's first word.  All words and all n-grams
of up to three words of all training texts are counted; nothing is cut, so the model grows
with the corpus.

A history of one or two words is a state if it occurs in training.  An n-gram that occurs is
an arc from its history; a word that does not follow a state takes the failure arc to the
next shorter history.  Single words have the probability ``(c + 0.5) / (N + 0.5 (V + 1))``,
the rest being one unknown word.  A longer history takes ``STRENGTH`` more tokens from the
next shorter one: ``(c(h w) + STRENGTH * p(w | shorter h)) / (c(h) + STRENGTH)``, so a
failure arc weighs ``STRENGTH / (c(h) + STRENGTH)`` and the probabilities after any history
sum to one.

No task holds the whole automaton.  Texts are gathered into blocks of bounded size and
written, training and held-out texts apart.  A block sends each of its n-grams once, in
sorted slices by ranges of 64-bit hashes; a range adds up the counts of all blocks and
answers every block with the counts of its own n-grams.  With these the block has all arcs
and failure arcs that its texts can take, and walks each text once from left to right.  A
frequent n-gram is one number in each slice, so no range is larger for it.  The number of
ranges grows with the tokens; a range holds about ``RANGE_GRAMS`` numbers.

Words are told apart by 64-bit hashes, n-grams by hashes that are ``SPARE_BITS`` longer than the
number of tokens (64 at most), so that less than one n-gram in 500,000 shares its count with
another up to 10^13 tokens.

Defined results: a null text is empty and has the end token only; a null doc_id counts as
training; repeated rows count and are scored one by one; without training texts every
token is unknown and has probability one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import by_batch, written

#: Tokens that a history takes from the next shorter one.
STRENGTH = 5.0
ORDER = 3
FOLDS, HELD_OUT_FOLD = 5, 1
#: The end token; no word is empty.
END = b""
#: Tokens after which a block is closed (a longer text is a block of its own) and n-grams of a hash range.
BLOCK_TOKENS = 1_000_000
RANGE_GRAMS = 4_000_000
#: Distinct words whose hashes a task remembers.
REMEMBERED = 300_000
#: Bits of an n-gram's hash beyond those of the number of n-grams.
SPARE_BITS = 20

#: Odd multiplier that spreads word hashes before the next word is added.
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[bytes]:
    """Words of a text; bytes are lowered and split by ASCII rules only."""
    return (text or "").encode().lower().split()


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; a null id is not."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


class Hashes(dict):
    """Word -> 64-bit hash, remembered for the words met so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = made = xxhash.xxh3_64_intdigest(word)
        return made


def blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Texts gathered into rows: ``block``, ``train``, ``n_tokens``, the list ``ids``, and ``sizes`` and ``texts`` (see ``joined_texts``)."""
    numbers = pa.list_(pa.int64())
    kinds = [("block", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("ids", numbers), ("sizes", numbers), ("texts", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        gathered = {side: ([], [], []) for side in (False, True)}

        def closed(side: bool) -> pa.RecordBatch:
            nonlocal made
            ids, texts, sizes = gathered[side]
            lengths, data = joined_texts(texts)
            row = [[first + made], [side], [sum(sizes)], [list(ids)], [lengths], [data]]
            for gone in (ids, texts, sizes):
                gone.clear()
            made += 1
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, (_, k) in zip(row, kinds)], names=[n for n, _ in kinds])

        open_tokens = {False: 0, True: 0}
        for batch in batches:
            for doc_id, text, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                said = text.as_py() or ""
                size, side = len(tokens(said)) + 1, not held
                if open_tokens[side] and open_tokens[side] + size > block_tokens:
                    yield closed(side)
                    open_tokens[side] = 0
                for kept, value in zip(gathered[side], (doc_id, said, size)):
                    kept.append(value)
                open_tokens[side] += size
        for side, size in open_tokens.items():
            if size:
                yield closed(side)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out(F.col("doc_id").cast("long")))
    return rows.mapInArrow(run, "block long, train boolean, n_tokens long, ids array<long>, sizes array<long>, texts binary")


def joined_texts(texts: list[str]) -> tuple[list[int], bytes]:
    """Lengths in bytes, and all texts in one compressed string."""
    parts = [t.encode() for t in texts]
    return [len(p) for p in parts], zstandard.compress(b"".join(parts), 6)


def parted_texts(sizes: list[int], data: bytes) -> list[str]:
    whole, at, texts = zstandard.decompress(data), 0, []
    for size in sizes:
        texts.append(whole[at : at + size].decode())
        at += size
    return texts


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes, so that equal high bytes lie together."""
    return zstandard.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T).tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1).T).view(kind).ravel()


def gram_hashes(texts: list[str], hashes: Hashes, bits: int, longest: int = ORDER) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the n-grams of one to ``longest`` tokens ending at each token of ``texts``, and the number of tokens of each text.

    The first entry of a text is its start and stands for no token; n-grams that would reach before it are 0.
    """
    line: list[int] = []
    sizes: list[int] = []
    for text in texts:
        words = tokens(text)
        line.append(hashes[END])
        line.extend([hashes[w] for w in words])
        line.append(hashes[END])
        sizes.append(len(words) + 1)
    single = np.array(line, np.uint64)
    counts = np.array(sizes, np.int64)
    starts = np.cumsum(counts + 1) - counts - 1
    place = np.arange(len(single)) - np.repeat(starts, counts + 1)
    grams = [single]
    for length in range(2, longest + 1):
        longer = np.zeros(len(single), np.uint64)
        longer[1:] = (grams[-1][:-1] ^ (grams[-1][:-1] >> np.uint64(29))) * SPREAD + single[1:]
        longer[place < length - 1] = 0
        grams.append(longer)
    grams[0] = np.where(place > 0, single, np.uint64(0))
    return [grams[0], *(g >> np.uint64(64 - bits) for g in grams[1:])], counts


def distinct(grams: list[np.ndarray]) -> list[np.ndarray]:
    """The different single words and the different longer n-grams, each sorted, and how often each is there; 0 is none."""
    found = []
    for level in (grams[0], np.concatenate(grams[1:])):
        keys, times = np.unique(level, return_counts=True)
        real = keys != 0
        found += [keys[real], times[real].astype(np.uint32)]
    return found


def slices(texts: DataFrame, ranges: int, bits: int, longer: bool = True) -> DataFrame:
    """The n-grams of every block cut by hash range: ``part``, ``block``, ``keys``, ``times`` (null where the block does not train).

    Parts from 0 on are ranges of longer n-grams, those below are ranges of single words;
    only these if not ``longer``.
    """
    word_edges, gram_edges = (np.array([(r << width) // ranges for r in range(1, ranges)], np.uint64) for width in (64, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for row in range(batch.num_rows):
                block, train, sizes, data = (batch.column(c)[row].as_py() for c in range(4))
                said = parted_texts(sizes, data)
                levels = gram_hashes(said, hashes, bits, ORDER if longer else 1)[0]
                words, word_times, grams, gram_times = distinct(levels if longer else [levels[0], levels[0][:0]])
                out: list[list] = [[], [], [], []]
                kinds = [(words, word_times, word_edges, lambda r: -1 - r), (grams, gram_times, gram_edges, lambda r: r)]
                for keys, times, edges, part_of in kinds if longer else kinds[:1]:
                    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        if b > a:
                            out[0].append(part_of(number))
                            out[1].append(block)
                            out[2].append(packed(np.diff(keys[a:b], prepend=np.uint64(0))))
                            out[3].append(packed(times[a:b]) if train else None)
                columns = [pa.array(c, k) for c, k in zip(out, [pa.int64(), pa.int64(), pa.binary(), pa.binary()])]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "keys", "times"])

    return texts.select("block", "train", "sizes", "texts").mapInArrow(run, "part long, block long, keys binary, times binary")


def answers(cut: DataFrame) -> DataFrame:
    """Counts over all training blocks for each slice: ``part``, ``block``, ``counts``; the row of block -1 has the number of trained n-grams in ``n``."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        asked = [np.cumsum(unpacked(k.as_py(), np.uint64), dtype=np.uint64) for k in table.column("keys")]
        times = [t.as_py() for t in table.column("times")]
        trained = [(k, unpacked(t, np.uint32)) for k, t in zip(asked, times) if t is not None]
        known, total = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if trained:
            keys = np.concatenate([k for k, _ in trained])
            order = np.argsort(keys)
            keys, counts = keys[order], np.concatenate([t for _, t in trained]).astype(np.uint64)[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            known, total = keys[first], np.add.reduceat(counts, first)
        back = []
        for keys in asked:
            found = np.zeros(len(keys), np.uint64)
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                found = np.where(known[at] == keys, total[at], np.uint64(0))
            back.append(packed(found))
        columns = [
            pa.array([part] * (len(back) + 1), pa.int64()),
            pa.array([*table.column("block").to_pylist(), -1], pa.int64()),
            pa.array([*back, None], pa.binary()),
            pa.array([None] * len(back) + [len(known)], pa.int64()),
        ]
        return pa.Table.from_arrays(columns, names=["part", "block", "counts", "n"])

    return cut.groupBy("part").applyInArrow(run, "part long, block long, counts binary, n long")


def walk(arcs: list[list[float]], has: list[list[bool]], failures: list[list[float]]) -> float:
    """Log10 probability of one text, whose start is at 0 and whose end token comes last.

    The state is the length of the history that is known.  ``arcs[n][i]`` is the weight of token i after n tokens,
    ``has[n][i]`` whether that n-gram is an arc, ``failures[n][i]`` the weight of leaving the state of the n tokens before i.
    """
    total, state = 0.0, 1
    for i in range(1, len(arcs[0])):
        while state and not has[state][i]:
            total += failures[state][i]
            state -= 1
        total += arcs[state][i]
        # The n-gram of the arc is the next state, but for its first token if it is a longest one; an unknown word leads to the empty state.
        state = min(state + 1, ORDER - 1) if has[state][i] else 0
    return total


def walks(arcs: list[np.ndarray], has: list[np.ndarray], failures: list[np.ndarray], firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``walk`` for all texts of a block at once, which lie one after the other from ``firsts`` to ``ends``.

    An n-gram that occurs has all its shorter ones, so the state before a token follows from the token before it alone.
    Where two n-grams share a hash that may not hold; a text in which a step does not lead to the next state is walked by itself.
    """
    state = np.zeros(len(has[0]), np.int64)
    state[1:] = np.where(has[1][:-1], ORDER - 1, has[0][:-1])
    state[firsts + 1] = 1
    used = np.where((state == ORDER - 1) & has[2], 2, np.where((state > 0) & has[1], 1, 0))
    after = np.where(used > 0, ORDER - 1, has[0])
    total = np.choose(used, arcs)
    for order in range(1, ORDER):
        total += np.where((state >= order) & (used < order), failures[order], 0.0)
    total[firsts] = 0.0
    scores = np.add.reduceat(total, firsts)
    wrong = np.zeros(len(state), bool)
    wrong[1:] = after[:-1] != state[1:]
    # The first token of a text follows its start, which is no token; nothing leads to a start.
    wrong[firsts] = wrong[firsts + 1] = False
    for text in np.flatnonzero(np.logical_or.reduceat(wrong, firsts)).tolist():
        a, b = int(firsts[text]), int(ends[text])
        scores[text] = walk(*([level[a : b + 1].tolist() for level in kind] for kind in (arcs, has, failures)))
    return scores


def score_block(texts: list[str], words: np.ndarray, grams: np.ndarray, n_tokens: int, n_words: int, hashes: Hashes, bits: int, strength: float) -> list[list]:
    """Tokens, known tokens, base score and score of each text, from the counts of the block's sorted words and longer n-grams."""
    levels, sizes = gram_hashes(texts, hashes, bits)

    def counts(level: np.ndarray, answered: np.ndarray) -> np.ndarray:
        # In order, the n-grams stand as they were asked (see distinct); 0 is none and comes first.
        order = np.argsort(level)
        keys = level[order]
        fresh = keys != 0
        fresh[1:] &= keys[1:] != keys[:-1]
        found = np.empty(len(level))
        found[order] = np.concatenate(([0], answered)).astype(np.float64)[np.cumsum(fresh)]
        return found

    times = [counts(levels[0], words), *np.split(counts(np.concatenate(levels[1:]), grams), ORDER - 1)]
    firsts = np.cumsum(sizes + 1) - sizes - 1
    ends = firsts + sizes
    # A start is the end token as a history: it was met as often as there are texts.
    as_history = times[0].copy()
    as_history[firsts] = times[0][ends]
    before = [None, np.concatenate(([0.0], as_history[:-1])), np.concatenate(([0.0], times[1][:-1]))]
    chance = (times[0] + 0.5) / (n_tokens + 0.5 * (n_words + 1))
    chances, failures = [chance], [np.zeros(len(chance))]
    for length in range(1, ORDER):
        chance = (times[length] + strength * chance) / (before[length] + strength)
        chances.append(chance)
        failures.append(np.log10(strength / (before[length] + strength)))
    arcs = [np.log10(c) for c in chances]
    base = np.add.reduceat(np.where(levels[0] != 0, arcs[0], 0.0), firsts)
    known = np.add.reduceat((times[0] > 0).astype(np.int64), firsts)
    whole = walks(arcs, [t > 0 for t in times], failures, firsts, ends)
    return [sizes.tolist(), known.tolist(), base.tolist(), whole.tolist()]


def score_documents(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, range_grams: int = RANGE_GRAMS, strength: float = STRENGTH) -> DataFrame:
    """Train on the documents that are not held out, score all.

    Columns: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.
    The sizes of blocks and ranges do not change the result.
    """
    texts = written(blocks(docs, block_tokens), "lm-blocks")
    row = texts.agg(F.sum("n_tokens"), F.sum(F.when(F.col("train"), F.col("n_tokens")))).first()
    all_tokens, n_tokens = int(row[0] or 0), int(row[1] or 0)
    n_grams = (ORDER - 1) * all_tokens
    ranges, bits = max(1, math.ceil(n_grams / range_grams)), min(64, n_grams.bit_length() + SPARE_BITS)
    # Every chance needs the number of words first; counting them apart spares a table of all answers.
    words = answers(slices(texts.filter("train"), ranges, bits, longer=False))
    n_words = int(words.filter("block = -1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    known = answers(slices(texts, ranges, bits)).filter("block >= 0").groupBy("block").agg(F.collect_list(F.struct("part", "counts")).alias("slices"))
    joined = texts.select("block", "train", "ids", "sizes", "texts").join(known, "block")

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        hashes = Hashes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[list] = [[], [], [], [], [], []]
            for row in range(batch.num_rows):
                train, ids, lengths, data, cut = (batch.column(c)[row].as_py() for c in range(5))
                said = parted_texts(lengths, data)
                parts = {s["part"]: s["counts"] for s in cut}
                words, grams = (
                    np.concatenate([unpacked(parts[p], np.uint64) for p in order] or [np.zeros(0, np.uint64)])
                    for order in (sorted((p for p in parts if p < 0), reverse=True), sorted(p for p in parts if p >= 0))
                )
                if n_tokens:
                    scored = score_block(said, words, grams, n_tokens, n_words, hashes, bits, strength)
                else:
                    scored = [[len(tokens(t)) + 1 for t in said], [0] * len(said), [0.0] * len(said), [0.0] * len(said)]
                for kept, values in zip(out, [ids, [not train] * len(ids), *scored]):
                    kept.extend(values)
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

        return step

    scores = joined.select("train", "ids", "sizes", "texts", "slices").mapInArrow(
        by_batch(make), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    train_tokens = F.lit(n_tokens).cast("long").alias("train_tokens")
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", train_tokens, "base_score", "score")
