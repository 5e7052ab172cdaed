"""Packing: order-preserving dynamic programming over window cuts.

Documents are tokenised, ended by one id and laid end to end in the order in
which a task reads them.  A sequence is a window of this stream of at most
``capacity`` ids.  Cuts may lie at document ends (no penalty), at sentence
ends (a small one) and, where sentences are long, at a grid (a larger one).  A
window of n ids has padding(n) = 0 where n is a power of two, else
capacity - n, and costs WINDOW besides, so that short ones are not made for
nothing.  With dp[j] the least cost of cutting at j,

    dp[j] = penalty[j] + WINDOW + min(dp[i] + padding(j - i) : j - capacity <= i < j).

Over all i, capacity - j + (dp[i] + i) is a sliding-window minimum kept in a
monotone queue, so a cut costs O(1); the few i at which j - i is a power of two
are looked up in a table of positions.  A task streams: it solves a stretch of
the stream, keeps the windows but the last ones, and carries the rest over.

What is left at the end of a task, ``capacity`` ids at most, is not packed
there: the tails of all tasks are laid end to end and packed in the same way
by a few tasks, so padding doesn't grow with the number of partitions.
Sequence ids are a pass, the task's number and a counter.

A sequence is padded to ``capacity``, except when its length is a power of two.

Edge cases: null or empty text is one id, the end; a document longer than
``capacity`` spans sequences; repeated rows are packed once each; a null
doc_id stays null; extra columns are ignored; an empty table gives no rows; a
capacity below 1 is an error.
"""

from __future__ import annotations

import os
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm.common import written
from spotweave.llm.text import give_back, hashes, raw, text_slices, word_bounds

CAPACITY, END_ID = 2048, 1
#: Penalties in ids of padding (of a cut at the end of a sentence, of one inside, of every window); ids of which one sentence end is a candidate; the grid's step, and the gap between cuts from which it is used.
SENTENCE, INSIDE, WINDOW, SPACING, GRID, GAP = 4.0, 24.0, 48.0, 16, 16, 48
#: Ids solved at once, ids of tails that a task packs, bytes of text tokenised at once, slots of the table of words as a power of two.
STRETCH, TAIL_IDS, SLICE, TABLE_BITS = 1 << 18, 1 << 22, 1 << 18, 20
PIECES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
TAIL = "struct<doc_id:array<bigint>,start:array<bigint>,length:array<bigint>,doc_tokens:array<bigint>,ids:binary>"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_open: dict[str, WordTokenizer] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Closing punctuation after a letter or digit, before white space, is a word of its own: the tokenizer's pattern always splits there.  Letters of two bytes are À to ÿ but × and ÷.
CLOSING = np.zeros(256, bool)
CLOSING[list(b".,;:!?#$%&*|")] = True
LETTER = np.zeros(256, bool)
LETTER[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
LETTER_TAIL = np.zeros(256, bool)
LETTER_TAIL[0x80:0xC0] = True
LETTER_TAIL[[0x97, 0xB7]] = False
#: Texts with combining marks, which compose with some capitals only, or the opening of a special token's string are encoded as they are.
AS_THEY_ARE = r"[\x{300}-\x{37f}]|<\|"
#: A second hash of words, independent of the first.
CODES = np.random.default_rng(31).integers(0, 2**64, 256, dtype=np.uint64)


def closing_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the words of lowered texts, closing punctuation apart."""
    starts, ends = word_bounds(data, off)
    if not len(starts):
        return starts, ends
    body = np.maximum.accumulate(np.where(CLOSING[data], -1, np.arange(len(data), dtype=np.int32)))[ends - 1]
    before = data[np.maximum(body - 1, 0)]
    letter = LETTER[data[body]] | (LETTER_TAIL[data[body]] & (before == 0xC3) & (body > starts))
    final = np.zeros(len(data) + 1, bool)
    final[off[1:]] = True
    cut = np.flatnonzero((body >= starts) & (body < ends - 1) & letter & ~final[ends])
    return np.insert(starts, cut + 1, body[cut] + 1), np.insert(ends, cut, body[cut] + 1)


class WordTable:
    """Ids of words by two hashes of each: open addressing in arrays, all look-ups of a call at once."""

    def __init__(self, bits: int = TABLE_BITS):
        self.bits, self.mask = bits, (1 << bits) - 1
        self.hash, self.check = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.start, self.size, self.hits = (np.zeros(1 << bits, np.int32) for _ in range(3))
        self.flat = np.zeros(0, np.uint32)
        self.held = 0

    def slots(self, one: np.ndarray) -> np.ndarray:
        """The slot of each first hash, or the free one where it would go."""
        slot = (one >> np.uint64(64 - self.bits)).astype(np.int64)
        there = self.hash[slot]
        lost = np.flatnonzero((there != one) & (there != 0))
        while len(lost):
            slot[lost] = (slot[lost] + 1) & self.mask
            there = self.hash[slot[lost]]
            lost = lost[(there != one[lost]) & (there != 0)]
        return slot

    def add(self, one: np.ndarray, two: np.ndarray, ids: list[np.ndarray]) -> None:
        """Words whose first hashes differ; one that shares a first hash with an older word replaces it."""
        if self.held + len(one) > self.mask // 2:
            self._forget(self.mask // 4)
        size = np.fromiter(map(len, ids), np.int32, len(ids))
        start = (np.cumsum(size) - size + len(self.flat)).astype(np.int32)
        self.flat = np.concatenate((self.flat, *ids))
        self._place(one, two, start, size, np.zeros(len(one), np.int32))

    def _place(self, one, two, start, size, hits) -> None:
        left = np.arange(len(one))
        while len(left):
            slot = self.slots(one[left])
            self.held += int(np.count_nonzero(self.hash[slot] == 0))
            self.hash[slot] = one[left]  # of several that want a slot the last has it
            won = self.hash[slot] == one[left]
            at, own = slot[won], left[won]
            self.check[at], self.start[at], self.size[at], self.hits[at] = two[own], start[own], size[own], hits[own]
            left = left[~won]
        self.held = int(np.count_nonzero(self.hash))

    def _forget(self, keep: int) -> None:
        """Keep the words that were met most."""
        some = np.flatnonzero(self.hash)
        some = some[np.argsort(-self.hits[some], kind="stable")[:keep]]
        one, two, size, start, hits = self.hash[some], self.check[some], self.size[some], self.start[some], self.hits[some] // 2
        upto = np.cumsum(size, dtype=np.int64)
        self.flat = self.flat[np.repeat(start - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)]
        self.hash[:], self.held = 0, 0
        self._place(one, two, (upto - size).astype(np.int32), size, hits)


class WordTokenizer:
    """Whole texts to ids for tokenizers that treat words between white space apart.

    Words are found and hashed for a column of texts at once.  Their ids are
    kept in a bounded table by one hash, verified by a second one.  To need
    fewer entries, A-Z are lowered first, as the tokenizer lowers them itself,
    and closing punctuation becomes a word of its own.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        size = self.tok.get_vocab_size()
        self.sentence_end, self.word_end = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        for token, i in self.tok.get_vocab().items():
            self.sentence_end[i] = token.removesuffix("</w>")[-1:] in (".", "!", "?")
            self.word_end[i] = token.endswith("</w>")
        self.table = WordTable()

    def _encoded(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word."""
        out: list = [None] * len(words)
        # A word of letters alone ends with the one id that closes it, so many can be encoded as one text.
        letters = [i for i, w in enumerate(words) if w.isalpha()]
        groups = [letters[at : at + 256] for at in range(0, len(letters), 256)]
        for group, e in zip(groups, self.tok.encode_batch_fast([" ".join([words[i] for i in g]) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            stops = np.flatnonzero(self.word_end[ids]) + 1
            if len(stops) == len(group):
                for i, own in zip(group, np.split(ids, stops[:-1]), strict=True):
                    out[i] = own
        todo = [i for i in range(len(words)) if out[i] is None]
        for i, e in zip(todo, self.tok.encode_batch_fast([words[i] for i in todo], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, np.uint32)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each) of a large_string column without nulls."""
        data, off = raw(texts)
        as_is = pc.match_substring_regex(texts, AS_THEY_ARE).to_numpy(zero_copy_only=False) if len(texts) else np.zeros(0, bool)
        data = LOWER[data]
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if as_is.any():  # their words are left out here
            for i in np.flatnonzero(as_is):
                data[off[i] : off[i + 1]] = 32
        starts, ends = closing_words(data, off)
        one, two = hashes(data, starts, ends), hashes(data, starts, ends, CODES)
        one[one == 0] = 1  # 0 marks a free slot
        table = self.table
        slot = table.slots(one)
        new = np.flatnonzero((table.hash[slot] != one) | (table.check[slot] != two))
        if len(new):
            _, first = np.unique(one[new], return_index=True)
            first = new[first]
            whole = data.tobytes()
            words = [whole[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            table.add(one[first], two[first], self._encoded(words))
            slot = table.slots(one)
            if (table.hash[slot] != one).any() or (table.check[slot] != two).any():
                return self._plain(texts)  # more words than the table takes, or two of one first hash
        table.hits[slot] += 1  # once a call, however often a word is met in it
        own = table.size[slot].astype(np.int64)
        upto = np.concatenate(([0], np.cumsum(own)))
        place = np.repeat(table.start[slot] - upto[:-1], own)
        place += np.arange(upto[-1])
        ids, size = table.flat[place], np.diff(upto[np.searchsorted(starts, off)])
        if as_is.any():
            ends = np.cumsum(size)
            parts = [ids[e - n : e] for e, n in zip(ends, size, strict=True)]
            for i in np.flatnonzero(as_is):
                parts[i] = np.array(self.tok.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
            ids, size = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return ids, size

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        own = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        return np.concatenate(own), np.array([len(x) for x in own], np.int64)


def tokenizer(path: str) -> WordTokenizer:
    if path not in _open:
        _open[path] = WordTokenizer(path)
    return _open[path]


def candidates(ids: np.ndarray, ends: np.ndarray, sentence_end: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, from 0 to its end and never over ``capacity`` apart, and their penalties."""
    penalty = np.full(len(ids) + 1, np.inf)
    sentences = np.flatnonzero(sentence_end[np.minimum(ids, len(sentence_end) - 1)]) + 1
    # Of the sentence ends in a run of SPACING ids the first is enough to choose from.
    penalty[sentences[np.diff(sentences // SPACING, prepend=-1) > 0]] = SENTENCE
    penalty[ends] = 0
    penalty[0] = penalty[-1] = 0
    at = np.flatnonzero(np.isfinite(penalty))
    wide = np.flatnonzero(np.diff(at) > min(GAP, capacity))
    grid = [np.arange(at[i] + min(GRID, capacity), at[i + 1], min(GRID, capacity)) for i in wide]
    if grid:
        penalty[np.concatenate(grid)] = INSIDE
        at = np.flatnonzero(np.isfinite(penalty))
    return at, penalty[at]


def exact_windows(at: np.ndarray, capacity: int) -> tuple[list[int], list[int]]:
    """(j, i), by j, of candidates that are a power of two apart, less than ``capacity``."""
    place = np.full(at[-1] + 1, -1, np.int32)
    place[at] = np.arange(len(at))
    js, is_ = [], []
    size = 1
    while size < capacity:
        j = np.arange(np.searchsorted(at, at[0] + size), len(at))
        i = place[at[j] - size]
        js.append(j[i >= 0])
        is_.append(i[i >= 0])
        size *= 2
    if not js:
        return [], []
    j, i = np.concatenate(js), np.concatenate(is_)
    order = np.argsort(j, kind="stable")
    return j[order].tolist(), i[order].tolist()


def best_cuts(at: np.ndarray, penalty: np.ndarray, capacity: int = CAPACITY, open_end: bool = False) -> list[int]:
    """The cuts, from the first candidate to the last, of least padding plus penalties.

    With an ``open_end`` the stream goes on: the cuts lead to the candidate of least cost among those of the last
    ``capacity`` positions (the first candidate, if there are no more positions), and the last one is none.
    """
    if capacity < 1:
        raise ValueError("a sequence holds one id at least")
    pos, pen = at.tolist(), (penalty + WINDOW).tolist()
    exact_j, exact_i = exact_windows(at, capacity)
    exact_j.append(-1)
    n, e = len(pos), 0
    dp, back = [0.0] * n, [0] * n
    queue = deque([(0.0 + pos[0], 0)])  # rising dp[i] + i
    for j in range(1, n):
        p = pos[j]
        low = p - capacity
        while pos[queue[0][1]] < low:
            queue.popleft()
        least, i = queue[0]
        least += capacity - p
        while exact_j[e] == j:
            if dp[exact_i[e]] < least:
                i = exact_i[e]
                least = dp[i]
            e += 1
        v = dp[j] = pen[j] + least
        back[j] = i
        v += p
        while queue and queue[-1][0] >= v:
            queue.pop()
        queue.append((v, j))
    cuts, j = [], n - 1
    if open_end:
        j = min(range(int(np.searchsorted(at, pos[-1] - capacity)), n - 1), key=dp.__getitem__, default=0)
    while j:
        cuts.append(pos[j])
        j = back[j]
    return cuts[::-1]


class Stream:
    """Parts of documents laid end to end: their doc_id, start in the document, number of ids here and in the document, and the ids."""

    def __init__(self, parts: list[tuple] = ()):
        self.parts = list(parts)

    def add(self, doc_id: pa.Array, start: np.ndarray, length: np.ndarray, doc_tokens: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append((doc_id, start, length, doc_tokens, ids))

    def joined(self) -> tuple:
        if len(self.parts) > 1:
            cols = list(zip(*self.parts, strict=True))
            self.parts = [(pa.concat_arrays(cols[0]), *map(np.concatenate, cols[1:]))]
        return self.parts[0]

    def __len__(self) -> int:
        return sum(len(p[4]) for p in self.parts)

    def taken(self, n: int) -> tuple:
        """Cut the first ``n`` ids off; they are returned as such columns."""
        doc_id, start, length, total, ids = self.joined()
        ends = np.cumsum(length)
        k = int(np.searchsorted(ends, n))  # the part in which the cut lies
        over = int(ends[k] - n)
        first = length[: k + 1].copy()
        first[k] -= over
        skip = k + (over == 0)
        rest_start, rest_length = start[skip:].copy(), length[skip:].copy()
        if over:
            rest_start[0] += length[k] - over
            rest_length[0] = over
        self.parts = [(doc_id[skip:], rest_start, rest_length, total[skip:], ids[n:].copy())] if n < len(ids) else []
        return doc_id[: k + 1], start[: k + 1], first, total[: k + 1], ids[:n]


def pieces(stream: tuple, cuts: list[int], first: int):
    """(doc_id, start, length, crc, doc_tokens, sequence, offset), and the bounds of each piece, of a stream cut into sequences from number ``first`` on."""
    doc_id, start, length, total, ids = stream
    ends = np.cumsum(length)
    cut = np.array(cuts)
    stop = np.union1d(ends, cut)
    begin = np.concatenate(([0], stop[:-1]))
    d, s = np.searchsorted(ends, begin, "right"), np.searchsorted(cut, begin, "right")
    crc = np.fromiter((zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), stop.tolist(), strict=True)), np.int64, len(stop))
    opens = np.concatenate(([0], cut[:-1]))
    return [doc_id.take(pa.array(d)), start[d] + begin - (ends - length)[d], stop - begin, crc, total[d], first + s, begin - opens[s]], begin, stop


def pack_stream(parts, sentence_end: np.ndarray, capacity: int = CAPACITY, stretch: int = STRETCH, to_end: bool = False):
    """From columns (doc_id, start, length, doc_tokens, ids) to (stream, cuts, number of the first sequence).

    Last of all comes what is left, ``capacity`` ids at most and with no cuts, unless the stream is packed ``to_end``.
    """
    held, sequence, stretch = Stream(), 0, max(stretch, 4 * capacity)

    def solved(n: int, open_end: bool):
        nonlocal sequence
        _, _, length, _, ids = held.joined()
        ends = np.cumsum(length)
        cuts = best_cuts(*candidates(ids[:n], ends[ends <= n], sentence_end, capacity), capacity, open_end)
        if cuts:
            yield held.taken(cuts[-1]), cuts, sequence
            sequence += len(cuts)

    for part in parts:
        held.add(*part)
        while len(held) > stretch:
            yield from solved(stretch, True)
    if len(held):
        yield from solved(len(held), not to_end)
    if len(held):
        yield held.taken(len(held)), [], sequence


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row a piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])."""
    if capacity < 1:
        raise ValueError("a sequence holds one id at least")
    path = path or default_tokenizer()
    kinds = [pa.int64()] * len(PIECES)

    def emit(stream, cuts, first, base):
        cols, begin, stop = pieces(stream, cuts, first)
        cols[5] = cols[5] + base
        arrays = [pa.array(c, k) if isinstance(c, np.ndarray) else c for c, k in zip(cols, kinds, strict=True)]
        if with_ids:
            arrays.append(pa.ListArray.from_arrays(pa.array(np.append(begin, stop[-1]).astype(np.int32)), pa.array(stream[4].astype(np.int64))))
        return arrays

    names = PIECES + ["ids"] * with_ids
    schema = ", ".join(f"{c} long" for c in PIECES) + ", ids array<long>" * with_ids

    def tokenised(batches, tok):
        for batch in text_slices(batches, "text", SLICE):
            ids, size = tok.encode(batch.column("text"))
            out = np.full(len(ids) + len(size), end_id, np.uint32)
            out[np.arange(len(ids)) + np.repeat(np.arange(len(size)), size)] = ids
            yield batch.column("doc_id"), np.zeros(len(size), np.int64), size + 1, size + 1, out

    def make(batches):
        tok = tokenizer(path)
        base = TaskContext.get().partitionId() << 33
        for stream, cuts, first in pack_stream(tokenised(batches, tok), tok.sentence_end, capacity):
            tail = None
            if cuts:
                arrays = emit(stream, cuts, first, base)
                tail = pa.nulls(len(arrays[0]), tail_kind)
            else:
                arrays = [pa.nulls(1, k) for k in kinds + [pa.list_(pa.int64())] * with_ids]
                doc_id, start, length, total, ids = stream
                tail = pa.array([{"doc_id": doc_id.to_pylist(), "start": start.tolist(), "length": length.tolist(), "doc_tokens": total.tolist(), "ids": ids.tobytes()}], tail_kind)
            yield pa.RecordBatch.from_arrays([*arrays, tail], [*names, "tail"])
        give_back()

    tail_kind = pa.struct([(c, pa.list_(pa.int64())) for c in ("doc_id", "start", "length", "doc_tokens")] + [("ids", pa.binary())])
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(make, f"{schema}, tail {TAIL}")
    rows = written(rows, "packed")

    def tails(batches):
        for batch in batches:
            for t in batch.column("tail"):
                ids = np.frombuffer(t["ids"].as_buffer(), "<u4")
                yield (t["doc_id"].values, *(t[c].values.to_numpy() for c in ("start", "length", "doc_tokens")), ids)

    def make_last(batches):
        tok = tokenizer(path)
        base = (1 << 62) + (TaskContext.get().partitionId() << 33)
        for stream, cuts, first in pack_stream(tails(batches), tok.sentence_end, capacity, to_end=True):
            yield pa.RecordBatch.from_arrays(emit(stream, cuts, first, base), names)

    left = rows.where("tail is not null").select("tail")
    many = left.agg(F.sum(F.octet_length("tail.ids"))).first()[0] or 0
    last = left.repartition(max(1, -(-many // (4 * TAIL_IDS)))).mapInArrow(make_last, schema)
    return rows.where("tail is null").drop("tail").unionByName(last)
