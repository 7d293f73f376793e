"""Token ids in a compact file format: an adaptive context-mixing range coder.

A block holds the ids of whole documents. It is cut into lanes that are coded
in step, so that each step is a few array operations over all lanes; the models
are shared by the lanes of a block, learn from all of them, and start afresh in
every block, so any block can be read by itself.

For each id, order 2 (the last id after the two before) and order 1 (the last id
after the one before) name a candidate. Whether a candidate is right is coded
with the probability that a logistic mix of three predictions gives: how often
the order-2 slot was right so far, how often the order-1 slot was, and how
frequent the candidate is at order 0. Other ids are coded by the order-0 counts.
Counters and mixing weights adapt as coding goes; all arithmetic that both sides
share is in integers.

A block is: magic, sizes, crc32 of the ids, crc32 of the body, then document
ids and lengths, lane lengths, and the lanes' 16-bit digits.

Files are Parquet tables with one block per row, in ascending order of document
id, ties by a hash of the text. Null ids come first. Null texts are empty: only
the end id. Repeated rows are documents like any other. Texts are encoded whole;
a document longer than a block has a longer block. Extra columns are ignored. An
empty table gives files without blocks and no rows.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import freeing, stretches
from tallyline.session import write_table

MAGIC = b"TKX1"
HEAD = struct.Struct("<4sIQIIIIII")
BLOCK_TOKENS = 1 << 21
LANE_TOKENS = 256
MAX_LANES = 8192
SLOT_BITS = 18
CONFIDENCE = 15
FLAG_BITS = 16
SYMBOL_BITS = 22
LEARN_ROUNDS = 16
COUNT_ROUNDS = 32
CACHE_RUNS = 60_000
END_ID = 2
TEXT_BYTES = 1 << 21

_WORD_IDS: dict = {}
_ONE = 1 << FLAG_BITS
_LOW = (1 << 32) - 1


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Logit of a 12-bit probability in units of 1/256, and its inverse as a 16-bit probability."""
    p = (np.arange(4096) + 0.5) / 4096
    logit = np.rint(np.log(p / (1 - p)) * 256).astype(np.int64)
    x = np.arange(-2048, 2048) / 256
    return logit, np.clip(np.rint(_ONE / (1 + np.exp(-x))), 32, _ONE - 32).astype(np.int64)


LOGIT, INVERSE = _tables()


def _bounds(size: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Where [0, one), [one, two) and [two, 1) begin and end in ranges of this size."""
    r = size >> FLAG_BITS
    bounds = np.zeros((4, len(size)), dtype=np.int64)
    np.multiply(r, one, out=bounds[1])
    np.multiply(r, two, out=bounds[2])
    np.left_shift(r, FLAG_BITS, out=bounds[3])
    return bounds


class _Shares:
    """Shares of all symbols in a range, and which symbol a place in it belongs to."""

    BUCKET_BITS = 6

    def __init__(self, share: np.ndarray):
        self.cum = np.concatenate([[0], np.cumsum(share)])
        self.first: np.ndarray | None = None

    def find(self, places: np.ndarray) -> np.ndarray:
        if self.first is None:
            edges = (self.cum + (1 << self.BUCKET_BITS) - 1) >> self.BUCKET_BITS
            # The symbol at the first place of each bucket, and one bucket more.
            self.first = np.append(np.repeat(np.arange(len(edges) - 1), np.diff(edges)), len(edges) - 2)
        bucket = places >> self.BUCKET_BITS
        symbols = self.first.take(bucket)
        open_ = np.flatnonzero(symbols != self.first.take(bucket + 1))
        symbols[open_] = np.searchsorted(self.cum, places[open_], "right") - 1
        return symbols


class _Encoder:
    """Range coder over all lanes: ``low`` may carry into digits already written; that is settled at the end."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, dtype=np.int64)
        self.range = np.full(lanes, 1 << 48, dtype=np.int64)
        self.lanes: list[np.ndarray] = []
        self.digits: list[np.ndarray] = []

    def _shift(self, at: np.ndarray) -> None:
        if len(at):
            low = self.low[at]
            # A digit has 16 bits, and one for a carry.
            self.lanes.append(at.astype(np.uint16))
            self.digits.append((low >> 32).astype(np.int32))
            self.low[at] = (low & _LOW) << 16
            self.range[at] <<= 16

    def choose(self, one: np.ndarray, two: np.ndarray, choice: np.ndarray) -> np.ndarray:
        """Code which of [0, one), [one, two) and [two, 1) was taken."""
        bounds = _bounds(self.range, one, two)
        at = choice * len(one) + np.arange(len(one))
        start = bounds.take(at)
        self.low += start
        self.range = bounds.take(at + len(one)) - start
        self._shift(np.flatnonzero(self.range <= _LOW))
        return choice

    def symbol(self, at: np.ndarray, shares: _Shares, symbols: np.ndarray) -> np.ndarray:
        r = self.range.take(at) >> SYMBOL_BITS
        start = shares.cum.take(symbols)
        self.low[at] += r * start
        self.range[at] = r * (shares.cum.take(symbols + 1) - start)
        self._shift(at[self.range[at] <= _LOW])
        return symbols

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Digits per lane, and the digits lane by lane."""
        every = np.arange(len(self.low))
        for _ in range(3):
            self._shift(every)
        lane, digits = np.concatenate(self.lanes), np.concatenate(self.digits)
        self.lanes, self.digits = [], []
        per_lane = np.bincount(lane, minlength=len(every))
        digits = digits.take(np.argsort(lane, kind="stable"))
        while len(over := np.flatnonzero(digits >> 16)):
            digits[over] &= 0xFFFF
            np.add.at(digits, over - 1, 1)
        return per_lane, digits.astype("<u2")


class _Decoder:
    def __init__(self, counts: np.ndarray, digits: np.ndarray):
        # Reading past the last lane's end is harmless: the coder looks no further than what it needs.
        self.digits = np.concatenate([digits.astype(np.int64), np.zeros(4, dtype=np.int64)])
        self.at = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        self.range = np.full(len(counts), 1 << 48, dtype=np.int64)
        self.code = np.zeros(len(counts), dtype=np.int64)
        for _ in range(3):
            self.code = (self.code << 16) | self.digits[self.at]
            self.at += 1

    def _shift(self, at: np.ndarray) -> None:
        if len(at):
            self.code[at] = (self.code[at] << 16) | self.digits[self.at[at]]
            self.at[at] += 1
            self.range[at] <<= 16

    def choose(self, one: np.ndarray, two: np.ndarray, _: object) -> np.ndarray:
        bounds = _bounds(self.range, one, two)
        choice = (self.code >= bounds[1]).astype(np.int64) + (self.code >= bounds[2])
        at = choice * len(one) + np.arange(len(one))
        start = bounds.take(at)
        self.code -= start
        self.range = bounds.take(at + len(one)) - start
        self._shift(np.flatnonzero(self.range <= _LOW))
        return choice

    def symbol(self, at: np.ndarray, shares: _Shares, _: object) -> np.ndarray:
        r = self.range.take(at) >> SYMBOL_BITS
        # Numbers below 2 ** 48 over numbers below 2 ** 27 never round up to a whole one.
        place = np.minimum((self.code.take(at) / r).astype(np.int64), shares.cum[-1] - 1)
        symbols = shares.find(place)
        start = shares.cum.take(symbols)
        self.code[at] -= r * start
        self.range[at] = r * (shares.cum.take(symbols + 1) - start)
        self._shift(at[self.range.take(at) <= _LOW])
        return symbols


class _Mixer:
    """Probability that a candidate is right, from three small contexts.

    A joint context is (16, 32, 32) values in one number. The mix of the three
    predictions is tabulated whenever counters and weights have been updated.
    A candidate is not asked for, and its probability is 0, where ``never`` says so.
    """

    SHAPE = (16, 32, 32)

    def __init__(self, never: tuple):
        self.hits = [np.full(n, 1, dtype=np.int64) for n in self.SHAPE]
        self.seen = [np.full(n, 2, dtype=np.int64) for n in self.SHAPE]
        self.weights = [26_000] * 3
        self.never = np.zeros(self.SHAPE, dtype=bool)
        for part in never:
            self.never[part] = True
        self._tabulate()

    def _parts(self) -> list[np.ndarray]:
        """The three predictions as logits, each along its own axis."""
        logits = [LOGIT[np.clip((h * 4096) // n, 1, 4094)] for h, n in zip(self.hits, self.seen)]
        return [x.reshape([-1 if i == k else 1 for i in range(3)]) for k, x in enumerate(logits)]

    def _tabulate(self) -> None:
        mixed = sum(x * w for x, w in zip(self._parts(), self.weights)) >> 16
        table = INVERSE[np.clip(mixed, -2048, 2047) + 2048]
        table[self.never] = 0
        self.table = table.ravel()

    def learn(self, n: np.ndarray, hits: np.ndarray) -> None:
        """How often a candidate was asked for in each joint context, and how often it was right."""
        n, hits = (np.where(self.never, 0, x.reshape(self.SHAPE)) for x in (n, hits))
        total = int(n.sum())
        if not total:
            return
        error = hits * _ONE - n * self.table.reshape(self.SHAPE)
        for k, part in enumerate(self._parts()):
            self.weights[k] += (int((part * error).sum()) // total) >> 14
            others = tuple(i for i in range(3) if i != k)
            self.seen[k] += n.sum(axis=others)
            self.hits[k] += hits.sum(axis=others)
            full = self.seen[k] > 1 << 16
            self.seen[k][full] >>= 1
            self.hits[k][full] >>= 1
        self._tabulate()


def _code(coder, rounds: int, lanes: int, vocabulary: int, ids: np.ndarray | None) -> np.ndarray:
    """Code (with ids, rounds by lanes) or decode (without) a block; returns the ids."""
    slots = 1 << SLOT_BITS
    # A slot is the last id seen, times 16, plus how sure it is; 0 is empty.
    slots2, slots1 = np.zeros(slots, dtype=np.int32), np.zeros(vocabulary, dtype=np.int32)
    counts = np.zeros(vocabulary, dtype=np.int64)
    total = 1 << SYMBOL_BITS
    shares = _Shares(np.full(vocabulary, total // vocabulary))
    size = np.zeros(vocabulary, dtype=np.uint8)
    # An empty slot names nobody; where both name the same, the second is not asked for.
    first, second = _Mixer((np.s_[0],)), _Mixer((np.s_[0], np.s_[:, 16:]))
    contexts = len(first.table)
    out = np.empty((rounds, lanes), dtype=np.int32) if ids is None else ids
    seen2, seen1 = np.empty((LEARN_ROUNDS, lanes), dtype=np.int64), np.empty((LEARN_ROUNDS, lanes), dtype=np.int64)
    before1 = before2 = np.zeros(lanes, dtype=np.int64)
    counted = held = 0
    for t in range(rounds):
        slot = ((before1 * 0x9E3779B1 + before2 * 0x85EBCA6B) >> 7) & (slots - 1)
        v2, v1 = slots2.take(slot), slots1.take(before1)
        c2, k2, c1, k1 = v2 >> 4, v2 & 15, v1 >> 4, v1 & 15
        both = ((c1 == c2) & (k2 > 0)).astype(np.int32) << 9
        joint2 = (k2 << 10) + (k1 << 5) + both + size.take(c2)
        joint1 = (k1 << 10) + (k2 << 5) + both + size.take(c1)
        one = first.table.take(joint2)
        two = one + (((_ONE - one) * second.table.take(joint1)) >> FLAG_BITS)
        if ids is None:
            choice = coder.choose(one, two, None)
            symbols = np.where(choice == 0, c2, c1).astype(np.int64)
        else:
            symbols = ids[t].astype(np.int64)
            # A candidate without a share of the range cannot be chosen.
            right2, right1 = (symbols == c2) & (one > 0), (symbols == c1) & (two > one)
            choice = coder.choose(one, two, 2 - (right2.astype(np.int64) << 1) - right1)
        rest = np.flatnonzero(choice == 2)
        if len(rest):
            symbols[rest] = coder.symbol(rest, shares, symbols.take(rest))
        if ids is None:
            out[t] = symbols
        seen2[held] = joint2 + (choice == 0) * contexts
        seen1[held] = joint1 + choice * contexts
        held += 1

        now = symbols.astype(np.int32)
        fresh = (now << 4) + 1
        for table, at, v, c, k in ((slots2, slot, v2, c2, k2), (slots1, before1, v1, c1, k1)):
            # Right: surer. Wrong: half as sure, or replaced. Of lanes that share a slot the last one counts, on both sides.
            table[at] = np.where(c == now, v + (k < CONFIDENCE), np.where(k > 2, v - k + (k >> 1), fresh))
        before2, before1 = before1, symbols
        step = t + 1
        if held == LEARN_ROUNDS or step in (1, 2, 4):
            missed, right = np.bincount(seen2[:held].ravel(), minlength=2 * contexts).reshape(2, -1)
            first.learn(missed + right, right)
            _, right, missed = np.bincount(seen1[:held].ravel(), minlength=3 * contexts).reshape(3, -1)
            second.learn(missed + right, right)
            held = 0
        if step % COUNT_ROUNDS == 0 or step in (1, 2, 4, 8, 16):
            counts += np.bincount(out[counted:step].ravel(), minlength=vocabulary)
            counted = step
            shares = _Shares(1 + counts * (total - vocabulary) // int(counts.sum()))
            size = np.minimum(np.frexp(counts.astype(np.float64))[1], 31).astype(np.uint8)
    return out


def encode_block(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, vocabulary: int) -> bytes:
    n = len(ids)
    lanes = max(1, min(MAX_LANES, n // LANE_TOKENS))
    rounds = -(-n // lanes)
    padded = np.zeros(lanes * rounds, dtype=np.int32)
    padded[:n] = ids
    coder = _Encoder(lanes)
    if n:
        _code(coder, rounds, lanes, vocabulary, np.ascontiguousarray(padded.reshape(lanes, rounds).T))
    per_lane, digits = coder.finish()
    known = np.array([x is not None for x in doc_ids], dtype=np.uint8)
    numbers = np.diff(np.array([x or 0 for x in doc_ids], dtype=np.int64), prepend=0)
    index = zlib.compress(known.tobytes() + numbers.astype("<i8").tobytes() + lengths.astype("<i8").tobytes() + per_lane.astype("<u4").tobytes())
    body = index + digits.tobytes()
    head = HEAD.pack(MAGIC, len(doc_ids), n, lanes, rounds, vocabulary, len(index), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body))
    return head + body


def decode_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths, and all ids; raises if either checksum is wrong."""
    magic, docs, n, lanes, rounds, vocabulary, index_bytes, ids_crc, body_crc = HEAD.unpack_from(block)
    body = block[HEAD.size :]
    if magic != MAGIC or zlib.crc32(body) != body_crc:
        raise ValueError("damaged token block")
    index = zlib.decompress(body[:index_bytes])
    known = np.frombuffer(index, np.uint8, docs)
    numbers = np.cumsum(np.frombuffer(index, "<i8", docs, docs))
    lengths = np.frombuffer(index, "<i8", docs, 9 * docs)
    per_lane = np.frombuffer(index, "<u4", lanes, 17 * docs)
    ids = np.empty(0, dtype=np.int32)
    if n:
        coder = _Decoder(per_lane, np.frombuffer(body, "<u2", offset=index_bytes))
        ids = _code(coder, rounds, lanes, vocabulary, None).T.reshape(-1)[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("token block decodes to other ids")
    return [int(x) if k else None for x, k in zip(numbers, known)], lengths, ids


class WordIds:
    """Ids of whole texts, remembered per run of characters: this tokenizer's ids never reach across a blank.

    Texts are cut at blanks and line feeds alone; any other white space stays
    in its word, for the tokenizer to judge. The tokenizer takes runs of letters
    as units, lower-cased. So words of plain Latin letters, digits and marks are
    cut into runs of letters and runs of others; words with any other character
    stay whole. Each distinct run of a batch is looked up once. A run not
    known goes to the tokenizer's model, spelt as the tokenizer spells bytes,
    if it is of letters, else through the whole tokenizer.

    What is known is held in two generations, so that frequent runs stay when
    the older one is dropped. A run has a number; the ids of all numbers lie one
    after the other. Number 0 is the end of a document.
    """

    # Letters whose lower case and normal form are one letter, and marks that stand for themselves.
    LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß"
    MARKS = "0123456789!\"#$%&()*+,-./:;=?@[\\]^_`{|}~«»–—…“”„"
    BLANK, MARK, LETTER, ODD = range(4)

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["merges"]]
        # The same model without a cache of its own, which costs more than it saves: a run is asked for once.
        self.model = BPE(spec["vocab"], merges, cache_capacity=0, end_of_word_suffix=spec.get("end_of_word_suffix") or "")
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {ord(c): spell.pre_tokenize_str(c)[0][0] for c in self.LETTERS}
        self.kinds = np.full(1 << 16, self.ODD, dtype=np.uint8)
        self.lower = np.arange(1 << 16, dtype=np.uint16)
        # Bytes in UTF-8 of a 16-bit unit; half of a pair is two of four.
        self.sizes = (1 + (self.lower > 0x7F) + (self.lower > 0x7FF)).astype(np.uint8)
        self.sizes[0xD800:0xE000] = 2
        for kind, chars in ((self.BLANK, " \n"), (self.MARK, self.MARKS), (self.LETTER, self.LETTERS)):
            for c in chars:
                for x in {c, c.upper()}:
                    if len(x) == 1:
                        self.kinds[ord(x)], self.lower[ord(x)] = kind, ord(c)
        for low, mark in (("az", ","), (self.LETTERS, "12.")):
            whole = self._through_all(low.upper() + mark + low if low == "az" else low + mark + low)
            if whole != self._letters(low) + self._through_all(mark) + self._letters(low):
                raise ValueError("this tokenizer does not take runs of letters as units")
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.ids, self.ends = np.array([end_id], dtype=np.int32), np.array([0, 1], dtype=np.int64)

    @classmethod
    def shared(cls, path: str, end_id: int) -> WordIds:
        """One for all tasks of a Python worker: what it has learned stays true."""
        if (path, end_id) not in _WORD_IDS:
            _WORD_IDS[path, end_id] = cls(path, end_id)
        return _WORD_IDS[path, end_id]

    def _through_all(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _letters(self, run: str) -> list[int]:
        return [x.id for x in self.model.tokenize(run if run.isascii() else run.translate(self.spelling))]

    def _forget(self) -> None:
        """Drop the older generation and the ids that only it had."""
        kept = np.fromiter(self.known.values(), np.int64, len(self.known))
        self.older, self.known = dict(zip(self.known, range(1, len(kept) + 1))), {}
        kept = np.concatenate([[0], kept])
        self.ids, n = self._ids_of(kept)
        self.ends = np.concatenate([[0], np.cumsum(n)])

    def _ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these numbers in turn, and how many each has."""
        start = self.ends.take(numbers)
        n = self.ends.take(numbers + 1) - start
        upto = np.cumsum(n)
        start -= upto - n
        at = np.repeat(start, n)
        at += np.arange(len(at))
        return self.ids.take(at), n

    def _look_up(self, runs: list[str], letters: np.ndarray) -> np.ndarray:
        """The numbers of distinct runs."""
        if len(self.known) > CACHE_RUNS:
            self._forget()
        numbers = np.fromiter(map(self.known.get, runs, repeat(-1)), np.int64, len(runs))
        asked = np.flatnonzero(numbers < 0)
        names = [runs[k] for k in asked.tolist()]
        again = np.fromiter(map(self.older.get, names, repeat(-1)), np.int64, len(names))
        fresh = np.flatnonzero(again < 0)
        ids: list[int] = []
        ends: list[int] = []
        for k, whole in zip(fresh.tolist(), letters[asked[fresh]].tolist()):
            ids += self._letters(names[k]) if whole else self._through_all(names[k])
            ends.append(len(ids))
        again[fresh] = np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(fresh))
        self.ends = np.concatenate([self.ends, np.array(ends, dtype=np.int64) + len(self.ids)])
        self.ids = np.concatenate([self.ids, np.array(ids, dtype=np.int32)])
        self.known.update(zip(names, again.tolist()))
        numbers[asked] = again
        return numbers

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids with an end id after each text, and how many each text has."""
        # A line feed stands behind each text; there the end id goes.
        coded = [(text or "").encode("utf-16-le") for text in texts] + [b""]
        stops = np.cumsum([(len(x) >> 1) + 1 for x in coded[:-1]]) - 1
        chars = np.frombuffer("\n".encode("utf-16-le").join(coded), np.uint16)
        kinds, low = self.kinds.take(chars), self.lower.take(chars)
        blank = kinds == self.BLANK
        if len(odd := np.flatnonzero(kinds == self.ODD)):
            word = np.cumsum(blank, dtype=np.int32)
            has_odd = np.zeros(int(word[-1]) + 1, dtype=bool)
            has_odd[word[odd]] = True
            whole = np.flatnonzero(has_odd[word] & ~blank)
            kinds[whole] = self.ODD
            low[whole] = chars[whole]
        # Runs without blanks are one after the other: an Arrow column over the bytes of the text itself.
        starts_run = kinds[1:] != kinds[:-1]
        starts_run = np.concatenate([[True], starts_run]) & ~blank
        first = np.flatnonzero(starts_run)
        sizes = self.sizes.take(low)
        sizes[blank] = 0
        upto = np.cumsum(sizes, dtype=np.int32 if len(low) < 1 << 29 else np.int64)
        offsets = np.append(upto[first] - sizes[first], upto[-1]).astype(np.int64)
        data = low[~blank].tobytes().decode("utf-16-le").encode()
        column = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        runs = column.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = column.indices.to_numpy()
        letters = np.empty(len(runs), dtype=bool)
        letters[which] = kinds[first] == self.LETTER
        numbers = self._look_up(runs, letters)
        before = np.searchsorted(first, stops)
        ids, n = self._ids_of(np.insert(numbers.take(which), before, 0))
        return ids, np.diff(np.cumsum(n)[before + np.arange(len(before))], prepend=0)


def _stretches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, cut where texts reach ``TEXT_BYTES``; a longer text is a stretch of its own."""
    return stretches(batch, "text", TEXT_BYTES)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode whole texts and write them as blocks, in ascending order of id."""
    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    # Equal ids, and equal rows, spread too: by a hash of the text and the place in the scan.
    order = ["id", F.xxhash64("text"), F.monotonically_increasing_id()]
    placed = own.select("id", "text", order[1].alias("h"), order[2].alias("place"))
    sorted_docs = placed.repartitionByRange("id", "h", "place").sortWithinPartitions("id", "h", "place").select("id", "text")

    def run(batches):
        words = WordIds.shared(tokenizer_path, end_id)
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        size = number = start = 0

        def block() -> pa.RecordBatch:
            nonlocal held, size, number, start
            doc_ids = [i for ids, _, _ in held for i in ids]
            lengths = np.concatenate([x for _, x, _ in held])
            ids = np.concatenate([x for _, _, x in held])
            held = []
            data = encode_block(doc_ids, lengths, ids, words.vocabulary)
            made = pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in ((part, pa.int64()), (number, pa.int64()), (start, pa.int64()), (len(doc_ids), pa.int64()), (len(ids), pa.int64()), (data, pa.binary()))],
                names=["part", "block", "start_in_part", "n_docs", "n_tokens", "data"],
            )
            held, size, number, start = [], 0, number + 1, start + len(ids)
            return made

        for batch in batches:
            for piece in _stretches(batch):
                ids, lengths = words.encode(piece.column("text").to_pylist())
                held.append((piece.column("id").to_pylist(), lengths, ids))
                size += len(ids)
                if size >= BLOCK_TOKENS:
                    yield block()
        if held:
            yield block()

    schema = "part long, block long, start_in_part long, n_docs long, n_tokens long, data binary"
    write_table(sorted_docs.mapInArrow(freeing(run), schema), path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start (ids before it), n_tokens, ids_crc32, and its ids if asked for."""
    blocks = spark.read.parquet(path)
    # One row per task that wrote: what the parts before hold.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))

    def run(batches):
        for batch in batches:
            for part, start, data in zip(batch.column("part").to_pylist(), batch.column("start_in_part").to_pylist(), batch.column("data")):
                doc_ids, lengths, ids = decode_block(data.as_py())
                raw, ends = ids.astype("<u4"), np.cumsum(lengths)
                starts = ends - lengths
                crcs = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                arrays = [pa.array([part] * len(doc_ids), pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(starts + start), pa.array(lengths), pa.array(crcs, pa.int64())]
                names = ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([ids[a:b].astype(np.int64) for a, b in zip(starts.tolist(), ends.tolist())], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "part long, doc_id long, start_in_part long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    docs = blocks.select("part", "start_in_part", "data").mapInArrow(freeing(run), schema)
    return docs.join(F.broadcast(before), "part").select(
        "doc_id", (F.coalesce("before", F.lit(0)) + F.col("start_in_part")).alias("start"), *docs.columns[3:]
    )
