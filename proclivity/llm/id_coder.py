"""Range coding of token ids, predicted by contexts of order 0 to 2 and mixed adaptively.

An id's bits are cut into three digits. It is coded as a first symbol and, where no context predicted it, its other
two digits. The first symbol says "as after these two ids last time", "as after this id last time", or the first digit
of another id. Its distribution adapts for each pair of confidences of the two predictions, so it holds the weights
with which the three orders are mixed; the digits' distributions adapt too, given the digit before (order 0). A block
starts from fixed distributions and an empty memory, so each can be decoded alone.

Arrays hold many blocks side by side, and each step codes one id of every block. Blocks do not influence each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np

#: Bits of the probabilities, and how fast distributions follow (a share of 2**-RATE each time).
SCALE, RATE = 15, 5
#: Least probability that a distribution moves to, in units of 2**-SCALE; more than 2**RATE, so none vanishes.
LEAST = 32
#: The coder's interval has 48 bits; it gives out 16 at a time when the width falls below this.
NARROW = 1 << 32
#: Remembered contexts per block, as powers of two.
MEMORY_ONE, MEMORY_TWO = 10, 11
#: Confidence of a remembered id: right so many times in a row, at most.
SURE = 3


def digits_for(vocabulary: int) -> tuple[int, int, int]:
    """Bits of the three digits that every id below ``vocabulary`` fits into."""
    bits = max(9, max(vocabulary - 1, 0).bit_length())
    return bits // 3, bits // 3, bits - 2 * (bits // 3)


#: Ids below 65,536.
DIGITS = digits_for(1 << 16)


def _targets(width: int) -> np.ndarray:
    """For each symbol, the cumulative distribution that is almost sure of it."""
    i = np.arange(width)
    return np.where(i <= i[:, None], i * LEAST, (1 << SCALE) - (width - i) * LEAST).astype(np.int16)


class _Adaptive:
    """Cumulative distributions, ``contexts`` of them for each of ``lanes`` blocks, all uniform at first."""

    def __init__(self, lanes: int, contexts: int, width: int):
        self.width, self.contexts = width, contexts
        start = (np.arange(width) * ((1 << SCALE) // width)).astype(np.int16)
        table = np.empty((lanes * contexts, width), np.int16)
        table[:] = start
        # Whole rows are copied as one item each.
        self.kind = f"V{2 * width}"
        self.table = table.view(self.kind).reshape(-1)
        self.targets = _targets(width)
        self.base = np.arange(lanes) * contexts
        self.edge = np.arange(lanes) * width
        self.rows, self.step = np.empty((lanes, width), np.int16), np.empty((lanes, width), np.int16)

    def look(self, context: np.ndarray) -> None:
        n = len(context)
        self.at = self.base[:n] + context
        self.now = self.rows[:n]
        self.table.take(self.at, out=self.now.view(self.kind).reshape(-1), mode="clip")

    def find(self, slot: np.ndarray) -> np.ndarray:
        """The symbol whose share holds ``slot``: entries not above it are counted, eight in a word."""
        words = (self.now <= slot.astype(np.int16)[:, None]).view(np.uint64)
        total = words[:, 0] + words[:, 1]
        for k in range(2, words.shape[1]):
            total += words[:, k]
        return ((total * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int64) - 1

    def share(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower edge and width of the symbols' shares."""
        flat, at = self.now.reshape(-1), self.edge[: len(symbol)] + symbol
        low = flat.take(at).astype(np.int64)
        high = flat.take(at + 1, mode="clip").astype(np.int64)
        high[symbol == self.width - 1] = 1 << SCALE
        return low, high - low

    def learn(self, symbol: np.ndarray) -> None:
        step = self.targets.take(symbol, axis=0, out=self.step[: len(symbol)], mode="clip")
        step -= self.now
        step >>= RATE
        step += self.now
        np.put(self.table, self.at, step.view(self.kind).reshape(-1), mode="clip")


class _Predictor:
    """What each block remembers of ids after one and after two ids, and the distributions of symbols."""

    def __init__(self, lanes: int, digits: tuple[int, int, int]):
        a, b, c = digits
        # Symbols beyond the digits: the two predictions. Rows are as wide as eight divides.
        self.by_one, self.by_two = 1 << a, (1 << a) + 1
        self.first = _Adaptive(lanes, (SURE + 1) ** 2, (1 << a) + 8)
        # One more context stands for blocks whose id was predicted: there the digit is always 0.
        self.rest = [_Adaptive(lanes, (1 << a) + 1, 1 << b), _Adaptive(lanes, (1 << b) + 1, 1 << c)]
        self.after_one = np.zeros(lanes << MEMORY_ONE, np.int32)
        self.after_two = np.zeros(lanes << MEMORY_TWO, np.int32)
        self.lane = np.arange(lanes)
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)

    def predict(self, n: int) -> np.ndarray:
        """Looks up both predictions of the first ``n`` blocks; returns the context of the first symbol."""
        self.last, self.before, lane = self.last[:n], self.before[:n], self.lane[:n]
        one = (self.last * 0x9E3779B1 >> 7) & ((1 << MEMORY_ONE) - 1)
        two = ((self.last * 0x9E3779B1 + self.before * 0x85EBCA6B) >> 7) & ((1 << MEMORY_TWO) - 1)
        self.at_one, self.at_two = (lane << MEMORY_ONE) + one, (lane << MEMORY_TWO) + two
        self.one, self.two = self.after_one.take(self.at_one, mode="clip"), self.after_two.take(self.at_two, mode="clip")
        self.id_one, self.id_two = self.one >> 2, self.two >> 2
        return (self.two & SURE) * (SURE + 1) + (self.one & SURE)

    def remember(self, ids: np.ndarray) -> None:
        for memory, at, old, known in (
            (self.after_one, self.at_one, self.one, self.id_one),
            (self.after_two, self.at_two, self.two, self.id_two),
        ):
            surer = old + ((old & SURE) < SURE)
            memory[at] = np.where(known == ids, surer, ids << 2)
        self.before, self.last = self.last, ids.astype(np.int64)


def _longest_first(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks by falling length, and how many of them have an id at each step."""
    order = np.argsort(-lengths, kind="stable")
    steps = int(lengths.max(initial=0))
    return order, len(lengths) - np.searchsorted(np.sort(lengths), np.arange(steps), side="right")


def encode_blocks(blocks: Sequence[np.ndarray], digits: tuple[int, int, int] = DIGITS) -> list[bytes]:
    """One independent code per block of ids that fit ``digits``; an empty block has an empty code."""
    lengths = np.array([len(b) for b in blocks], np.int64)
    if not lengths.sum():
        return [b"" for _ in blocks]
    order, active = _longest_first(lengths)
    lanes = len(blocks)
    ids = np.zeros((len(active), lanes), np.int32)
    for lane, b in enumerate(order):
        ids[: lengths[b], lane] = blocks[b]
    if ids.min() < 0 or ids.max() >> sum(digits):
        raise ValueError(f"ids must lie in 0 to {(1 << sum(digits)) - 1}")
    _, b, c = digits
    model = _Predictor(lanes, digits)
    low, width = np.zeros(lanes, np.int64), np.full(lanes, 1 << 48, np.int64)
    out, filled = np.zeros((lanes, len(active) + 64), np.int32), np.zeros(lanes, np.int64)

    def give(which: np.ndarray) -> None:
        out[which, filled[which]] = low[which] >> 32
        low[which] = (low[which] & (NARROW - 1)) << 16
        filled[which] += 1

    def code(table: _Adaptive, context: np.ndarray, symbol: np.ndarray) -> None:
        n = len(symbol)
        table.look(context)
        edge, share = table.share(symbol)
        table.learn(symbol)
        unit = width[:n] >> SCALE
        edge *= unit
        low[:n] += edge
        share *= unit
        width[:n] = share
        narrow = np.flatnonzero(share < NARROW)
        give(narrow)
        width[narrow] <<= 16

    for step, n in enumerate(active):
        if step % 16 == 0 and out.shape[1] < filled.max() + 64:
            out = np.concatenate([out, np.zeros_like(out)], axis=1)
        now = ids[step, :n]
        context = model.predict(n)
        by_two, by_one = now == model.id_two, now == model.id_one
        known = by_two | by_one
        symbol = np.where(by_two, model.by_two, np.where(by_one, model.by_one, now >> (b + c)))
        code(model.first, context, symbol)
        rest = np.where(known, 0, now)
        before = np.where(known, model.by_one, rest >> (b + c))
        digit = rest >> c & ((1 << b) - 1)
        code(model.rest[0], before, digit)
        code(model.rest[1], np.where(known, 1 << b, digit), rest & ((1 << c) - 1))
        model.remember(now)
    everyone = np.arange(lanes)
    for _ in range(3):
        if out.shape[1] <= filled.max():
            out = np.concatenate([out, np.zeros_like(out)], axis=1)
        give(everyone)
    for k in range(int(filled.max()) - 1, 0, -1):
        out[:, k - 1] += out[:, k] >> 16
        out[:, k] &= 0xFFFF
    codes: list[bytes] = [b""] * lanes
    for lane, b in enumerate(order):
        if lengths[b]:
            codes[b] = out[lane, : filled[lane]].astype("<u2").tobytes()
    return codes


def decode_blocks(codes: Sequence[bytes], lengths: Sequence[int], digits: tuple[int, int, int] = DIGITS) -> list[np.ndarray]:
    """The ids of each block, given how many it has."""
    lengths = np.asarray(lengths, np.int64)
    if not lengths.sum():
        return [np.zeros(0, np.int32) for _ in codes]
    order, active = _longest_first(lengths)
    lanes, (_, b, c) = len(codes), digits
    # Reading past the end of a damaged code gives zeros; the checksum then tells.
    words = np.concatenate([np.frombuffer(codes[b] + b"\0" * 8 if lengths[b] else b"\0" * 8, "<u2") for b in order]).astype(np.int64)
    sizes = np.array([len(codes[b]) // 2 + 4 if lengths[b] else 4 for b in order])
    place = np.cumsum(sizes) - sizes
    last = len(words) - 1
    value = words[place] << 32 | words[place + 1] << 16 | words[place + 2]
    place += 3
    width = np.full(lanes, 1 << 48, np.int64)
    model = _Predictor(lanes, digits)
    ids = np.zeros((len(active), lanes), np.int32)

    def symbol_of(table: _Adaptive, context: np.ndarray) -> np.ndarray:
        n = len(context)
        table.look(context)
        unit = width[:n] >> SCALE
        # Both fit a double exactly, and the quotient is far enough from the next integer to be cut off right.
        slot = np.minimum(value[:n] / unit, (1 << SCALE) - 1)
        symbol = table.find(slot)
        edge, share = table.share(symbol)
        table.learn(symbol)
        edge *= unit
        value[:n] -= edge
        share *= unit
        width[:n] = share
        narrow = np.flatnonzero(share < NARROW)
        value[narrow] = value[narrow] << 16 | words[np.minimum(place[narrow], last)]
        width[narrow] <<= 16
        place[narrow] += 1
        return symbol

    for step, n in enumerate(active):
        context = model.predict(n)
        symbol = symbol_of(model.first, context)
        known = symbol >= model.by_one
        digit = symbol_of(model.rest[0], np.minimum(symbol, model.by_one))
        final = symbol_of(model.rest[1], np.where(known, 1 << b, digit))
        now = (symbol << b | digit) << c | final
        now = np.where(symbol == model.by_two, model.id_two, np.where(known, model.id_one, now)).astype(np.int32)
        ids[step, :n] = now
        model.remember(now)
    found: list[np.ndarray] = [np.zeros(0, np.int32)] * lanes
    for lane, b in enumerate(order):
        found[b] = np.ascontiguousarray(ids[: lengths[b], lane])
    return found


def checksum(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
