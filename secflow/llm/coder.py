"""Adaptive context-mixing range coder for token ids, in independent, checksummed blocks.

A block starts from an empty model. Its ids are renamed to numbers in order of first appearance; the
list of ids stands in front. Every number is predicted three ways: by the number that last followed
the two before it (order 2), by the one that last followed the one before it (order 1), and by the
counts of the block so far (order 0). The first two get a share of the range that follows their
success at the same confidence, order 0 gets the rest; a number that order 0 has not counted yet is
coded evenly among the new ones. Counts enter the order-0 table every ``EPOCH`` steps.

Blocks do not depend on each other, so a worker steps through many at once, one numpy lane a block.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096  # ids per block
EPOCH = 256  # steps between two renewals of the order-0 table
MAGIC = b"SFT1"

_HASH = 4096  # places of the order-2 table, a power of two
_TABLED = 1 << 20  # ids below are renamed through a table of all of them
_SHARE_BITS = 16
_LOW_BITS = 48
_U16, _U32 = np.uint64(16), np.uint64(32)
_SHARE, _ALL = np.uint32(_SHARE_BITS), np.uint32(1 << _SHARE_BITS)
_LOW_MAX, _WIDTH_MAX = np.uint64((1 << _LOW_BITS) - 1), np.uint64((1 << 32) - 1)
_HEAD = "<4sBxHIIIII"  # magic, bytes per id, epoch, ids, steps, different ids, body crc32, ids crc32


class CorruptBlock(ValueError):
    """A block that fails its checksum or format."""


class _Writer:
    """Range coder of each lane; a carry runs back into the words already written."""

    def __init__(self, lanes: int, steps: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, (1 << _LOW_BITS) - 1, np.uint64)
        self.space = 3 * steps + 8
        self.words = np.zeros(lanes * self.space, np.uint16)
        self.at = np.arange(lanes) * self.space

    def _emit(self, lanes: np.ndarray, low: np.ndarray) -> None:
        at = self.at[lanes]
        self.words[at] = low >> _U32
        self.at[lanes] = at + 1

    def put(self, lanes: np.ndarray | None, start, unit_bits: int, freq, total=None) -> None:
        """Code intervals of some lanes, or of all; the total is a power of two or given by lane."""
        wide, low = (self.range, self.low) if lanes is None else (self.range[lanes], self.low[lanes])
        unit = wide >> np.uint64(unit_bits) if total is None else wide // total
        low = low + start * unit
        width = freq * unit
        over = (low > _LOW_MAX).nonzero()[0]
        if over.size:
            low &= _LOW_MAX
            carry, back = over if lanes is None else lanes[over], 1
            while carry.size:
                place = self.at[carry] - back
                self.words[place] += np.uint16(1)
                carry, back = carry[self.words[place] == 0], back + 1
        small = (width <= _WIDTH_MAX).nonzero()[0]
        if small.size:
            moved = low[small]
            self._emit(small if lanes is None else lanes[small], moved)
            low[small] = (moved << _U16) & _LOW_MAX
            width[small] <<= _U16
        if lanes is None:
            self.low, self.range = low, width
        else:
            self.low[lanes], self.range[lanes] = low, width

    def bodies(self) -> list[bytes]:
        every = np.arange(len(self.low))
        for _ in range(3):
            self._emit(every, self.low)
            self.low = (self.low << _U16) & _LOW_MAX
        starts = every * self.space
        return [self.words[a:b].astype("<u2").tobytes() for a, b in zip(starts, self.at, strict=True)]


class _Reader:
    def __init__(self, bodies: list[bytes]):
        space = max(len(b) for b in bodies) // 2 + 4
        words = np.zeros((len(bodies), space), np.uint16)
        for k, body in enumerate(bodies):
            words[k, :len(body) // 2] = np.frombuffer(body, "<u2")
        first = words[:, :3].astype(np.uint64)
        self.code = (first[:, 0] << _U32) | (first[:, 1] << _U16) | first[:, 2]
        self.words = words.ravel()
        self.range = np.full(len(bodies), (1 << _LOW_BITS) - 1, np.uint64)
        self.at = np.arange(len(bodies)) * space + 3

    def look(self, lanes: np.ndarray | None, unit_bits: int, total=None) -> tuple[np.ndarray, np.ndarray]:
        """The value of each lane below its total, and the unit to give to ``take``."""
        wide, code = (self.range, self.code) if lanes is None else (self.range[lanes], self.code[lanes])
        unit = wide >> np.uint64(unit_bits) if total is None else wide // total
        top = np.uint64((1 << unit_bits) - 1) if total is None else total - np.uint64(1)
        return np.minimum(code // unit, top).astype(np.int64), unit

    def take(self, lanes: np.ndarray | None, unit: np.ndarray, start, freq) -> None:
        code = (self.code if lanes is None else self.code[lanes]) - start * unit
        width = freq * unit
        small = (width <= _WIDTH_MAX).nonzero()[0]
        if small.size:
            who = small if lanes is None else lanes[small]
            at = self.at[who]
            # a damaged body may ask for more than there is
            code[small] = (code[small] << _U16) | self.words[np.minimum(at, len(self.words) - 1)]
            width[small] <<= _U16
            self.at[who] = at + 1
        if lanes is None:
            self.code, self.range = code, width
        else:
            self.code[lanes], self.range[lanes] = code, width


class _Model:
    """What all lanes have learnt. Numbers are stored plus one, above two bits of confidence."""

    def __init__(self, lanes: int, steps: int):
        self.every = np.arange(lanes)
        self.after_one = np.zeros(lanes * (steps + 1), np.uint16)
        self.after_two = np.zeros(lanes * _HASH, np.uint16)
        start = np.array([13000, 26000, 39000, 52000], np.int32)
        self.share_one, self.share_two = np.tile(start, lanes), np.tile(start, lanes)
        self.steps = steps
        self.counts = np.zeros(lanes * steps, np.int32 if steps >> 16 else np.uint16)
        self.row = self.every * steps
        self.row_one, self.row_two, self.row_share = self.every * (steps + 1), self.every * _HASH, self.every * 4
        self.before = np.full(lanes, steps, np.int64)  # the number before; ``steps`` stands for none
        self.before_two = np.full(lanes, steps, np.int64)
        self.known = np.zeros(lanes, np.int64)  # different numbers so far
        self.table = np.zeros(lanes + 1, np.int32)
        self.columns = 1
        self.tabled = np.zeros(lanes, np.int64)  # numbers in the order-0 table
        self.total = 0  # counts in the table, as many in every lane
        self.fresh = np.zeros(lanes, np.int64)  # steps of this epoch that the table could not serve
        self.escape = np.ones(lanes, np.int64)

    def renew(self, step: int) -> None:
        """Rebuild the order-0 table; what escaped in the epoch sets the share of later escapes."""
        lanes, width = len(self.every), int(self.known.max(initial=0))
        self.columns, self.total = width + 1, step
        self.table = np.zeros(lanes * self.columns + 1, np.int32)  # one more: the last place has a next one
        np.cumsum(
            self.counts.reshape(-1, self.steps)[:, :width], axis=1, out=self.table[:-1].reshape(lanes, -1)[:, 1:])
        self.tabled = self.known.copy()
        if step:
            served = np.maximum(EPOCH - self.fresh, 1)
            self.escape = np.clip(self.total * self.fresh // served, 1, 50_000)
        self.fresh[:] = 0

    def slots(self) -> np.ndarray:
        """The number that each value below the total stands for, lane by lane."""
        width = self.columns - 1
        numbers = np.tile(np.arange(width, dtype=np.int32 if width >> 16 else np.uint16), len(self.every))
        return np.repeat(numbers, self.counts.reshape(-1, self.steps)[:, :width].ravel())

    def predict(self) -> None:
        hashed = (self.before * 40503 + self.before_two * 30011) & (_HASH - 1)
        self.place_two = self.row_two + hashed
        self.place_one = self.row_one + self.before
        self.state_two, self.state_one = self.after_two[self.place_two], self.after_one[self.place_one]
        self.two, self.sure_two = self.state_two >> 2, self.state_two & 3
        self.one, self.sure_one = self.state_one >> 2, self.state_one & 3
        self.bin_two, self.bin_one = self.row_share + self.sure_two, self.row_share + self.sure_one
        self.has_two = self.two > 0
        self.has_one = (self.one > 0) & (self.one != self.two)
        self.held_two, self.held_one = self.share_two[self.bin_two], self.share_one[self.bin_one]
        self.freq_two = self.held_two.view(np.uint32) * self.has_two
        rest = _ALL - self.freq_two
        self.freq_one = ((rest * self.held_one.view(np.uint32)) >> _SHARE) * self.has_one

    def learn(self, number: np.ndarray, hit_two: np.ndarray, hit_one: np.ndarray) -> None:
        for shares, bins, old, asked, hit in (
                (self.share_two, self.bin_two, self.held_two, self.has_two, hit_two),
                (self.share_one, self.bin_one, self.held_one, self.has_one & ~hit_two, hit_one)):
            moved = old + (((hit.astype(np.int32) << _SHARE_BITS) - old) >> 5)
            shares[bins] = np.where(asked, np.minimum(np.maximum(moved, 1024), 61_440), old)
        name = (number + 1).astype(np.uint16)
        first = name << 2
        for held, place, state, seen, sure in (
                (self.after_two, self.place_two, self.state_two, self.two, self.sure_two),
                (self.after_one, self.place_one, self.state_one, self.one, self.sure_one)):
            held[place] = np.where(seen == name, state + (sure < 3), np.where(sure == 0, first, state - 1))
        self.counts[self.row + number] += 1
        np.maximum(self.known, name, out=self.known)
        self.before_two, self.before = self.before, number


def _u(x) -> np.ndarray:
    return np.asarray(x).astype(np.uint64)


def _number(ids: np.ndarray, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in order of first appearance, and the id of each number; ``scratch`` has a place for each id."""
    places = np.arange(len(ids), dtype=np.int32)
    scratch[ids[::-1]] = places[::-1]  # the first appearance is written last
    names = ids[scratch[ids] == places]
    scratch[names] = places[:len(names)]
    return scratch[ids], names


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """Blocks of up to ``block`` ids. Of several, the last is filled up with its last id while coding."""
    ids = np.ascontiguousarray(ids, "<u4")
    if not len(ids):
        return []
    parts = [ids[k:k + block] for k in range(0, len(ids), block)]
    steps = len(parts[0])
    top = int(ids.max())
    # ids too large for a table of them are told apart by their order
    values, small = (None, ids) if top < _TABLED else np.unique(ids, return_inverse=True)
    scratch = np.empty((top if values is None else len(values)) + 1, np.int32)
    numbers, names = zip(*[_number(small[k:k + block], scratch) for k in range(0, len(ids), block)], strict=True)
    if values is not None:
        names = [values[n] for n in names]
    lanes = len(parts)
    grid = np.empty((steps, lanes), np.int32)
    for k, row in enumerate(numbers):
        grid[:len(row), k] = row
        grid[len(row):, k] = row[-1]
    del numbers
    model, out = _Model(lanes, steps), _Writer(lanes, steps)
    for step in range(steps):
        if step % EPOCH == 0:
            model.renew(step)
        number = grid[step].astype(np.int64)
        model.predict()
        hit_two = model.has_two & (model.two == number + 1)
        hit_one = model.has_one & (model.one == number + 1)
        missed = ~(hit_two | hit_one)
        both = model.freq_two + model.freq_one
        start = np.where(hit_two, 0, np.where(hit_one, model.freq_two, both))
        freq = np.where(hit_two, model.freq_two, np.where(hit_one, model.freq_one, _ALL - both))
        out.put(None, _u(start), _SHARE_BITS, _u(freq))
        rest = missed.nonzero()[0]
        if rest.size:
            n = number[rest]
            fresh = n >= model.tabled[rest]
            total = model.total
            place = rest * model.columns + n * ~fresh
            base = model.table[place]
            width = model.table[place + 1] - base
            escape = model.escape[rest]
            out.put(rest, _u(np.where(fresh, total, base)), 0, _u(np.where(fresh, escape, width)), _u(total + escape))
            new = rest[fresh]
            if new.size:
                model.fresh[new] += 1
                out.put(new, _u(n[fresh] - model.tabled[new]), 0, np.uint64(1), _u(model.known[new] - model.tabled[new] + 1))
        model.learn(number, hit_two, hit_one)
    blocks = []
    for part, name, body in zip(parts, names, out.bodies(), strict=True):
        width = 2 if name.max() < 1 << 16 else 4
        rest = name.astype(f"<u{width}").tobytes() + body
        blocks.append(struct.pack(
            _HEAD, 
            MAGIC, width, EPOCH, len(part), steps, len(name), zlib.crc32(rest), zlib.crc32(part.tobytes())) + rest)
    return blocks


def decode_blocks(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of each block, from blocks of any number of steps. Raises CorruptBlock."""
    heads, names, bodies = [], [], []
    for block in blocks:
        if len(block) < struct.calcsize(_HEAD):
            raise CorruptBlock("too short")
        head = struct.unpack_from(_HEAD, block)
        rest = block[struct.calcsize(_HEAD):]
        if head[0] != MAGIC or head[2] != EPOCH or zlib.crc32(rest) != head[6]:
            raise CorruptBlock("magic, epoch or checksum differs")
        heads.append(head)
        names.append(np.frombuffer(rest, f"<u{head[1]}", head[5]).astype("<u4"))
        bodies.append(rest[head[1] * head[5]:])
    out: list = [None] * len(blocks)
    for steps in sorted({h[4] for h in heads}):
        group = [k for k, h in enumerate(heads) if h[4] == steps]
        grid = _decode_lanes([bodies[k] for k in group], steps)
        for lane, k in enumerate(group):
            numbers = grid[:heads[k][3], lane]
            if numbers.max() >= len(names[k]):
                raise CorruptBlock("unknown number")
            out[k] = names[k][numbers]
            if zlib.crc32(out[k].tobytes()) != heads[k][7]:
                raise CorruptBlock("ids differ from their checksum")
    return out


def _decode_lanes(bodies: list[bytes], steps: int) -> np.ndarray:
    lanes = len(bodies)
    model, source = _Model(lanes, steps), _Reader(bodies)
    grid = np.empty((steps, lanes), np.int32)
    for step in range(steps):
        if step % EPOCH == 0:
            model.renew(step)
            slots = model.slots()
        model.predict()
        value, unit = source.look(None, _SHARE_BITS)
        both = model.freq_two + model.freq_one
        hit_two = value < model.freq_two
        hit_one = ~hit_two & (value < both)
        start = np.where(hit_two, 0, np.where(hit_one, model.freq_two, both))
        freq = np.where(hit_two, model.freq_two, np.where(hit_one, model.freq_one, _ALL - both))
        source.take(None, unit, _u(start), _u(freq))
        number = np.where(hit_two, model.two, model.one).astype(np.int64) - 1
        rest = (~(hit_two | hit_one)).nonzero()[0]
        if rest.size:
            total, escape = model.total, model.escape[rest]
            value, unit = source.look(rest, 0, _u(total + escape))
            fresh = value >= total
            col = np.zeros(len(rest), np.int64)
            kept = (~fresh).nonzero()[0]
            col[kept] = slots[rest[kept] * total + value[kept]]
            place = rest * model.columns + col
            base = model.table[place]
            width = model.table[place + 1] - base
            source.take(rest, unit, _u(np.where(fresh, total, base)), _u(np.where(fresh, escape, width)))
            new = rest[fresh]
            if new.size:
                model.fresh[new] += 1
                more, unit = source.look(new, 0, _u(model.known[new] - model.tabled[new] + 1))
                source.take(new, unit, _u(more), np.uint64(1))
                col[fresh] = model.tabled[new] + more
            number[rest] = col
        grid[step] = number
        model.learn(number, hit_two, hit_one)
    return grid
