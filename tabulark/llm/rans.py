"""Interleaved static range asymmetric numeral system over token ids.

A shared table gives every id a whole frequency; the frequencies sum to 2**bits.
Token t of a block belongs to lane t % LANES, each lane is one 64-bit state in
[2**31, 2**63), and all lanes of all blocks at hand advance together as arrays.
A lane that would overflow passes its low 32 bits on to the block's words; the
decoder takes them back in the same order, by step, then lane.  Every CHECK steps
the lanes' states and the place in the words are kept as a checkpoint, and a
decoder may start at any of them, so the stretches of a block decode in parallel.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

LANES = 32
CHECK = 512  # steps between checkpoints
LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_LOW_WORD = np.uint64(0xFFFFFFFF)


class Damaged(ValueError):
    """A block whose checksum does not hold."""


def frequencies(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Whole frequencies of at least 1 that sum to 2**bits, near the proportions of
    ``counts`` (all positive)."""
    bits = max(12, int(len(counts) - 1).bit_length() + 4)
    total, whole = 1 << bits, int(counts.sum())
    share = np.array([int(c) * total // whole for c in counts], dtype=np.int64)
    share = np.maximum(share, 1)
    spare = total - int(share.sum())
    by_size = np.argsort(-share, kind="stable")
    if spare > 0:
        share[by_size[0]] += spare
    for k in by_size:  # what the ones raised to 1 take comes from the largest
        if spare >= 0:
            break
        part = min(-spare, int(share[k]) - max(1, int(share[k]) // 2))
        share[k] -= part
        spare += part
    return share, bits


@dataclass
class Block:
    """One encoded block; ``offsets`` are words before each checkpoint."""
    tokens: int
    words: bytes
    states: bytes
    offsets: list[int]
    crc: int      # of states and words
    ids_crc: int  # of the ids as little-endian uint32 values


class Coder:
    """Encoder and decoder of one table: ids in ascending order, their frequencies."""

    def __init__(self, ids: np.ndarray, share: np.ndarray, bits: int):
        self.ids, self.bits = np.asarray(ids, dtype=np.uint32), np.uint64(bits)
        self.mask = np.uint64((1 << bits) - 1)
        self.share = np.append(share, 1 << bits).astype(np.uint64)  # last: padding, changes nothing
        self.before = np.append(np.cumsum(share) - share, 0).astype(np.uint64)
        self.full = self.share << np.uint64(63 - bits)
        self.symbol = np.repeat(np.arange(len(self.ids), dtype=np.int32), share)
        self.place = np.zeros(int(self.ids[-1]) + 1 if len(self.ids) else 0, dtype=np.int64)  # of an id
        self.place[self.ids] = np.arange(len(self.ids))

    def encode(self, blocks: list[np.ndarray]) -> list[Block]:
        if not blocks:
            return []
        steps = [-(-len(b) // LANES) for b in blocks]
        most = max(steps)
        rows = np.full((len(blocks), most * LANES), len(self.ids), dtype=np.int64)
        for row, b in zip(rows, blocks):
            row[:len(b)] = self.place[b]
        by_step = np.ascontiguousarray(rows.reshape(len(blocks), most, LANES).transpose(1, 0, 2))
        x = np.full((len(blocks), LANES), LOW)
        passed, marks = [], []  # from the last step to the first
        for t in range(most - 1, -1, -1):
            s = by_step[t]
            f = self.share[s]
            over = x >= self.full[s]
            block = np.nonzero(over)[0]
            passed.append(((x[over] & _LOW_WORD).astype("<u4"), block))
            x = np.where(over, x >> _WORD, x)
            q = x // f
            x = (q << self.bits) + (x - q * f) + self.before[s]
            if t % CHECK == 0:
                marks.append((t, x, len(passed)))
        block = np.concatenate([b for _, b in reversed(passed)]) if passed else np.zeros(0, np.int64)
        words = np.concatenate([w for w, _ in reversed(passed)]) if passed else np.zeros(0, "<u4")
        order = np.argsort(block.astype(np.uint16), kind="stable")
        own = np.bincount(block, minlength=len(blocks))
        ends = np.cumsum(own)
        gone = np.array([np.bincount(b, minlength=len(blocks)) for _, b in passed]).reshape(-1, len(blocks)).cumsum(0)
        out = []
        for k, b in enumerate(blocks):
            mine = [(t, st[k], int(own[k] - gone[n - 1, k])) for t, st, n in reversed(marks) if t < steps[k]]
            data = words[order[ends[k] - own[k]:ends[k]]].tobytes()
            states = np.array([st for _, st, _ in mine], dtype="<u8").tobytes()
            out.append(Block(len(b), data, states, [o for _, _, o in mine], zlib.crc32(data, zlib.crc32(states)),
                             zlib.crc32(np.asarray(b, dtype="<u4").tobytes())))
        return out

    def decode(self, blocks: list[Block]) -> list[np.ndarray]:
        """Ids of every block; the stretches between checkpoints run side by side."""
        for b in blocks:
            if zlib.crc32(b.words, zlib.crc32(b.states)) != b.crc:
                raise Damaged("words or states of a block are damaged")
        base = np.cumsum([0] + [len(b.words) // 4 for b in blocks])
        words = np.frombuffer(b"".join(b.words for b in blocks) + bytes(4), dtype="<u4").astype(np.uint64)
        parts = [(min(CHECK, -(-b.tokens // LANES) - CHECK * k), i, k, base[i] + o)
                 for i, b in enumerate(blocks) for k, o in enumerate(b.offsets)]
        parts.sort(key=lambda p: (-p[0], p[1], p[2]))  # the longest first: live ones are a prefix
        x = np.concatenate([np.zeros((0, LANES), np.uint64)] + [
            np.frombuffer(blocks[i].states, dtype="<u8").reshape(-1, LANES)[[k]] for _, i, k, _ in parts])
        at = np.array([p[3] for p in parts], dtype=np.int64)
        live = np.array([p[0] for p in parts])
        got = np.zeros((len(parts), CHECK if len(parts) else 0, LANES), dtype=np.int32)
        for t in range(live.max(initial=0)):
            m = int(np.searchsorted(-live, -t))  # parts with more than t steps
            y = x[:m]
            slot = y & self.mask
            s = self.symbol[slot.astype(np.int64)]
            got[:m, t] = s
            y = self.share[s] * (y >> self.bits) + slot - self.before[s]
            low = y < LOW
            rank = np.cumsum(low, axis=1)
            place = np.minimum(at[:m, None] + rank - 1, len(words) - 1)
            x[:m] = np.where(low, (y << _WORD) | words[place], y)
            at[:m] += rank[:, -1]
        whole = [np.zeros(len(b.offsets) * CHECK * LANES, dtype=np.int32) for b in blocks]
        for (_, i, k, _), row in zip(parts, got):
            whole[i][k * CHECK * LANES:(k + 1) * CHECK * LANES] = row.ravel()
        out = []
        for b, symbols in zip(blocks, whole):
            ids = self.ids[symbols[:b.tokens]]
            if zlib.crc32(ids.astype("<u4").tobytes()) != b.ids_crc:
                raise Damaged("ids of a block do not match their checksum")
            out.append(ids)
        return out
