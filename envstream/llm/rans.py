"""Range asymmetric numeral system over token ids, many lanes at once.

A block's tokens are dealt to ``lanes`` coders in turn (token t to lane
t mod lanes). All lanes of a block share one stream of 32-bit words and the
frequency table of their segment, so a block is decoded without its
neighbours. At every ``CHECK`` steps the lanes' states and the place in the
stream are kept: decoding may begin at any of these checkpoints.
"""

from __future__ import annotations

import zlib

import numpy as np

BITS = 18
LANES = 1024
STEPS = 256
CHECK = 128
LOW = np.uint64(1 << 32)
_32 = np.uint64(32)


class Table:
    """Frequencies that sum to less than 2 ** bits, every id present at least 1."""

    def __init__(self, ids, freqs, bits):
        self.ids, self.freqs, self.bits = ids, freqs, bits
        self.cums = np.cumsum(freqs, dtype=np.uint64) - freqs
        # Ids are numbers of a vocabulary, so a row per id up to the largest is small.
        self.places = np.zeros(int(ids[-1]) + 1 if len(ids) else 1, np.int32)
        self.places[ids] = np.arange(len(ids))

    @classmethod
    def of(cls, tokens):
        counts = np.bincount(tokens)
        ids = np.flatnonzero(counts).astype(np.uint32)
        counts = counts[ids]
        bits = max(BITS, int(len(ids)).bit_length() + 2)
        spare = (1 << bits) - 1 - len(ids)
        share = counts.astype(np.float64) / max(1, counts.sum())
        return cls(ids, 1 + np.floor(share * spare * (1 - 1e-9)).astype(np.uint64), bits)

    def to_bytes(self) -> bytes:
        steps = np.diff(self.ids.astype(np.int64), prepend=0).astype("<u4")
        return bytes([self.bits]) + zlib.compress(
            steps.tobytes() + self.freqs.astype("<u4").tobytes(), 1)

    @classmethod
    def from_bytes(cls, data: bytes):
        both = np.frombuffer(zlib.decompress(data[1:]), "<u4")
        n = len(both) // 2
        ids = np.cumsum(both[:n].astype(np.int64)).astype(np.uint32)
        return cls(ids, both[n:].astype(np.uint64), data[0])


def lanes_for(n: int) -> int:
    """Short blocks take fewer lanes, as each lane's state costs 8 bytes."""
    lanes = LANES
    while lanes > 1 and n < lanes * 64:
        lanes //= 2
    return lanes


def encode_block(tokens, table: Table) -> dict:
    n = len(tokens)
    lanes = lanes_for(n)
    rank = table.places[tokens]
    steps = -(-n // lanes)
    rank = np.concatenate([rank, np.repeat(rank[-1:], steps * lanes - n)]).reshape(steps, lanes)
    freqs, cums = table.freqs[rank], table.cums[rank]
    full = freqs << np.uint64(64 - table.bits)
    bits, states, words, marks = np.uint64(table.bits), np.full(lanes, LOW), [], []
    for k in range(steps - 1, -1, -1):
        over = np.flatnonzero(states >= full[k])
        if len(over):
            words.append(states[over].astype("<u4"))
            states[over] >>= _32
        else:
            words.append(np.empty(0, "<u4"))
        whole = states // freqs[k]
        states = (whole << bits) + (states - whole * freqs[k]) + cums[k]
        if k % CHECK == 0:
            marks.append((k, states.copy()))
    words.reverse()
    starts = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    return {
        "n": n, "lanes": lanes, "crc": zlib.crc32(tokens.astype("<u4").tobytes()),
        "words": np.concatenate(words).tobytes(),
        "checkpoints": [{"step": k, "word": int(starts[k]), "states": s.astype("<u8").tobytes()}
                        for k, s in reversed(marks)],
    }


class Decoder:
    def __init__(self, table: Table):
        self._table = table
        n = int(table.freqs.sum())
        self._rank = np.zeros(1 << table.bits, np.uint32)
        self._rank[:n] = np.repeat(np.arange(len(table.ids), dtype=np.uint32),
                                   table.freqs.astype(np.int64))

    def block(self, block: dict, first=0, last=None):
        """Tokens [first, last) of a block, begun at the nearest checkpoint. A block
        that is decoded whole is held against its checksum."""
        n, lanes = block["n"], block["lanes"]
        last = n if last is None else min(last, n)
        if first >= last:
            return np.empty(0, np.uint32)
        start = max((c for c in block["checkpoints"] if c["step"] <= first // lanes),
                    key=lambda c: c["step"])
        states = np.frombuffer(start["states"], "<u8").astype(np.uint64)
        words, at = np.frombuffer(block["words"], "<u4"), start["word"]
        table, steps = self._table, -(-last // lanes)
        mask, bits = np.uint64((1 << table.bits) - 1), np.uint64(table.bits)
        ranks = np.empty((steps - start["step"], lanes), np.uint32)
        for k in range(len(ranks)):
            slots = states & mask
            rank = self._rank[slots]
            ranks[k] = rank
            states = table.freqs[rank] * (states >> bits) + slots - table.cums[rank]
            under = np.flatnonzero(states < LOW)
            if len(under):
                states[under] = (states[under] << _32) | words[at:at + len(under)]
                at += len(under)
        low = start["step"] * lanes
        tokens = table.ids[ranks.reshape(-1)[first - low:last - low]].astype(np.uint32)
        if first == 0 and last == n and zlib.crc32(tokens.astype("<u4").tobytes()) != block["crc"]:
            raise ValueError("a block's checksum does not hold")
        return tokens


def encode(tokens, table: Table, size=LANES * STEPS) -> list[dict]:
    return [encode_block(tokens[i:i + size], table) for i in range(0, len(tokens), size)]
