"""Keccak-256 (the original padding), for event topics: hashlib's SHA-3 pads differently."""

from __future__ import annotations

MASK = (1 << 64) - 1


def _round_constants() -> list[int]:
    """The 24 constants from the standard's shift register x^8 + x^6 + x^5 + x^4 + 1."""
    out, r = [], 1
    for _ in range(24):
        c = 0
        for j in range(7):
            if r & 1:
                c |= 1 << ((1 << j) - 1)
            r = (r << 1) ^ ((r >> 7) * 0x171)
        out.append(c)
    return out


def _rotations() -> dict[tuple[int, int], int]:
    out, x, y = {(0, 0): 0}, 1, 0
    for t in range(24):
        out[x, y] = (t + 1) * (t + 2) // 2 % 64
        x, y = y, (2 * x + 3 * y) % 5
    return out


CONSTANTS, ROTATIONS = _round_constants(), _rotations()


def _left(v: int, n: int) -> int:
    return ((v << n) | (v >> (64 - n))) & MASK if n else v


def _permute(a: list[list[int]]) -> list[list[int]]:
    for constant in CONSTANTS:
        parity = [a[x][0] ^ a[x][1] ^ a[x][2] ^ a[x][3] ^ a[x][4] for x in range(5)]
        mixed = [parity[(x - 1) % 5] ^ _left(parity[(x + 1) % 5], 1) for x in range(5)]
        b = [[0] * 5 for _ in range(5)]
        for (x, y), n in ROTATIONS.items():
            b[y][(2 * x + 3 * y) % 5] = _left(a[x][y] ^ mixed[x], n)
        a = [[b[x][y] ^ (~b[(x + 1) % 5][y] & b[(x + 2) % 5][y]) & MASK for y in range(5)] for x in range(5)]
        a[0][0] ^= constant
    return a


def keccak256(data: bytes) -> bytes:
    rate = 136
    data += b"\x01" + b"\0" * (-(len(data) + 1) % rate)
    data = data[:-1] + bytes([data[-1] | 0x80])
    a = [[0] * 5 for _ in range(5)]
    for i in range(0, len(data), rate):
        for j in range(rate // 8):
            a[j % 5][j // 5] ^= int.from_bytes(data[i + 8 * j : i + 8 * j + 8], "little")
        a = _permute(a)
    return b"".join(a[j % 5][j // 5].to_bytes(8, "little") for j in range(4))


def topic_of(signature: str) -> str:
    """First topic of an event by its signature, such as Transfer(address,address,uint256)."""
    return "0x" + keccak256(signature.encode()).hex()
