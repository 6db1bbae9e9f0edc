"""FLAC, mono and 8 bits a sample, in blocks of 576 samples, written and read many frames at a time.

Frames are rows of numpy arrays: the writer predicts, codes and packs all rows at once, and the
reader steps through the samples of all frames together, so neither loops over bytes in Python.
A seek table names the byte and the sample at which each frame starts; with it any block can be
read alone.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np

BLOCK = 576
RATE = 8_000
PARTITIONS = 3  # as a power of two
PRECISION = 12
AT_ONCE = 1_024
MAX_RICE = 14

_FIXED = {0: [], 1: [1], 2: [2, -1], 3: [3, -3, 1], 4: [4, -6, 4, -1]}


def _crc_table(polynomial: int, width: int) -> np.ndarray:
    top, mask = 1 << (width - 1), (1 << width) - 1
    table = np.arange(256, dtype=np.int64) << (width - 8)
    for _ in range(8):
        table = np.where(table & top, (table << 1) ^ polynomial, table << 1) & mask
    return table


_CRC8, _CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)
_LEADING = np.full(1 << 16, 16, dtype=np.int64)
for _bit in range(16):
    _LEADING[1 << _bit : 2 << _bit] = 15 - _bit


def _crc(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, table: np.ndarray, width: int) -> np.ndarray:
    """The checksum of each of many byte runs."""
    order = np.argsort(-lengths, kind="stable")
    begin, left = starts[order], lengths[order]
    crc = np.zeros(len(order), dtype=np.int64)
    mask, high = (1 << width) - 1, width - 8
    for i in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -i, side="left"))
        c = crc[:n]
        crc[:n] = ((c << 8) & mask) ^ table[(c >> high) ^ data[begin[:n] + i]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _number_bytes(n: int) -> bytes:
    """A frame's number, coded as UTF-8 codes a character, up to 36 bits."""
    if n < 0x80:
        return bytes([n])
    tail = []
    while True:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        room = 6 - len(tail)
        if n < 1 << room:
            return bytes([(0xFF << (room + 1)) & 0xFF | n, *reversed(tail)])


def _headers(numbers: np.ndarray) -> list[bytes]:
    """Frame headers up to their checksum: fixed block size 576, rate from the stream, mono, 8 bits."""
    made = []
    for n in numbers.tolist():
        head = b"\xff\xf8\x20\x02" + _number_bytes(n)
        crc = 0
        for b in head:
            crc = int(_CRC8[crc ^ b])
        made.append(head + bytes([crc]))
    return made


def _predictors(x: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Quantised linear predictors of each row by Levinson and Durbin: coefficients and shifts."""
    f = x.astype(np.float64)
    auto = np.stack([(f[:, : BLOCK - lag] * f[:, lag:]).sum(1) for lag in range(order + 1)], 1)
    error = auto[:, 0] * (1 + 1e-9) + 1e-9
    a = np.zeros((len(x), order))
    for i in range(order):
        k = (auto[:, i + 1] - (a[:, :i] * auto[:, i:0:-1]).sum(1)) / error
        a[:, :i] -= k[:, None] * a[:, :i][:, ::-1]
        a[:, i] = k
        error = np.maximum(error * (1 - k * k), 1e-9)
    most = np.maximum(np.abs(a).max(1), 1e-6)
    shift = np.clip(PRECISION - 2 - np.ceil(np.log2(most)), 0, 15).astype(np.int64)
    limit = 1 << (PRECISION - 1)
    return np.clip(np.rint(a * (1 << shift)[:, None].astype(float)), -limit, limit - 1).astype(np.int64), shift


def _residual(x: np.ndarray, coefficients: np.ndarray, shift: np.ndarray) -> np.ndarray:
    order = coefficients.shape[1]
    guess = sum(coefficients[:, j, None] * x[:, order - 1 - j : BLOCK - 1 - j] for j in range(order))
    out = x.copy()
    out[:, order:] -= guess >> shift[:, None]
    return out


def encode_frames(samples: np.ndarray, numbers: np.ndarray, lpc_order: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the frames one after the other, and each frame's length. samples: int64, a block a row."""
    count = len(samples)
    order, best = np.zeros(count, dtype=np.int64), samples.copy()
    weight, now = np.abs(samples).sum(1), samples
    for p in range(1, 5):
        now = np.concatenate([now[:, :p], np.diff(now[:, p - 1 :], axis=1)], axis=1)
        total = np.abs(now[:, p:]).sum(1)
        better = total < weight
        order[better], best[better], weight = p, now[better], np.minimum(weight, total)
    linear = np.zeros(count, dtype=bool)
    if lpc_order:
        coefficients, shift = _predictors(samples, lpc_order)
        now = _residual(samples, coefficients, shift)
        total = np.abs(now[:, lpc_order:]).sum(1) + 24 * lpc_order
        linear = total < weight
        order[linear], best[linear] = lpc_order, now[linear]
    warm = np.arange(BLOCK)[None, :] < order[:, None]
    folded = np.where(warm, 0, (best << 1) ^ (best >> 63))
    parts = 1 << PARTITIONS
    split = folded.reshape(count, parts, -1)
    sizes = np.full((count, parts), BLOCK // parts)
    sizes[:, 0] -= order
    costs = np.stack([(split >> k).sum(2) + (k + 1) * sizes for k in range(MAX_RICE + 1) if k < 12], 0)
    rice = costs.argmin(0)
    coded = costs.min(0).sum(1) + 8 * order + 6 + 4 * parts + np.where(linear, 9 + PRECISION * order, 0)
    constant = (samples == samples[:, :1]).all(1)
    verbatim = ~constant & (coded >= 8 * BLOCK)
    plain = ~constant & ~verbatim
    order[~plain], linear = 0, linear & plain

    heads = _headers(numbers)
    head_bits = np.array([8 * len(h) for h in heads], dtype=np.int64)
    # fields of a frame, in order: type | warm-up or constant | predictor | method | parameters and codes
    width = np.zeros((count, 1 + 4 + 2 + 4 + 2 + BLOCK + parts), dtype=np.int64)
    value = np.zeros_like(width)
    warm_at, lpc_at, method_at, code_at = 1, 5, 11, 13
    kind = np.where(constant, 0, np.where(verbatim, 1, np.where(linear, 31 + order, 8 + order)))
    width[:, 0], value[:, 0] = 8, kind << 1
    raw = samples & 255
    for j in range(4):
        on = plain & (order > j) | constant & (j == 0)
        width[on, warm_at + j], value[on, warm_at + j] = 8, raw[on, j]
    if linear.any():
        width[linear, lpc_at], value[linear, lpc_at] = 4, PRECISION - 1
        width[linear, lpc_at + 1], value[linear, lpc_at + 1] = 5, shift[linear]
        for j in range(lpc_order):
            width[linear, lpc_at + 2 + j], value[linear, lpc_at + 2 + j] = PRECISION, coefficients[linear, j] & ((1 << PRECISION) - 1)
    width[plain, method_at], width[plain, method_at + 1], value[plain, method_at + 1] = 2, 4, PARTITIONS
    k = np.repeat(rice, BLOCK // parts, axis=1)
    code_width = np.where(warm, 0, (folded >> k) + 1 + k)
    code_value = (1 << k) | folded & ((1 << k) - 1)
    code_width[verbatim], code_value[verbatim] = 8, raw[verbatim]
    code_width[constant] = 0
    code_value[code_width == 0] = 0
    codes = np.arange(BLOCK) + 1 + np.arange(BLOCK) // (BLOCK // parts)
    width[:, code_at + codes], value[:, code_at + codes] = code_width, code_value
    params = code_at + np.arange(parts) * (BLOCK // parts + 1)
    width[np.ix_(plain, params)], value[np.ix_(plain, params)] = 4, rice[plain]

    ends = head_bits[:, None] + np.cumsum(width, 1)
    lengths = (ends[:, -1] + 7) // 8 + 2
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    last = (ends + 8 * starts[:, None] - 1).ravel()
    on = (width > 0).ravel()
    last, bits = last[on], value.ravel()[on]
    at, moved = last >> 3, bits << (7 - (last & 7))
    size = int(lengths.sum())
    sums = np.bincount(at, moved & 255, size)
    for back in (1, 2):
        part = moved >> 8 * back & 255
        some = part > 0
        sums += np.bincount(at[some] - back, part[some], size)
    data = sums.astype(np.uint8)
    for start, head in zip(starts.tolist(), heads):
        data[start : start + len(head)] = np.frombuffer(head, dtype=np.uint8)
    crc = _crc(data, starts, lengths - 2, _CRC16, 16)
    data[starts + lengths - 2], data[starts + lengths - 1] = crc >> 8, crc & 255
    return data, lengths


def write_streams(payloads: list[bytes], lpc_order: int = 4) -> list[bytes]:
    """One FLAC stream per payload; a byte b is the sample b - 128. Lengths are positive multiples of 576."""
    blocks = np.array([len(p) // BLOCK for p in payloads], dtype=np.int64)
    samples = np.frombuffer(b"".join(payloads), dtype=np.uint8).reshape(-1, BLOCK)
    numbers = np.concatenate([np.arange(n) for n in blocks]) if len(blocks) else np.array([], dtype=np.int64)
    made = [encode_frames(samples[i : i + AT_ONCE].astype(np.int64) - 128, numbers[i : i + AT_ONCE], lpc_order) for i in range(0, len(samples), AT_ONCE)]
    data = b"".join(d.tobytes() for d, _ in made)
    lengths = np.concatenate([n for _, n in made]) if made else np.array([], dtype=np.int64)
    ends = np.cumsum(lengths)
    out, frame, byte = [], 0, 0
    for payload, n in zip(payloads, blocks.tolist()):
        own, stop = lengths[frame : frame + n], int(ends[frame + n - 1])
        seek = np.zeros(n, dtype=[("sample", ">u8"), ("byte", ">u8"), ("samples", ">u2")])
        seek["sample"], seek["byte"], seek["samples"] = np.arange(n) * BLOCK, np.r_[0, np.cumsum(own)[:-1]], BLOCK
        total = n * BLOCK
        info = struct.pack(">HH", BLOCK, BLOCK) + int(own.min()).to_bytes(3, "big") + int(own.max()).to_bytes(3, "big")
        info += (RATE << 44 | 0 << 41 | 7 << 36 | total).to_bytes(8, "big")
        info += hashlib.md5((np.frombuffer(payload, dtype=np.uint8) ^ 128).tobytes()).digest()
        table = seek.tobytes()
        out.append(b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(table).to_bytes(3, "big") + table + data[byte:stop])
        frame, byte = frame + n, stop
    return out


def parse_stream(media: bytes) -> tuple[int, bytes, np.ndarray, int]:
    """Samples, MD5, seek table (sample, byte, samples) and the byte at which frames start."""
    if media[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, total, md5, seek = 4, 0, b"", None
    while True:
        kind, size = media[at], int.from_bytes(media[at + 1 : at + 4], "big")
        body = media[at + 4 : at + 4 + size]
        if kind & 127 == 0:
            bits = int.from_bytes(body[10:18], "big")
            if body[:4] != struct.pack(">HH", BLOCK, BLOCK) or bits >> 36 & 255 != 7:
                raise ValueError("only blocks of 576 samples, mono and 8 bits, are read")
            total, md5 = bits & ((1 << 36) - 1), body[18:34]
        elif kind & 127 == 3:
            seek = np.frombuffer(body, dtype=[("sample", ">u8"), ("byte", ">u8"), ("samples", ">u2")])
        at += 4 + size
        if kind & 128:
            break
    if seek is None:
        raise ValueError("the stream has no seek table")
    return total, md5, seek, at


def decode_frames(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The samples of the frames, a block a row; raises ValueError where a checksum, a number or a length is wrong."""
    count = len(starts)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    words = padded[:-3] << np.uint64(24) | padded[1:-2] << np.uint64(16) | padded[2:-1] << np.uint64(8) | padded[3:]
    words = words.astype(np.int64)

    def peek(at: np.ndarray, n) -> np.ndarray:
        """The next n <= 24 bits at bit positions."""
        return ((words[at >> 3] << (at & 7)) & 0xFFFFFFFF) >> (32 - n)

    def signed(v: np.ndarray, n) -> np.ndarray:
        return v - ((v >> np.maximum(n - 1, 0) & 1) << n)

    if (words[starts] != 0xFFF82002).any():
        raise ValueError("a frame does not start where the seek table says")
    lead = data[starts + 4].astype(np.int64)
    extra = np.select([lead < 0x80, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC, lead < 0xFE], [0, 1, 2, 3, 4, 5], 6)
    number = np.where(extra == 0, lead, lead & (0x3F >> extra))
    for j in range(1, 7):
        on = extra >= j
        number[on] = number[on] << 6 | data[starts[on] + 4 + j] & 63
    if (number != numbers).any():
        raise ValueError("a frame has another number than its place")
    head = 5 + extra
    if (_crc(data, starts, head, _CRC8, 8) != data[starts + head]).any():
        raise ValueError("the checksum of a frame's header is wrong")
    stored = data[starts + lengths - 2].astype(np.int64) << 8 | data[starts + lengths - 1]
    if (_crc(data, starts, lengths - 2, _CRC16, 16) != stored).any():
        raise ValueError("the checksum of a frame is wrong")

    at = (starts + head + 1) * 8
    kind = peek(at, 8) >> 1
    at += 8
    out = np.zeros((count, BLOCK), dtype=np.int64)
    constant, verbatim = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    if len(constant):
        out[constant] = signed(peek(at[constant], 8), 8)[:, None]
        at[constant] += 8
    if len(verbatim):
        first = at[verbatim] >> 3
        out[verbatim] = data[first[:, None] + np.arange(BLOCK)].view(np.int8)
        at[verbatim] += 8 * BLOCK
    rows = np.flatnonzero(kind >= 8)
    if len(rows):
        pos, which = at[rows], kind[rows]
        linear = which >= 32
        order = np.where(linear, which - 31, which - 8)
        if ((order < 0) | (~linear & (order > 4))).any():
            raise ValueError("a frame has an unknown type")
        n_rows, most = len(rows), int(order.max())
        x = np.zeros((BLOCK, n_rows), dtype=np.int64)
        for i in range(most):
            on = order > i
            x[i, on] = signed(peek(pos[on], 8), 8)
            pos[on] += 8
        taps, shift = np.zeros((max(most, 1), n_rows), dtype=np.int64), np.zeros(n_rows, dtype=np.int64)
        for p, taken in _FIXED.items():
            if p <= most:
                for j, c in enumerate(taken):
                    taps[j, ~linear & (order == p)] = c
        if linear.any():
            bits = peek(pos[linear], 4) + 1
            shift[linear] = signed(peek(pos[linear] + 4, 5), 5)
            pos[linear] += 9
            for j in range(most):
                on = linear & (order > j)
                own = bits[order[linear] > j]
                taps[j, on] = signed(peek(pos[on], own), own)
                pos[on] += own
        if (peek(pos, 2) > 1).any():
            raise ValueError("a frame has an unknown coding of residuals")
        wide = 4 + peek(pos, 2)
        part = BLOCK >> peek(pos + 2, 4)
        pos += 6
        rice, escape = np.zeros(n_rows, dtype=np.int64), np.full(n_rows, -1, dtype=np.int64)
        finest = int(part.min())
        for i in range(BLOCK):
            if i % finest == 0 or i <= most:
                opens = (i >= order) & ((i % part == 0) | (i == order))
                if opens.any():
                    rice[opens] = peek(pos[opens], wide[opens])
                    pos[opens] += wide[opens]
                    raw = opens & (rice == (1 << wide) - 1)
                    escape[opens] = -1
                    if raw.any():
                        escape[raw] = peek(pos[raw], 5)
                        pos[raw] += 5
            on = i >= order if i < most else slice(None)
            p, k = pos[on], rice[on]
            lead = _LEADING[peek(p, 16)]
            q = lead.copy()
            while (more := lead == 16).any():
                lead = np.where(more, _LEADING[peek(p + q, 16)], 0)
                q += lead
            p = p + q + 1
            folded = q << k | peek(p, k)
            residual = folded >> 1 ^ -(folded & 1)
            moved = p + k
            if (escape >= 0).any():
                e, before = escape[on], pos[on]
                plain = e >= 0
                residual = np.where(plain, signed(peek(before, np.maximum(e, 0)), np.maximum(e, 0)), residual)
                moved = np.where(plain, before + np.maximum(e, 0), moved)
            pos[on] = moved
            guess = np.zeros(n_rows, dtype=np.int64)
            for j in range(min(most, i)):
                guess += taps[j] * x[i - 1 - j]
            x[i, on] = residual + (guess >> shift)[on]
        out[rows] = x.T
        at[rows] = pos
    if (((at + 7) >> 3) + 2 - starts != lengths).any():
        raise ValueError("a frame is longer or shorter than the seek table says")
    return out


def read_streams(streams: list[bytes]) -> list[bytes]:
    """The payload of each stream, from its decoded frames; checks frame checksums, frame numbers and the MD5 of the whole."""
    starts, lengths, numbers, blocks, sums = [], [], [], [], []
    base = 0
    for media in streams:
        _, md5, seek, at = parse_stream(media)
        own = base + at + seek["byte"].astype(np.int64)
        starts.append(own)
        lengths.append(np.diff(np.r_[own, base + len(media)]))
        numbers.append(seek["sample"].astype(np.int64) // BLOCK)
        blocks.append(len(seek))
        sums.append(md5)
        base += len(media)
    if not streams:
        return []
    data = np.frombuffer(b"".join(streams), dtype=np.uint8)
    starts, lengths, numbers = (np.concatenate(x) for x in (starts, lengths, numbers))
    made = []
    for i in range(0, len(starts), AT_ONCE):
        s, n = starts[i : i + AT_ONCE], lengths[i : i + AT_ONCE]
        low, high = int(s[0]), int(s[-1] + n[-1])
        made.append(decode_frames(data[low:high], s - low, n, numbers[i : i + AT_ONCE]).astype(np.int8))
    pcm = np.concatenate(made).tobytes()
    out, at = [], 0
    for n, md5 in zip(blocks, sums):
        own = pcm[at : at + n * BLOCK]
        if hashlib.md5(own).digest() != md5:
            raise ValueError("the samples differ from the stream's MD5")
        out.append((np.frombuffer(own, dtype=np.uint8) ^ 128).tobytes())
        at += n * BLOCK
    return out


def read_block(media: bytes, block: int) -> bytes:
    """The payload of one block, found by the seek table."""
    _, _, seek, at = parse_stream(media)
    start = at + int(seek["byte"][block])
    stop = at + int(seek["byte"][block + 1]) if block + 1 < len(seek) else len(media)
    data = np.frombuffer(media[start:stop], dtype=np.uint8)
    samples = decode_frames(data, np.array([0]), np.array([len(data)]), np.array([block]))
    return ((samples[0] + 128).astype(np.uint8)).tobytes()
