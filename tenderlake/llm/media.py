"""Telephony audio as media columns: G.711 mu-law and A-law, IMA ADPCM blocks, resampled PCM.

Payloads are stored as WAVE bytes in a binary column; 8-bit formats keep every byte.  Companded
samples expand through tables of 256 entries built from the formats' rules.  ADPCM is
decoded for all blocks of a chunk at once: step by step along the block, with numpy across
blocks.  PCM is resampled by a triangular filter in integer arithmetic, so that
equal payloads give equal samples on every machine, and stored as a WAVE file beside the original.

Defined cases: a null text is an empty payload; a payload is padded with zero bytes to a
positive multiple of BLOCK; texts are stored whole; repeated rows are stored each; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import Scratch, chunks, frugal, spread, table

#: Bytes of an ADPCM block: a header of 4 and two samples a byte.
BLOCK, RATE = 64, 8000
#: Options of the writer for media: more effort, and pages in which the compression sees more of what repeats.
COMPACT = {"parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(8 << 20)}
#: Samples a second of the linear PCM that the query stores: at 2 bytes each no more bytes than the payload.
PCM_RATE = 4000
PCM, ALAW, MULAW, ADPCM = 1, 6, 7, 17
#: Samples that are worked on at a time.
SPAN = 1 << 17

#: The ADPCM format's index changes by code (the sign bit aside).
INDEX_CHANGE = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)
#: The step sizes of IMA ADPCM.
STEPS = np.array(
    [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
    np.int32,
)


def mulaw_table() -> np.ndarray:
    """PCM value of each mu-law byte: complemented sign, exponent and mantissa, biased by 132."""
    b = ~np.arange(256, dtype=np.int32) & 0xFF
    value = (((b & 0x0F) << 3) + 0x84 << ((b & 0x70) >> 4)) - 0x84
    return np.where(b & 0x80, -value, value).astype(np.int16)


def alaw_table() -> np.ndarray:
    """PCM value of each A-law byte: even bits inverted, linear below the second segment."""
    b = np.arange(256, dtype=np.int32) ^ 0x55
    segment, base = (b & 0x70) >> 4, ((b & 0x0F) << 4) + 8
    value = np.where(segment == 0, base, (base + 0x100) << np.maximum(segment - 1, 0))
    return np.where(b & 0x80, value, -value).astype(np.int16)


MULAW_PCM, ALAW_PCM = mulaw_table(), alaw_table()


def _adpcm_moves() -> tuple[np.ndarray, np.ndarray]:
    """For each index and code: the change of the predictor and the next index."""
    code, step = np.arange(16), STEPS[:, None]
    size = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
    after = np.clip(np.arange(89)[:, None] + INDEX_CHANGE[code & 7], 0, 88)
    return np.where(code & 8, -size, size).astype(np.int32).ravel(), (after * 16).astype(np.int32).ravel()


CHANGE, AFTER = _adpcm_moves()


def decode_adpcm(data: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """PCM of whole blocks of IMA ADPCM (one channel, the low nibble first), a row of 2 * block - 7 samples each; a header's index beyond the table counts as its last."""
    rows = data.reshape(-1, block)
    out = np.empty((2 * block - 7, len(rows)), np.int16)
    value = rows[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(rows[:, 2], 88).astype(np.int32) * 16
    out[0] = value
    codes = np.ascontiguousarray(rows[:, 4:].T)
    k = 1
    for byte in codes:
        for code in (byte & 15, byte >> 4):
            at = index + code
            value += CHANGE[at]
            np.clip(value, -32768, 32767, out=value)
            index = AFTER[at]
            out[k] = value
            k += 1
    return out.T


def resample(pcm: np.ndarray, up: int, down: int) -> np.ndarray:
    """PCM at up / down times the rate, in integers: a triangular filter, as wide as a step of the lower of both rates on
    either side, so that it interpolates on the way up and is a low-pass on the way down; the end samples are held.
    """
    if not len(pcm):
        return pcm.astype(np.int16)
    n, wide = -(-len(pcm) * up // down), max(up, down)
    side = -(-wide // up) - (wide % up == 0)  # samples on either side that the filter reaches, besides the next one
    place = np.arange(min(up, n), dtype=np.int64) * down  # the phases repeat after `up` samples
    distance = np.abs(np.arange(-side, side + 2) * up - (place % up)[:, None])
    weight = np.maximum(0, wide - distance)
    x = np.concatenate((np.full(side, pcm[0]), pcm, np.full(down + side + 1, pcm[-1]))).astype(np.int64)
    out = np.empty(n, np.int64)
    for phase in range(min(up, n)):
        count = len(range(phase, n, up))
        total, at = int(weight[phase].sum()), int(place[phase] // up)
        acc = np.zeros(count, np.int64)
        for j, w in enumerate(weight[phase].tolist()):
            if w:
                acc += w * x[at + j : at + j + down * (count - 1) + 1 : down]
        out[phase::up] = (2 * acc + total) // (2 * total)
    return out.astype(np.int16)


def wave(payload: bytes, kind: int, rate: int = RATE) -> bytes:
    """A WAVE file of one channel."""
    bits, align = (4, BLOCK) if kind == ADPCM else (16, 2) if kind == PCM else (8, 1)
    extra = struct.pack("<HH", 2, 2 * BLOCK - 7) if kind == ADPCM else b""
    per_second = rate * BLOCK // (2 * BLOCK - 7) if kind == ADPCM else rate * align
    fmt = struct.pack("<HHIIHH", kind, 1, rate, per_second, align, bits) + extra
    body = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(payload) & 0xFFFFFFFF) + payload + b"\0" * (len(payload) % 2)
    return b"RIFF" + struct.pack("<I", len(body) + 4 & 0xFFFFFFFF) + b"WAVE" + body


def samples(media: bytes) -> tuple[int, int, memoryview]:
    """Kind, rate and payload of a WAVE file of which `data` is the last chunk."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("no WAVE file")
    at, kind, rate = 12, 0, 0
    while at + 8 <= len(media):
        name, n = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            kind, _, rate = struct.unpack_from("<HHI", media, at + 8)
        elif name == b"data":
            return kind, rate, memoryview(media)[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    raise ValueError("a WAVE file without data")


def to_pcm(media: bytes) -> np.ndarray:
    """The linear samples of a stored file, whatever its format."""
    kind, _, data = samples(media)
    raw = np.frombuffer(data, np.uint8)
    if kind in (MULAW, ALAW):
        return (MULAW_PCM if kind == MULAW else ALAW_PCM)[raw]
    if kind == ADPCM:
        return decode_adpcm(raw).ravel()
    return np.frombuffer(data, "<i2")


def store(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each text's bytes as the mu-law samples of a WAVE file."""

    def told(part):
        raw = pc.fill_null(part.column(1).cast(pa.large_binary()), b"").to_pylist()
        media = [wave(b + b"\0" * (-len(b) % BLOCK if b else BLOCK), MULAW) for b in raw]
        return pa.record_batch([part.column(0), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    def run(batches):
        with frugal(collect=False):
            for batch in batches:
                yield from map(told, chunks(batch, text))

    return docs.select(doc_id, text).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def resampled(media: DataFrame, rate: int = 16000, column: str = "media", to: str = "pcm") -> DataFrame:
    """The media table with each file as linear PCM at this rate in the column `to`, again a WAVE file; a null file stays null."""
    media = media.drop(to)
    at = media.columns.index(column)

    def linear(file):
        old = samples(file)[1]
        g = math.gcd(rate, old)
        return wave(resample(to_pcm(file), rate // g, old // g).astype("<i2", copy=False).tobytes(), PCM, rate)

    def told(part):
        files = [None if m is None else linear(m) for m in part.column(at).to_pylist()]
        return pa.record_batch([*part.columns, pa.array(files, pa.binary())], names=[*part.schema.names, to])

    def run(batches):
        with frugal(collect=False):
            for batch in batches:
                yield from map(told, chunks(batch, column, 4 << 20))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema.fields)
    return media.mapInArrow(run, f"{schema}, `{to}` binary")


def _sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, bounds[:-1])


def features(payloads: list[memoryview]) -> list[str]:
    """Of each payload read as mu-law, A-law and ADPCM: energies, and sign changes of its mu-law PCM."""
    out, at = [], 0
    while at < len(payloads):
        end, n = at, 0
        while end < len(payloads) and (end == at or n + len(payloads[end]) <= SPAN):
            n += len(payloads[end])
            end += 1
        some = payloads[at:end]
        raw = np.frombuffer(b"".join(some), np.uint8)
        bounds = np.cumsum([0, *map(len, some)])
        mu, a, ad = MULAW_PCM[raw], ALAW_PCM[raw], decode_adpcm(raw)
        e_mu = _sums(np.square(mu.astype(np.int64)), bounds)
        e_a = _sums(np.square(a.astype(np.int64)), bounds)
        wide = ad.astype(np.float64)  # sums of squares of a block stay exact in doubles
        e_ad = _sums(np.einsum("ij,ij->i", wide, wide).astype(np.int64), bounds // BLOCK)
        turn = np.zeros(len(mu), np.int64)
        turn[1:] = (mu[1:] < 0) != (mu[:-1] < 0)
        turn[bounds[:-1]] = 0
        turns = _sums(turn, bounds)
        out += [f"mu={x};a={y};adpcm={z};turns={n}" for x, y, z, n in zip(e_mu, e_a, e_ad, turns, strict=True)]
        at = end
    return out


def described(media: DataFrame) -> DataFrame:
    """What the stored bytes of each row of (doc_id, n_bytes, media, pcm) say, read back."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pcm_rate", "pcm_bytes", "pcm_sha256"]
    kinds = {"payload_sha256": "string", "media_sha256": "string", "feature": "string", "pcm_sha256": "string"}
    sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
    longs = lambda xs: pa.array(xs, pa.int64())

    def told(part):
        files, linear = part.column(2).to_pylist(), [samples(m) for m in part.column(3).to_pylist()]
        data, pcm = [samples(m)[2] for m in files], [x[2] for x in linear]
        said = [f"{x};pcm={zlib.crc32(p):08x}" for x, p in zip(features(data), pcm, strict=True)]
        cols = [longs(map(len, data)), sha(data), longs([zlib.crc32(d[-64:]) for d in data]), longs(map(len, files)), sha(files), pa.array(said, pa.string()), longs([x[1] for x in linear]), longs(map(len, pcm)), sha(pcm)]
        return pa.record_batch([part.column(0), part.column(1), *cols], names=names)

    def run(batches):
        with frugal(collect=False):
            for batch in batches:
                yield from map(told, chunks(batch, "media", 4 << 20))

    return media.select("doc_id", "n_bytes", "media", "pcm").mapInArrow(run, ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names))


def op4_telephony_audio(spark, sf_dir):
    media = resampled(store(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))), PCM_RATE)
    return described(Scratch(spark, "audio").save(media, "media", **COMPACT))
