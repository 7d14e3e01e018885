"""Telephony audio: mu-law, A-law and ADPCM in WAV files, expanded to PCM and resampled."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyjoin.llm.common import blocks, text_bytes

RATE = 8_000
PCM, A_LAW, MU_LAW, IMA_ADPCM = 1, 6, 7, 0x11
#: Bytes of an ADPCM block: a header of four and two samples a byte.
BLOCK = 64

# Fixed values of the IMA ADPCM format: quantizer steps, and how a code moves the step index.
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173,
    190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066,
    2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818,
    18500, 20350, 22385, 24623, 27086, 29794, 32767], np.int32)
MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)


def mu_law_table() -> np.ndarray:
    """16-bit samples of the 256 mu-law bytes: inverted bits; sign, exponent of three bits, mantissa of four."""
    code = 255 - np.arange(256)
    size = ((((code & 15) << 3) + 132) << (code >> 4 & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def a_law_table() -> np.ndarray:
    """16-bit samples of the 256 A-law bytes: every other bit inverted; sign, exponent, mantissa."""
    code = np.arange(256) ^ 0x55
    power = code >> 4 & 7
    size = np.where(power == 0, ((code & 15) << 4) + 8, (((code & 15) << 4) + 264) << np.maximum(power - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


def adpcm_table() -> np.ndarray:
    """Change of the sample by step index and code."""
    step, code = STEPS[:, None], np.arange(16)[None, :]
    size = (step >> 3) + (step >> 2) * (code & 1) + (step >> 1) * (code >> 1 & 1) + step * (code >> 2 & 1)
    return np.where(code & 8, -size, size).astype(np.int32)


MU, A, CHANGES = mu_law_table(), a_law_table(), adpcm_table()


def decode_adpcm(data: np.ndarray) -> np.ndarray:
    """PCM of IMA ADPCM blocks, one row a block. All blocks take a step together. A step index above 88 counts as 88."""
    units = data.reshape(-1, BLOCK)
    sample = units[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(units[:, 2], 88).astype(np.int32)
    codes = np.empty((2 * (BLOCK - 4), len(units)), np.uint8)
    codes[0::2], codes[1::2] = (units[:, 4:] & 15).T, (units[:, 4:] >> 4).T
    out = np.empty((len(codes) + 1, len(units)), np.int16)
    out[0] = sample
    for k, code in enumerate(codes):
        sample += CHANGES[index, code]
        np.clip(sample, -32768, 32767, out=sample)
        out[k + 1] = sample
        index += MOVES[code]
        np.clip(index, 0, 88, out=index)
    return out.T


def doubled(pcm: np.ndarray) -> np.ndarray:
    """PCM at twice the rate: samples between by the half-band filter (-1, 9, 9, -1) / 16, ends repeated."""
    x = np.concatenate([pcm[:1], pcm, pcm[-1:], pcm[-1:]]).astype(np.int32)
    between = (9 * (x[1:-2] + x[2:-1]) - x[:-3] - x[3:] + 8) >> 4
    out = np.empty(2 * len(pcm), np.int16)
    out[0::2], out[1::2] = pcm, np.clip(between, -32768, 32767)
    return out


def wav(data: bytes, kind: int, rate: int) -> bytes:
    """A WAV file of one channel; data has an even length."""
    width, unit, samples = (16, 2, len(data) // 2) if kind == PCM else (4, BLOCK, len(data) // BLOCK * (2 * BLOCK - 7)) if kind == IMA_ADPCM else (8, 1, len(data))
    per_second = rate * unit if kind != IMA_ADPCM else rate * BLOCK // (2 * BLOCK - 7)
    extra = struct.pack("<HH", 2, 2 * BLOCK - 7) if kind == IMA_ADPCM else struct.pack("<H", 0)
    form = struct.pack("<HHIIHH", kind, 1, rate, per_second, unit, width) + extra
    body = b"WAVE" + b"".join(name + struct.pack("<I", len(part)) + part for name, part in (
        (b"fmt ", form), (b"fact", struct.pack("<I", samples)), (b"data", data)))
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(media: bytes) -> tuple[int, int, bytes]:
    """Kind, rate and data of a WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, kind, rate = 12, None, None
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            kind, _, rate = struct.unpack_from("<HHI", media, at + 8)
        elif name == b"data":
            return kind, rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def expanded(kind: int, data: bytes) -> np.ndarray:
    """16-bit PCM of stored data."""
    raw = np.frombuffer(data, np.uint8)
    if kind == PCM:
        return np.frombuffer(data, "<i2")
    return decode_adpcm(raw).ravel() if kind == IMA_ADPCM else (MU if kind == MU_LAW else A)[raw]


def described(pcm: np.ndarray) -> str:
    """Samples, peak, root mean square (rounded down) and zero crossings."""
    wide = pcm.astype(np.int64)
    return f"n={len(pcm)} peak={int(np.abs(wide).max())} rms={int(np.sqrt((wide * wide).sum() // len(pcm)))} zero={int(np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0)))}"


def media_batches(batches: Iterator[pa.RecordBatch], with_media: bool) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        data, offsets = text_bytes(block.column("text"))
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media", "pcm"]
        rows: dict[str, list] = {n: [] for n in names[1:]}
        payloads = []
        for k in range(len(offsets) - 1):
            text = data[offsets[k] : offsets[k + 1]].tobytes()
            media = wav(text + bytes(-len(text) % BLOCK if text else BLOCK), MU_LAW, RATE)
            payload = read_wav(media)[2]
            payloads.append(payload)
            rows["n_bytes"].append(len(text))
            rows["payload_bytes"].append(len(payload))
            rows["payload_sha256"].append(hashlib.sha256(payload).hexdigest())
            rows["tail_crc32"].append(zlib.crc32(payload[-64:]))
            rows["media_bytes"].append(len(media))
            rows["media_sha256"].append(hashlib.sha256(media).hexdigest())
            rows["media"].append(media if with_media else None)
        adpcm, first = decode_adpcm(np.frombuffer(b"".join(payloads), np.uint8)), 0
        for payload in payloads:
            raw, count = np.frombuffer(payload, np.uint8), len(payload) // BLOCK
            pcm = doubled(MU[raw])
            rows["feature"].append(f"mu {described(pcm)} crc={zlib.crc32(pcm.tobytes())}; a {described(A[raw])}; adpcm {described(adpcm[first : first + count].ravel())}")
            rows["pcm"].append(wav(pcm.tobytes(), PCM, 2 * RATE) if with_media else None)
            first += count
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([block.column("doc_id"), *(pa.array(rows[n], t) for n, t in zip(names[1:], kinds, strict=True))], names)


def store(documents: DataFrame, with_media: bool = True) -> DataFrame:
    """Each text of documents (doc_id, text) as telephony audio, with features; one row a row, no shuffle.

    The payload, UTF-8 bytes and zeros up to a positive multiple of 64, is stored as mu-law samples in a WAV
    file (media) and read back. feature describes the payload expanded as mu-law and resampled to twice the
    rate, expanded as A-law, and decoded as ADPCM blocks of 64 bytes. pcm is the resampled sound as WAV.
    media and pcm are null unless with_media.

    Null or empty text: 64 zeros. Null doc_id stays null. Equal texts give equal values. Other columns are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(
        lambda batches: media_batches(batches, with_media),
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
        "feature string, media binary, pcm binary")
