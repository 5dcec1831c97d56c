"""Media columns in Ogg: pages with checksums, packets by lacing values, logical streams, time from granule positions."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import map_rows, table, utf8

#: Samples of one packet, samples a second, and bytes to whose multiple a payload is filled.
PACKET, RATE, UNIT = 4080, 8000, 64
#: Fixed values of the page header (RFC 3533) and the two streams' first packets.
CAPTURE, CONTINUED, FIRST, LAST = b"OggS", 1, 2, 4
AUDIO_HEAD, INDEX_HEAD = b"PCM8    ", b"index\0\0\0"
AUDIO_SERIAL, INDEX_SERIAL = 1, 2
_HEADER = struct.Struct("<4sBBqIIIB")
_FLIP = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(page: bytes) -> int:
    """CRC-32 with polynomial 04c11db7, most significant bit first, start 0: zlib's, over mirrored bits."""
    return int(f"{zlib.crc32(page.translate(_FLIP), 0xFFFFFFFF) ^ 0xFFFFFFFF:032b}"[::-1], 2)


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = _HEADER.pack(CAPTURE, 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    crc = struct.pack("<I", checksum(head + body))
    return head[:22] + crc + head[26:] + body


class _Stream:
    """Packets of one logical stream on their way into pages."""

    def __init__(self, serial: int):
        self.serial, self.number, self.lacing, self.body, self.granule, self.flags = serial, 0, bytearray(), [], -1, FIRST

    def flush(self, last: bool = False) -> bytes:
        page = _page(self.flags | (LAST if last else 0), self.granule, self.serial, self.number, bytes(self.lacing), b"".join(self.body))
        self.number, self.lacing, self.body, self.granule, self.flags = self.number + 1, bytearray(), [], -1, 0
        return page

    def add(self, packet: bytes, granule: int) -> list[bytes]:
        """The pages that fill up; a packet may go on in the next page."""
        pages, at = [], 0
        values = b"\xff" * (len(packet) // 255) + bytes([len(packet) % 255])
        while values:
            room = 255 - len(self.lacing)
            now, values = values[:room], values[room:]
            size = sum(now)
            self.lacing += now
            self.body.append(packet[at : at + size])
            at += size
            if not values:
                self.granule = granule
            if len(self.lacing) == 255:
                pages.append(self.flush())
                if values:
                    self.flags = CONTINUED
        return pages


def write_ogg(samples: bytes, rate: int = RATE) -> bytes:
    """8-bit samples in an audio stream, and an index stream with the count of samples, multiplexed."""
    audio, index = _Stream(AUDIO_SERIAL), _Stream(INDEX_SERIAL)
    pages = [*audio.add(AUDIO_HEAD + struct.pack("<IB", rate, 8), 0), audio.flush()]
    pages += [*index.add(INDEX_HEAD + struct.pack("<Q", len(samples)), 0), index.flush(last=True)]
    for at in range(0, len(samples), PACKET):
        packet = samples[at : at + PACKET]
        pages += audio.add(packet, at + len(packet))
    return b"".join([*pages, audio.flush(last=True)])


def pages_of(media: bytes):
    """(flags, granule, serial, number, lacing, body) of each page; ValueError where the form or a checksum is wrong."""
    at = 0
    while at < len(media):
        if at + 27 > len(media):
            raise ValueError("page header is cut")
        capture, version, flags, granule, serial, number, crc, n = _HEADER.unpack_from(media, at)
        lacing = media[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(lacing)
        if capture != CAPTURE or version or len(lacing) < n or end > len(media):
            raise ValueError(f"no page at byte {at}")
        if checksum(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : end]) != crc:
            raise ValueError(f"checksum differs at byte {at}")
        yield flags, granule, serial, number, lacing, media[at + 27 + n : end]
        at = end


def read_ogg(media: bytes) -> dict:
    """samples, rate, streams, packets, pages and the seconds at which each audio page ends; ValueError if media is damaged."""
    packets: dict[int, list[bytes]] = {}
    open_: dict[int, bytearray | None] = {}
    numbers: dict[int, int] = {}
    ended, times, n_pages, rate = set(), [], 0, RATE
    for flags, granule, serial, number, lacing, body in pages_of(media):
        n_pages += 1
        if bool(flags & FIRST) != (serial not in numbers) or number != numbers.get(serial, -1) + 1 or serial in ended:
            raise ValueError(f"page {number} of stream {serial} is out of order")
        if bool(flags & CONTINUED) != (open_.get(serial) is not None):
            raise ValueError(f"packet of stream {serial} is broken off")
        numbers[serial] = number
        at, packet = 0, open_.get(serial)
        packet = bytearray() if packet is None else packet
        whole = True
        for value in lacing:
            packet += body[at : at + value]
            at += value
            whole = value < 255
            if whole:
                packets.setdefault(serial, []).append(bytes(packet))
                packet = bytearray()
        open_[serial] = None if whole else packet
        if flags & LAST:
            ended.add(serial)
        if serial == AUDIO_SERIAL:
            if number == 0:
                head = packets[serial][0]
                if head[:8] != AUDIO_HEAD:
                    raise ValueError("unknown audio stream")
                rate = struct.unpack_from("<I", head, 8)[0]
            elif granule >= 0:
                times.append(granule / rate)
    if ended != set(numbers) or any(x is not None for x in open_.values()):
        raise ValueError("a stream has no end")
    samples = b"".join(packets[AUDIO_SERIAL][1:])
    (n,) = struct.unpack_from("<Q", packets[INDEX_SERIAL][0], 8)
    if n != len(samples):
        raise ValueError("samples are missing")
    return {"samples": samples, "rate": rate, "streams": len(numbers), "packets": sum(map(len, packets.values())), "pages": n_pages, "times": times}


def features(read: dict) -> str:
    """Streams, pages, packets, duration, level and zero crossings of what was read, as text."""
    x = np.frombuffer(read["samples"], np.uint8).astype(np.int32) - 128
    level = float(np.sqrt(np.mean(np.square(x, dtype=np.float64)))) if len(x) else 0.0
    crossings = int(np.count_nonzero((x[1:] >= 0) != (x[:-1] >= 0)))
    end = read["times"][-1] if read["times"] else 0.0
    return f"streams={read['streams']};pages={read['pages']};packets={read['packets']};seconds={end:.4f};level={level:.4f};crossings={crossings}"


def pad(payload: bytes, unit: int = UNIT) -> bytes:
    """payload with bytes 0 up to a positive multiple of unit."""
    return payload + b"\0" * (max(unit, -(-len(payload) // unit) * unit) - len(payload))


def store_media(docs: DataFrame, text: str = "text", rate: int = RATE) -> DataFrame:
    """docs with n_bytes and media (an Ogg file of the padded UTF-8 bytes as 8-bit samples); own columns of these names
    are replaced. Null counts as empty; equal texts give equal files; an empty table gives an empty table."""
    return map_rows(docs, [text], "n_bytes long, media binary", lambda column: ({"n_bytes": len(raw), "media": write_ogg(pad(raw), rate)} for raw in utf8(column)))


READ_SCHEMA = "payload binary, rate int, streams int, packets int, pages int, times array<double>, feature string, error string"


def _read(media: bytes | None) -> dict:
    try:
        read = read_ogg(media or b"")
    except (ValueError, KeyError, IndexError, struct.error) as e:
        return dict.fromkeys(("payload", "rate", "streams", "packets", "pages", "times", "feature")) | {"error": str(e) or type(e).__name__}
    return {"payload": read["samples"], **{k: read[k] for k in ("rate", "streams", "packets", "pages", "times")}, "feature": features(read), "error": None}


def load_media(stored: DataFrame, media: str = "media") -> DataFrame:
    """stored with READ_SCHEMA's columns. Damaged or null media: all null but error, which says what is wrong."""
    return map_rows(stored, [media], READ_SCHEMA, lambda column: (_read(x) for x in column.to_pylist()))


def op9_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = load_media(store_media(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_bytes", "media"))
    return read.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr(f"substring(payload, -{UNIT}, {UNIT})")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        "error",
    )


QUERIES = {"op9_ogg": op9_ogg}
ORACLES: dict[str, str] = {}
