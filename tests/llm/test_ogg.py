import random

import pytest

from quillgrid.llm.ogg import checksum, load_media, pad, pages_of, read_ogg, store_media, write_ogg

from .common import AWKWARD, docs_frame


def slow_checksum(data):
    crc = 0
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = ((crc << 1) ^ (0x04C11DB7 if crc & 0x80000000 else 0)) & 0xFFFFFFFF
    return crc


def test_checksum():
    rng = random.Random(1)
    for n in (0, 1, 27, 500):
        data = rng.randbytes(n)
        assert checksum(data) == slow_checksum(data)


@pytest.mark.parametrize("n", [0, 64, 254, 255, 256, 4079, 4080, 4081, 65024, 65025, 65026, 300_000])
def test_exact_round_trip(n):
    data = random.Random(n).randbytes(n)
    media = write_ogg(data)
    read = read_ogg(media)
    assert read["samples"] == data and read["streams"] == 2
    if n:
        assert read["times"][-1] == n / 8000 and read["times"] == sorted(read["times"])
    assert write_ogg(data) == media


def test_damage_is_found():
    media = bytearray(write_ogg(bytes(5000)))
    for at in (5, 30, 100, len(media) - 1):
        bad = bytearray(media)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            read_ogg(bytes(bad))
    with pytest.raises(ValueError):
        read_ogg(bytes(media[:-10]))
    two = [len(p[4]) + 27 + len(p[5]) for p in pages_of(bytes(media))]
    with pytest.raises(ValueError):
        read_ogg(bytes(media[: sum(two[:-1])]))


def test_operator(spark):
    rows = [*enumerate(AWKWARD), (None, "x"), (None, "x")]
    got = load_media(store_media(docs_frame(spark, rows).selectExpr("*", "'clash' AS media", "1 AS rate"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert bytes(r.payload) == pad((r.text or "").encode()) and r.error is None
    assert load_media(store_media(docs_frame(spark, []))).count() == 0
    broken = load_media(spark.createDataFrame([(None,), (b"OggS",)], "media binary")).collect()
    assert all(r.error and r.payload is None for r in broken)
