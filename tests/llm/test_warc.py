from __future__ import annotations

import hashlib
import io
import struct

import pytest
import zstandard
from rollcall.llm import warc
from rollcall.llm.common import prepare

BIG = "<p>é" + "x" * 1500


def pages():
    rows = [(i, f"http://a.example/{i}?q=a b\r\nX: y", BIG if i % 3 == 0 else f"<html>{i}{'y' * (i * 40)}</html>") for i in range(60)]
    return rows + [(60, None, None), (61, "u", ""), (62, "u", "small"), (63, "u", "small"), (57, "u", BIG), (None, "u", BIG), (64, "u", "é" * 400_000)]


def table(spark, rows):
    return prepare(spark).createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, payload string, records string")


def test_round_trip(spark):
    manifest = warc.write_archives(table(spark, pages()))
    out = warc.read_archives(manifest, payloads=True).collect()
    keeper = max(i for i, _, h in pages() if h == BIG and i is not None)
    want = []
    for i, _, h in pages():
        data = (h or "").encode()
        again = h == BIG and i != keeper
        want.append(repr((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", keeper if again else None, None if again else data)))
    got = [repr((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"]) if r["payload"] is None or len(r["payload"]) else b"")) for r in out]
    assert sorted(got) == sorted(want)


def test_archives_roll_over(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    manifest = warc.write_archives(table(spark, pages() * 8).coalesce(1))
    assert manifest.count() > 1
    assert warc.read_archives(manifest).count() == 8 * len(pages())


def test_dictionary_leads(spark):
    text = [" ".join(hashlib.sha1(f"{i % 9}{j}".encode()).hexdigest()[: j % 7 + 2] for j in range(60)) for i in range(300)]
    manifest = warc.write_archives(table(spark, [(i, "u", f"<html><body>{i} {t}</body></html>") for i, t in enumerate(text)]).coalesce(1))
    with open(manifest.first()["archive"], "rb") as file:
        data = file.read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    warc.parse_record(one.decompress(data[8 + size :]))
    assert one.unused_data  # the next record has a frame of its own


@pytest.mark.parametrize("count", [1, 2, 5])
def test_few_records_have_a_dictionary_too(spark, count):
    manifest = warc.write_archives(table(spark, [(i, "u", f"<p>{i}</p>") for i in range(count)]).coalesce(1))
    with open(manifest.first()["archive"], "rb") as file:
        assert struct.unpack("<I", file.read(4))[0] == 0x184D2A5D
    assert sorted(r["page_id"] for r in warc.read_archives(manifest).collect()) == list(range(count))


def test_plain_dictionary_and_small_reads():
    records = [warc.record_bytes(i, "u", (b"page %d " % i) * 30, hashlib.sha1((b"page %d " % i) * 30).hexdigest(), None, False) for i in range(200)]
    trained = zstandard.train_dictionary(4096, records)
    packer = zstandard.ZstdCompressor(dict_data=trained)
    data = struct.pack("<II", warc.DICTIONARY_MAGIC, len(trained.as_bytes())) + trained.as_bytes() + b"".join(map(packer.compress, records))
    for chunk in (7, 100, 1 << 20):
        assert [d for _, d in warc.frames(io.BytesIO(data), chunk)] == records
    with pytest.raises(ValueError, match="cut short"):
        list(warc.frames(io.BytesIO(data[:-3])))
    with pytest.raises(ValueError, match="cut short"):
        list(warc.frames(io.BytesIO(data[:100])))


GOOD = warc.record_bytes(1, "u", b"hello", hashlib.sha1(b"hello").hexdigest(), None, False)


@pytest.mark.parametrize(
    "bad",
    [
        GOOD[:-1], GOOD + b"x", GOOD.replace(b"WARC/1.1", b"WARC/9"), GOOD.replace(b"WARC-Date", b"WARC-Dat"), GOOD.replace(b"hello", b"jello"),
        GOOD.replace(b"hello", b"hell"), GOOD.replace(b"Content-Length: 5", b"Content-Length: 6"), GOOD + GOOD, b"", GOOD.replace(b"WARC-Type: response", b"WARC-Type: revisit"),
    ],
)
def test_bad_records(bad):
    with pytest.raises(ValueError):
        warc.page_row(bad)


def test_good_record():
    assert warc.page_row(GOOD)["payload"] == b"hello"


def test_names_that_clash(spark):
    names = ["__same", "__long", "__page", "__digest", "__bytes", "__revisit", "__refers_to", "page", "payload"]
    own = prepare(spark).createDataFrame([r for r in pages() if r[0] != 64], "page_id long, url string, html string")
    wide = own.selectExpr("*", *[f"'x' AS `{n}`" for n in names])
    got, want = (warc.read_archives(warc.write_archives(df)).drop("archive", "position").collect() for df in (wide, own))
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_samples_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 10_000)
    out = warc.read_archives(warc.write_archives(table(spark, pages())))
    assert out.count() == len(pages())


def test_empty(spark):
    assert warc.read_archives(warc.write_archives(table(spark, []))).count() == 0
