from __future__ import annotations

import glob
import hashlib
import random
import struct
from collections import Counter

import zstandard

from docsync.llm import warc
from tests.llm.helpers import vocabulary, words

SCHEMA = "page_id long, url string, html string, digest string, keeper string"


def want(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    largest = {}
    for i, p in data:
        if len(p) >= 1000 and i is not None:
            largest[p] = max(largest.get(p, i), i)
    counts = Counter(p for _, p in data)
    for i, p in data:
        keeper = largest.get(p) if counts[p] > 1 else None
        revisit = keeper is not None and (i is None or i < keeper)
        yield i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def sample():
    rng = random.Random(2)
    vocab = vocabulary(rng)
    texts = ["<p>" + words(rng, vocab, rng.randint(1, 600)) for _ in range(40)]
    rows = [(i, f"http://h/{i}", rng.choice(texts)) for i in range(150)]
    return rows + [(None, None, texts[0]), (None, "u", None), (900, "a\r\nWARC-Type: x", ""), (901, "é", "x" * 999), (902, "", "x" * 999), (903, "", "y" * 300_000), (149, "", rows[149][2]), (149, "", rows[149][2])]


def test_round_trip(spark):
    rows = sample()
    got = warc.digest(warc.round_trip(pages(spark, rows))).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want(rows)))


def test_files(spark, folder):
    rows = sample()
    manifest = warc.write_archives(pages(spark, rows), folder + "/w").collect()
    assert sum(r.records for r in manifest) == len(rows)
    assert len(glob.glob(folder + "/w/*.warc.zst")) == len(manifest)
    payloads = Counter()
    for r in manifest:
        with open(r.archive, "rb") as f:
            magic, size = struct.unpack("<II", f.read(8))
            assert magic == 0x184D2A5D
            dictionary = zstandard.ZstdCompressionDict(f.read(size))
            rest = f.read()
        # each record is a frame of its own
        frames = 0
        while rest:
            one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            assert one.decompress(rest).startswith(b"WARC/1.1\r\n")
            rest = one.unused_data
            frames += 1
        assert frames == r.records
        for headers, http, payload in warc.read_archive(r.archive):
            payloads[headers["WARC-Type"], payload] += 1
    assert payloads == Counter((t, (h or "").encode() if t == "response" else b"") for (_, _, h), (_, _, _, t, _) in zip(rows, want(rows)))


def test_damage_is_noticed(spark, folder):
    manifest = warc.write_archives(pages(spark, sample()), folder + "/w")
    name = manifest.first().archive
    data = bytearray(open(name, "rb").read())
    data[-20] ^= 255
    open(name, "wb").write(data)
    try:
        list(warc.read_archive(name))
    except (zstandard.ZstdError, ValueError, KeyError):
        return
    raise AssertionError("damage went unnoticed")


def test_empty_and_untrainable(spark):
    assert warc.round_trip(pages(spark, sample()).limit(0)).count() == 0
    got = warc.digest(warc.round_trip(pages(spark, [(1, "u", None)]))).collect()
    assert [tuple(r) for r in got] == list(want([(1, "u", None)]))


def test_archives_are_split_by_size(spark, folder, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1)
    assert warc.train_dictionary(pages(spark, sample()).limit(0)) == b""


def test_the_sample_is_of_different_payloads_and_whole_ones(spark, monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE_RECORDS", 2)
    copies = pages(spark, [(i, "u", f"<p>{i % 3}" + "x" * 2000) for i in range(4000)])
    assert b"x" * 2000 in warc.train_dictionary(copies)
    # Most of each payload is past its first characters.
    monkeypatch.setattr(warc, "SAMPLE_RECORDS", 1000)
    tails = pages(spark, [(i, "u", "x" * warc.SAMPLE_CHARACTERS + f"y{i}" * 50_000) for i in range(5)])
    assert b"y3y3" in warc.train_dictionary(tails)
