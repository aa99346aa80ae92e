from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aerostat.llm import ranges, warc

PAGES = "page_id long, url string, html string"


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(2)
    rows = [(3 * i, f"https://h{i % 3}/é {i}\r\nX: y", "<p>" + "".join(rng.choice("abc é\n") for _ in range(rng.randint(0, 900)))) for i in range(120)]
    rows += [(1000 + i, None, rows[i % 5][2]) for i in range(30)]  # copies
    rows += [(2000 + i, "u", "hot") for i in range(90)]
    rows += [(7, "b", None), (8, "c", ""), (9, "x", "long " * 60_000), (9, "y", "other"), (9, "y", "hot"), (2089, "again", "hot"),
             (2089, "again", "hot"), (None, "n", "nobody else's"), (None, "n", "nobody else's"), (None, "m", "hot"), (None, None, None)]
    df = spark.createDataFrame(rows, PAGES)
    for clash in ("shard", "digest", "body", "refers_to", "id", "file"):
        df = df.withColumn(clash, F.lit("clash"))
    return df


def brute(rows, least=0):
    groups = defaultdict(list)
    for i, _, h in rows:
        groups[h or ""].append(i)
    out = []
    for h, ids in groups.items():
        size = len(h.encode())
        ids.sort(key=lambda i: (i is not None, i or 0))
        for nth, i in enumerate(reversed(ids)):
            first = nth == 0 or size < least
            out.append((i, size, sha1(h), "response" if first else "revisit", None if first else ids[-1]))
    return sorted(out, key=str)


def read(spark, root):
    rows = warc.read_warc(spark, root).collect()
    return rows, sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)


@pytest.mark.parametrize("least", [0, 10])
@pytest.mark.parametrize("small", [False, True])
def test_round_trip(spark, pages, small, least):
    root = warc.write_warc(pages, least_bytes=least, **({"shard_bytes": 9_000, "file_bytes": 1_500} if small else {}))
    rows, got = read(spark, root)
    table = [tuple(r)[:3] for r in pages.collect()]
    assert got == brute(table, least)
    by_digest = {sha1(h): (h or "").encode() for _, _, h in table}
    assert all(bytes(r["payload"]) == by_digest[r["payload_digest"]] if r["record_type"] == "response" else r["payload"] is None for r in rows)
    files = warc.manifest(spark, root).collect()
    assert sum(f["records"] for f in files) == len(table)
    if small:
        assert len({f["shard"] for f in files}) > 5 and max(f["roll"] for f in files) > 1
        assert all(f["bytes"] <= 1_500 or f["records"] == 1 for f in files)


def test_files_are_the_same_however_the_pages_are_dealt(spark, pages):
    def files(df):
        root = warc.write_warc(df, shard_bytes=5_000, file_bytes=900)
        return {os.path.basename(p): open(p, "rb").read() for p in glob.glob(f"{root.removeprefix('file:')}/*.warc.gz")}

    one = files(pages)
    assert one == files(pages.repartition(7, "html").orderBy("url")) and len(one) > 10


def test_files_are_plain_gzip_and_in_order(spark, pages):
    root = warc.write_warc(pages, shard_bytes=9_000).removeprefix("file:")
    ids = []
    for path in sorted(glob.glob(f"{root}/*.warc.gz")):
        raw = gzip.open(path).read()
        assert raw.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        ids += [int(x.split(b"\r\n")[0]) for x in raw.split(b"\r\nX-Page-ID: ")[1:]]
    assert ids == sorted(ids) and len(ids) == pages.where("page_id IS NOT NULL").count()
    assert not glob.glob(f"{root}/.*.warc.gz.*-*")  # no temporary names are left


def test_damage_and_unfinished(spark, pages):
    root = warc.write_warc(pages, shard_bytes=20_000)
    with pytest.raises(Exception, match="is there already"):
        warc.write_warc(pages, root=root)
    path = sorted(glob.glob(f"{root.removeprefix('file:')}/*.warc.gz"))[1]
    raw = open(path, "rb").read()
    open(path, "wb").write(raw[:-200])
    with pytest.raises(Exception, match="cut off|not the file"):
        warc.read_warc(spark, root).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        warc.read_warc(spark, root + "-none").collect()
    good = warc.record("resource", [("WARC-Record-ID", "x")], b"some block")
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(good.replace(b"some", b"same"))
    with pytest.raises(ValueError, match="whole"):
        warc.parsed(good[:-1])


def test_empty(spark):
    root = warc.write_warc(spark.createDataFrame([], PAGES))
    assert warc.read_warc(spark, root).collect() == [] and warc.manifest(spark, root).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_ranges_hold_about_the_target(spark, seed):
    rng = random.Random(seed)
    spread = [1 << 62, 300, 1 << 34, 5][seed]
    rows = [(rng.randrange(-spread, spread), rng.randbytes(20), rng.randint(1, 50)) for _ in range(1_500)]
    rows += [(17, rng.randbytes(20), 40) for _ in range(600)]  # a hot id
    rows += [(None, rng.randbytes(20), 40) for _ in range(300 * (seed % 2))]
    df = spark.createDataFrame(rows, "id long, digest binary, size long")
    places = ranges.byte_ranges(df, 1_000)
    assert places == ranges.byte_ranges(df.repartition(3, "size"), 1_000)
    held, members = defaultdict(int), defaultdict(list)
    for i, d, n in rows:
        k = ranges.range_of(places, i, d)
        held[k] += n
        members[k].append((i is not None, i or 0, int.from_bytes(d[:2], "big")))
    assert max(held.values()) <= 2_050 and sum(held.values()) / len(held) > 400
    order = sorted(members)
    assert all(max(members[a]) < min(members[b]) for a, b in zip(order, order[1:]))
