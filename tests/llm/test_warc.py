import gzip
import hashlib
import tempfile

import pytest

from ledgerline.llm import warc

SAME = "<p>" + "é" * 600
PAGES = [(1, "http://a/", "<p>one</p>"), (2, "http://b/", SAME), (5, "http://c/", SAME), (3, "http://d/", SAME),
         (4, None, None), (6, "http://x/\r\nWARC/1.0", "WARC/1.0\r\nWARC-Type: response\r\n\r\nfake\r\n\r\n"),
         (7, "http://e/", "<p>one</p>"), (None, "http://f/", "no id"), (8, "", "x" * 200000),
         (9, "u", "y" * 1000), (10, "u", "y" * 1000), (10, "u", "y" * 1000), (11, "u", "z" * 999), (12, "u", "z" * 999)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, h, "digest", 3) for i, u, h in PAGES],
                                 "page_id long, url string, html string, digest string, first_id long")


def expected():
    first = {}
    for i, _, h in PAGES:
        data = (h or "").encode()
        if len(data) >= 1000:
            first[data] = max(first.get(data, -1), i)
    out = []
    for i, _, h in PAGES:
        data = (h or "").encode()
        up = first.get(data)
        revisit = up is not None and up != i
        out.append((i or -1, len(data), hashlib.sha1(data).hexdigest(),
                    "revisit" if revisit else "response", up if revisit else -1))
    return sorted(out)


def test_round_trip(pages):
    for options in ({}, {"compression": "none", "records_per_file": 3}):
        got = sorted((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"],
                      r["refers_to"] or -1) for r in warc.round_trip(pages, **options).collect())
        assert got == expected()


def records(spark, pages):
    path = tempfile.mkdtemp(prefix="ll-warc-") + "/a"
    warc.write_archives(pages.coalesce(1), path, compression="none")
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    return bytes(files[0]["content"])


@pytest.fixture(scope="module")
def archive(spark, pages):
    return records(spark, pages)


def covered(rows, size):
    """Records and gaps lie one after the other and cover every byte."""
    at = 0
    for r in rows:
        assert r["offset"] == at
        at += r["length"]
    assert at == size


def test_damage_costs_only_the_damaged_record(archive):
    whole = list(warc.salvage(archive))
    covered(whole, len(archive))
    assert [r["kind"] for r in whole] == ["record"] * len(PAGES)
    for k, record in enumerate(whole):
        start, end = record["offset"], record["offset"] + record["length"]
        for at in (start + 2, start + 40, end - 8, end - 2):
            broken = bytearray(archive)
            broken[at] ^= 0x15
            rows = list(warc.salvage(bytes(broken)))
            covered(rows, len(archive))
            ids = [r["record_id"] for r in rows if r["kind"] == "record"]
            lost = [r["record_id"] for j, r in enumerate(whole) if j != k]
            assert set(lost) <= set(ids)
            header = archive.index(b"\r\n\r\n", start)
            if at > header or at == start + 2:  # header fields but the version have no digest
                assert any(r["kind"] == "gap" for r in rows)


def test_cut_off_and_junk(archive):
    whole = list(warc.salvage(archive))
    cut = archive[:whole[3]["offset"] + 50]
    rows = list(warc.salvage(cut))
    covered(rows, len(cut))
    assert [r["kind"] for r in rows] == ["record"] * 3 + ["gap"]
    junk = b"\n junk \n" + archive
    rows = list(warc.salvage(junk))
    assert rows[0]["kind"] == "gap" and len(rows) == len(whole) + 1
    assert list(warc.salvage(b"")) == []
    assert [r["kind"] for r in warc.salvage(b"nothing at all")] == ["gap"]


def members(archive):
    return [gzip.compress(archive[r["offset"]:r["offset"] + r["length"]])
            for r in warc.salvage(archive)]


def test_gzip_members_one_damaged(archive):
    parts = members(archive)
    assert len([r for r in warc.salvage(b"".join(parts)) if r["kind"] == "record"]) == len(parts)
    for k in (0, 4, len(parts) - 1):
        for cut in (slice(0, len(parts[k]) // 2), slice(12, None)):
            data = b"".join([*parts[:k], parts[k][cut], *parts[k + 1:]])
            rows = list(warc.salvage(data))
            assert len([r for r in rows if r["kind"] == "record"]) >= len(parts) - 1
            assert any(r["kind"] == "gap" for r in rows)


def test_gaps_are_logged_by_the_reader(spark, pages, archive):
    folder = tempfile.mkdtemp(prefix="ll-warc-")
    broken = bytearray(archive)
    second = list(warc.salvage(archive))[1]
    broken[second["offset"] + second["length"] - 10] ^= 1
    with open(f"{folder}/a.warc", "wb") as fh:
        fh.write(broken)
    rows = warc.read_archives(spark, folder).collect()
    gaps = [r for r in rows if r["kind"] == "gap"]
    assert [(g["offset"], g["length"]) for g in gaps] == [(second["offset"], second["length"])]
    assert gaps[0]["reason"] == "block digest differs" and gaps[0]["file"].endswith("a.warc")
    assert len(rows) == len(PAGES)
    texts = {bytes(r["payload"]) for r in rows if r["record_type"] == "response"}
    assert b"x" * 200000 in texts


def packed(spark, count=60):
    """What write_archives writes by default, as one file of ``count`` records."""
    path = tempfile.mkdtemp(prefix="ll-warc-") + "/a"
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<p>{k}</p>" + hashlib.sha512(b"%d" % k).hexdigest() * 9)
                                   for k in range(count)], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), path)
    return bytes(spark.read.format("binaryFile").load(path).select("content").collect()[0]["content"])


def test_damage_of_default_archives_costs_only_the_records_it_touches(spark):
    count = 60
    data = packed(spark, count)
    assert gzip.decompress(data).count(b"WARC/1.0\r\n") == count
    whole = list(warc.salvage(data))
    assert [r["kind"] for r in whole] == ["record"] * count  # no gaps between members
    ids = {r["record_id"] for r in whole}
    starts = [r["member"] for r in whole] + [len(data)]
    for share in range(0, 100, 3):
        for size in (1, 512):
            lo = len(data) * share // 100
            broken = bytearray(data)
            for at in range(lo, min(lo + size, len(data))):
                broken[at] ^= 0x55
            hit = {r["record_id"] for r, a, b in zip(whole, starts, starts[1:]) if a < lo + size and b > lo}
            rows = list(warc.salvage(bytes(broken)))
            got = [r["record_id"] for r in rows if r["kind"] == "record"]
            assert ids - hit <= set(got) and len(got) <= count
            assert len(set(got) - ids) <= len(hit)  # a hit header has no digest of its own
            if size > 1:
                assert any(r["kind"] == "gap" for r in rows)
    cut = list(warc.salvage(data[:starts[30] + 20]))
    assert sum(r["kind"] == "record" for r in cut) == 30 and cut[-1]["kind"] == "gap"


def test_records_ahead_of_damage_in_one_member_are_kept(archive):
    small = b"".join(archive[r["offset"]:r["offset"] + r["length"]] for r in warc.salvage(archive)
                     if r["length"] < 3000)
    total = len(list(warc.salvage(small)))
    whole = bytearray(gzip.compress(small, 9))
    assert len(whole) < 4096 and total > 5
    whole[-20:-8] = b"\xff" * 12  # near the end of the first step
    rows = [r for r in warc.salvage(bytes(whole)) if r["kind"] == "record"]
    assert len(rows) >= total - 2


def test_large_records_end_their_member_with_a_zero():
    big = bytes(1 << 24) + b"end"
    assert warc._member(big).endswith(b"\0") and gzip.decompress(warc._member(big)) == big


def test_late_version_line_of_a_plain_archive(archive):
    junk = b"\x1f\x8b\x08 no member " + b"j" * (1 << 17) + b"\n"
    found = [r for r in warc.salvage(b"x" + junk + archive) if r["kind"] == "record"]
    assert len(found) == len(PAGES)


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(none).count() == 0


def test_revisits_name_their_profile(spark):
    path = tempfile.mkdtemp(prefix="ll-warc-") + "/a"
    pages = spark.createDataFrame([(k, f"http://h/{k}", "same " * 400) for k in range(4)] + [(9, "u", "x")],
                                  "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), path, compression="none")
    data = b"".join(bytes(r["content"]) for r in
                    spark.read.format("binaryFile").load(path).select("content").collect())
    records = data.split(b"WARC/1.0\r\n")[1:]
    profile = b"\r\nWARC-Profile: " + warc.PROFILE.encode() + b"\r\n"
    assert [(b"WARC-Type: revisit" in r, profile in r) for r in records].count((True, True)) == 3
    assert not any(profile in r for r in records if b"WARC-Type: response" in r)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_are_bounded_by_bytes(spark, compression):
    path = tempfile.mkdtemp(prefix="ll-warc-") + "/a"
    noise = [hashlib.shake_256(b"%d" % k).hexdigest(20000 if k == 7 else 700) for k in range(40)]
    pages = spark.createDataFrame([(k, f"http://h/{k}", x) for k, x in enumerate(noise)],
                                  "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), path, compression=compression, archive_bytes=8000)
    files = [bytes(r["content"]) for r in
             spark.read.format("binaryFile").load(path + "/part-*").select("content").collect()]
    found = [list(warc.salvage(f)) for f in files]
    assert all(r["kind"] == "record" for rows in found for r in rows)
    assert sum(map(len, found)) == 40
    assert all(len(f) <= 8000 or len(rows) == 1 for f, rows in zip(files, found))
    assert sum(len(f) > 8000 for f in files) == 1 and max(map(len, found)) > 2
