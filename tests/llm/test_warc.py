import gzip
import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from platewise.llm import warc as M
from platewise.llm.common import run_dir


def expected(rows):
    groups = defaultdict(list)
    for i, _, html in rows:
        if len((html or "").encode()) >= 1000 and i is not None:
            groups[html].append(i)
    many = {h for h in groups if sum(r[2] == h for r in rows) > 1}
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        first = max(groups[html]) if html in many else None
        revisit = first is not None and i != first
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def rows():
    big, other = "<p>é漢" * 400, "x" * 1000
    return [(1, "http://a/1", big), (9, "http://a/9", big), (5, None, big), (2, "u", other), (3, "u\r\nWARC/1.1", other), (3, "u", other),
            (4, "u", "x" * 999), (6, "u", "x" * 999), (7, "u", None), (8, "u", ""), (None, "u", big), (None, None, None),
            (10, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n\r\n\r\n"), (11, "u", "\x1f"), (12, "u", "y" * 300_000)]


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, compression):
    df = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows()], "page_id long, url string, html string, HTML string, payload int")
    path = run_dir(spark, "t") + "/a"
    M.write_archive(df, path, compression, records_per_file=4)
    records = M.read_archive(spark, path)
    assert records.where("kind <> 'record'").count() == 0
    assert sorted(map(tuple, M.digest(records).collect()), key=str) == expected(rows())
    texts = {bytes(r.payload).decode() for r in records.where("payload is not null").collect()}
    assert texts == {h or "" for _, _, h in rows()}


def test_files_are_plain_gzip(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    path = run_dir(spark, "t") + "/a"
    M.write_archive(df, path)
    data = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    assert sum(gzip.decompress(d).count(b"WARC-Type: ") for d in data) == df.count()
    got = sorted(map(tuple, M.round_trip(spark, df).collect()), key=str)
    assert got == expected([(r.page_id, r.url, r.html) for r in df.collect()])


def archive(compression, n=12):
    out, parts = b"", []
    for i in range(n):
        raw = M.record(i, f"http://x/{i}", (f"<p>{i} " * 60).encode(), None) + b"\r\n\r\n"
        raw = M._member(raw) if compression == "gzip" else raw
        parts.append((len(out), len(out) + len(raw)))
        out += raw
    return out, parts


def numbers(data):
    got = list(M.salvage(data))
    at = 0
    for kind, a, b, _ in got:  # every byte is in a record or a gap, once
        if a != at:
            assert kind == "record" and a < at or a == at
        at = max(at, b)
    ids = [int(x[0]["warc-record-id"].split(":")[-1][:-1]) for k, _, _, x in got if k == "record"]
    return ids, [(a, b) for k, a, b, _ in got if k == "gap"]


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_salvage(compression):
    data, parts = archive(compression)
    assert numbers(data) == (list(range(12)), [])
    rng = random.Random(1)
    for _ in range(40):
        k = rng.randrange(12)
        a, b = parts[k]
        hurt = bytearray(data)
        at = rng.randrange(a + 12 if compression == "gzip" else data.index(b"<p>", a), b - 12)
        hurt[at] ^= 0x55
        ids, gaps = numbers(bytes(hurt))
        assert set(range(12)) - set(ids) <= {k} and all(a <= g < h <= b for g, h in gaps)
        assert (k not in ids) == bool(gaps)
    if compression == "none":  # a needed header field or the length is spoilt
        for field in (b"WARC-Record-ID", b"WARC-Type", b"Content-Length", b"WARC/1"):
            at = data.index(field, parts[6][0])
            ids, gaps = numbers(data[:at] + b"Z" * len(field) + data[at + len(field):])
            assert ids == [i for i in range(12) if i != 6] and gaps == [parts[6]]
    a, b = parts[4]
    ids, gaps = numbers(data[:a + 20] + data[b:])  # a record cut off
    assert ids == [i for i in range(12) if i != 4] and gaps == [(a, a + 20)]
    ids, gaps = numbers(data[:a] + b"junk " * 9 + data[a:])  # junk between records
    assert ids == list(range(12)) and gaps == [(a, a + 45)]
    ids, gaps = numbers(data[:-9])  # the end missing
    assert ids == list(range(11)) and gaps == [(parts[11][0], len(data) - 9)]
    assert numbers(b"") == ([], []) and numbers(b"not an archive") == ([], [(0, 14)])


def test_gaps_are_logged_by_the_reader(spark, tmp_path):
    data, parts = archive("gzip")
    (tmp_path / "a.warc.gz").write_bytes(data[:parts[3][0] + 30] + data[parts[3][1]:])
    got = M.read_archive(spark, str(tmp_path))
    assert got.where("kind = 'record'").count() == 11
    gap = got.where("kind = 'gap'").first()
    assert (gap.start, gap.end) == (parts[3][0], parts[3][0] + 30) and gap.reason and gap.file.endswith("a.warc.gz")


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert M.round_trip(spark, df).count() == 0


def read(spark, folder, data, name="a.warc"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data)
    got = M.read_archive(spark, str(folder)).orderBy("start", "kind").collect()
    return [r for r in got if r.kind == "record"], [r for r in got if r.kind == "gap"]


def test_the_reader_quarantines_damaged_headers(spark, tmp_path):
    data, parts = archive("none")
    hurt = bytearray(data)
    places = [data.index(b, parts[k][0]) + n for k, b, n in (
        (1, b"WARC-Payload-Digest: sha1:", 30), (3, b"WARC-Payload-Digest: sha1:", 33), (5, b"Payload-Digest: sha1:", 20),
        (7, b"WARC-Type", 2), (9, b"Content-Length", 17))]
    for at, byte in zip(places, b"!A1Z\xb2"):
        hurt[at] = byte if hurt[at] != byte else byte + 1
    records, gaps = read(spark, tmp_path / "x", bytes(hurt))
    assert [r.record_id for r in records] == [f"<urn:x-page:{i}>" for i in (0, 2, 4, 6, 8, 10, 11)]
    assert [(g.start, g.end) for g in gaps] == [parts[k] for k in (1, 3, 5, 7, 9)] and all(g.reason for g in gaps)


def test_digests_in_other_spellings_are_read_and_compared(spark, tmp_path):
    payload = b"<p>" * 500
    raw = M.record(1, "u", payload, None) + b"\r\n\r\n"
    line = raw[raw.index(b"WARC-Payload-Digest: "):raw.index(b"\r\nWARC-Block")]
    sha1, sha256 = hashlib.sha1(payload).hexdigest(), hashlib.sha256(payload).hexdigest()
    good = [line, line[:26] + line[26:].lower(), b"WARC-Payload-Digest: sha1:" + sha1.encode(), b"WARC-Payload-Digest: SHA-1:" + sha1.upper().encode(),
            b"WARC-Payload-Digest: sha256:" + sha256.encode(), b"WARC-Payload-Digest: tiger:xyz"]
    bad = [b"WARC-Payload-Digest: sha1:" + b"0" * 40, line[:-1], b"WARC-Payload-Digest: sha1:", b"WARC-Payload-Digest: " + sha1.encode(),
           b"WARC-Payload-Digest: sha256:" + sha256.encode()[:-1] + b"g", "WARC-Payload-Digest: sha1:\u00e9".encode() * 2]
    records, gaps = read(spark, tmp_path / "x", b"".join(raw.replace(line, x) for x in good))
    assert [r.payload_digest for r in records] == [sha1] * 4 + [None] * 2 and gaps == []
    for x in bad:
        with pytest.raises(M.Bad):
            M.parse(raw.replace(line, x))
    records, gaps = read(spark, tmp_path / "y", b"".join(raw.replace(line, x) + raw for x in bad))
    assert len(records) == len(gaps) == len(bad)
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + b"5dc\r\n" + payload + b"\r\n0\r\n\r\n"
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nWARC-Date: d\r\nContent-Type: application/http\r\nContent-Length: %d\r\n"
    assert M.parse(head % len(chunked) + line + b"\r\n\r\n" + chunked + b"\r\n\r\n")
    with pytest.raises(M.Bad):
        M.parse(head % len(chunked) + line + b"\r\n\r\n" + chunked.replace(b"<p>", b"<q>", 1) + b"\r\n\r\n")


def whole(n=12):
    """A plain archive, the places of its records, and what makes one gzip member of it."""
    return *archive("none", n), M._member


def ids(records):
    return [int(r.record_id.split(":")[-1][:-1]) for r in records]


def test_a_bad_record_among_others_of_its_member(spark, tmp_path):
    data, parts, packed = whole()
    hurt = bytearray(data)
    for k in (0, 4, 5, 11):
        hurt[data.index(b"<p>", parts[k][0])] ^= 1
    first, other = archive("gzip", 2)[0], packed(bytes(hurt))
    records, gaps = read(spark, tmp_path / "x", first + other + first)
    assert sorted(ids(records)) == sorted([0, 1, 1, 2, 3, 6, 7, 8, 9, 10, 0, 1])
    assert {(g.start, g.end) for g in gaps} == {(len(first), len(first + other))}
    assert sorted(g.reason.split(":")[0] for g in gaps) == sorted(
        f"bytes {a} to {b} of the member's content" for a, b in ((0, parts[0][1]), (parts[4][0], parts[5][1]), parts[11]))


@pytest.mark.parametrize("level", [0, 6])
def test_what_precedes_the_damage_of_a_member(spark, tmp_path, level):
    rng = random.Random(7)
    pages = [bytes(rng.randrange(32, 127) for _ in range(700)) for _ in range(12)]
    raws = [M.record(i, "u", p, None) + b"\r\n\r\n" for i, p in enumerate(pages)]
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    raw = z.compress(b"".join(raws)) + z.flush()
    single = archive("gzip", 2)[0]
    at = len(raw) * 2 // 3
    for name, hurt, least in (("cut", raw[:at], 7), ("flip", raw[:at] + bytes([raw[at] ^ 0x55]) + raw[at + 1:], 7),
                              ("crc", raw[:-8] + b"abcd" + raw[-4:], 12), ("end", raw[:-3], 12)):
        records, gaps = read(spark, tmp_path / name, single + hurt + single)
        own = [r for r in records if len(single) <= r.start < len(single + hurt)]
        assert len(own) >= least and len(set(ids(own))) == len(own), name
        assert all(bytes(r.payload) == pages[i] for r, i in zip(own, ids(own)))
        assert sorted(ids([r for r in records if r not in own])) == [0, 0, 1, 1]
        assert gaps and "member" in gaps[0].reason and gaps[-1].end == len(single + hurt)
    plain = b"".join(b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-page:%d>\r\nWARC-Date: d\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n" % i for i in range(3))
    member = M._member(plain)
    assert [x[0] for x in M.salvage(member)] == ["record"] * 3
    assert [x[0] for x in M.salvage(member[:-8] + b"abcd" + member[-4:])] == ["gap"]  # nothing shows that they are whole
    assert [x[0] for x in M.salvage(member[:-8])] == ["record"] * 3 + ["gap"] * (len(member) > 8)


def test_salvage_takes_time_in_proportion_to_the_damage():
    import time
    import zlib as z
    rng = random.Random(3)

    def damaged(n):
        out = []
        for k in range(n):
            raw = M.record(k, f"https://example.org/{k}", rng.randbytes(700), None) + b"\r\n\r\n"
            c = z.compressobj(6, z.DEFLATED, 31)
            m = bytearray(c.compress(raw) + c.flush())
            m[len(m) // 2] ^= 1
            out.append(bytes(m))
        return b"".join(out)

    def seconds(data):
        best = []
        for _ in range(3):
            t = time.perf_counter()
            gaps = [x for x in M.salvage(data)]
            best.append(time.perf_counter() - t)
        assert all(kind == "gap" for kind, *_ in gaps)
        return min(best)

    assert seconds(damaged(8000)) < 3 * seconds(damaged(4000)) + 0.2
    marks = M.Marks(b"xx" + M._VERSION + b"yy" + M._MAGIC + b"zz" + M._VERSION)
    assert [marks.after(0), marks.after(3)] == [2, 2 + len(M._VERSION) + 2]
    assert marks.after(len(marks.data) - len(M._VERSION)) == len(marks.data) - len(M._VERSION) and marks.after(len(marks.data) - 1) == len(marks.data)
