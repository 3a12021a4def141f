"""Archives with long headers, and damaged ones."""

import gzip

import pytest

from stratalake.llm import warc
from stratalake.session import scratch_dir


def test_a_url_of_any_length_loses_no_record(spark):
    rows = [(i, f"http://a/{i}", f"page {i}") for i in range(20)]
    rows[7] = (7, "http://a/" + "x" * 70_000, "page 7")
    rows[12] = (12, "http://a/" + "y" * 3_000_000, "page 12")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = scratch_dir(spark, "archives")
    warc.write_warc(pages, path)
    found = {r.record_id: r for r in warc.read_warc(spark, path).collect()}
    assert {k: (r.uri, bytes(r.payload).decode()) for k, r in found.items()} == {
        f"<urn:page:{i}>": (url, html) for i, url, html in rows
    }


def test_headers_that_share_their_end():
    head = b"WARC/1.0\r\nno field\r\nWARC-Type: a\r\nWARC/1.0\r\nWARC-Type: b\r\nX:WARC/1.0\r\n"
    data = head + b"Content-Length: 1\r\nWARC-Type: c\r\n\r\nz\r\n\r\n" + b"WARC/1.0\r\nA: 1"
    found = [(f["at"], f["next"], f["record_type"], f["payload"]) for f in warc.candidates_in(data)]
    end = data.index(b"z") + 5
    starts = [head.index(b"WARC/1.0\r\nWARC"), head.index(b"X:") + 2]
    assert found == [(at, end, "c", b"z") for at in starts]
    many = b"WARC/1.0\r\nContent-Length: 1\r\nX:" * 20_000
    assert sum(1 for _ in warc.candidates_in(many + b"1\r\n\r\nz\r\n\r\n")) == 20_000


def record(page, payload, length=None, stated=""):
    digest = warc.b32encode(warc.hashlib.sha1(payload).digest()).decode()
    return (
        f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\n"
        f"WARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {length or len(payload)}\r\n"
        f"{stated}\r\n"
    ).encode() + payload + b"\r\n\r\n"


def test_damaged_archives_are_errors(spark, tmp_path):
    three = [record(i, b"page %d" % i) for i in range(3)]
    whole = b"".join(three)
    members = [gzip.compress(r) for r in three]
    sound = {
        "plain": whole,
        "gzipped": gzip.compress(whole),
        "a member each": b"".join(members),
        "nothing, gzipped": gzip.compress(b""),
        "nothing": b"",
    }
    damaged = {
        "cut in a payload": whole[:-6],
        "cut in a header": whole[: len(three[0]) + 30],
        "wrong length": three[0] + record(1, b"page 1", 5) + three[2],
        "wrong length at once": record(0, b"page 0", 7) + three[1],
        "no record": b"nothing of the kind",
        "no record, gzipped": gzip.compress(b"nothing of the kind"),
        "cut gzip": gzip.compress(whole)[:-20],
        "cut checksum": gzip.compress(whole)[:-3],
        "cut last member": b"".join(members[:2]) + members[2][:12],
    }
    for i, content in enumerate(sound.values()):
        (tmp_path / f"sound-{i}.warc").write_bytes(content)
    found = warc.read_warc(spark, f"file://{tmp_path}")
    assert sorted(r.record_id for r in found.collect()) == sorted(
        f"<urn:page:{i}>" for i in range(3) for _ in range(3)
    )
    for i, (what, content) in enumerate(damaged.items()):
        folder = tmp_path / f"damaged-{i}"
        folder.mkdir()
        (folder / "sound.warc").write_bytes(whole)
        (folder / "damaged.warc").write_bytes(content)
        with pytest.raises(ValueError, match=r"damaged archives, among them \['[^']*damaged.warc'\]"):
            pytest.fail(f"{what}: {warc.read_warc(spark, f'file://{folder}').count()} rows")


def test_a_response_is_as_long_as_its_payload(spark, tmp_path):
    inside = record(9, b"x", stated="X-Payload-Length: 77\r\n") + record(8, b"y", stated="X-Payload-Length: no\r\n")
    plain = record(0, b"abc") + record(1, inside, stated=f"X-Payload-Length: {len(inside)}\r\n")
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.warc").write_bytes(plain)
    found = warc.read_warc(spark, f"file://{tmp_path}/plain").collect()
    assert {r.record_id: r.payload_bytes for r in found} == {"<urn:page:0>": 3, "<urn:page:1>": len(inside)}
    (tmp_path / "wrong").mkdir()
    (tmp_path / "wrong" / "a.warc").write_bytes(record(0, b"abc", stated="X-Payload-Length: 999\r\n"))
    with pytest.raises(Exception, match="payload differs from its digest or length"):
        warc.read_warc(spark, f"file://{tmp_path}/wrong").collect()
