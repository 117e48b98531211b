import gzip
import hashlib

from llm.conftest import DATA

from patronscope.llm.warc import EMPTY_MEMBER, archive_table, build_record, read_archives, salvage, write_archives


def record(i, body, refers=None):
    return build_record(i, f"http://h/{i}", body, refers, hashlib.sha256(body).hexdigest())


def test_round_trip(spark, folder):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url", "html")
    big = "é" * 60
    more = [(9001, None, None), (9002, "http://x/\r\ny z", ""), (9003, "u", big), (9004, "u", big), (9003, "u", big), (None, "u", big), (9005, "u", "x" * 99), (9006, "u", "x" * 99)]
    docs = pages.unionByName(spark.createDataFrame(more, "page_id long, url string, html string")).repartition(3)
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in docs.collect()]
    first = {}
    for i, b in rows:
        if i is not None:
            first[b] = min(first.get(b, i), i)
    want = []
    for i, b in rows:
        again = len(b) >= 100 and (i is None or i > first[b])
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    found = archive_table(docs, folder + "/w", with_payload=True)
    assert found.where("problem is not null").count() == 0
    got = [tuple(r) for r in found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    write_archives(docs.where("page_id < 0"), folder + "/none")
    assert read_archives(spark, folder + "/none").count() == 0


def test_text_ids(spark, folder):
    """An id that is no number is written without id."""
    rows = [("7", "u", "seven"), ("x7", "u", "other"), (None, "u", "none")]
    found = archive_table(spark.createDataFrame(rows, "page_id string, url string, html string"), folder + "/w", with_payload=True)
    assert sorted(((r["page_id"], bytes(r["payload"])) for r in found.collect()), key=repr) == [(7, b"seven"), (None, b"none"), (None, b"other")]


def test_salvage():
    records = [record(i, bytes([65 + i]) * 300) for i in range(6)]
    for packed in (True, False):
        parts = [gzip.compress(r, mtime=0) + EMPTY_MEMBER if packed else r for r in records]
        starts = [sum(map(len, parts[:k])) for k in range(7)]
        data = bytearray(b"".join(parts))
        assert [x[2].headers["warc-record-id"] for x in salvage(bytes(data))] == [f"<urn:page:{i}>" for i in range(6)]
        data[starts[2] + 40] ^= 0xFF  # a broken record
        data[starts[4] : starts[4]] = b"junk" * 5  # bytes between records
        cut = bytes(data[:-30])  # a cut end
        found = list(salvage(cut))
        good = [x[2].headers["warc-record-id"] for x in found if x[2]]
        assert {f"<urn:page:{i}>" for i in (0, 1, 3, 4)} <= set(good)
        gaps = [(x[0], x[0] + x[1]) for x in found if x[3]]
        assert any(a <= starts[4] < b for a, b in gaps) and len(gaps) >= 2
        assert sum(x[1] for x in found) <= len(cut)
    assert list(salvage(b"")) == [] and [x[3] for x in salvage(b"nothing")] == ["gzip member"]


def test_salvage_members_of_many_records():
    records = [record(i, hashlib.sha256(bytes([i])).hexdigest().encode() * 50) for i in range(6)]

    def ids(data):
        return [x[2].headers["warc-record-id"][10:-1] for x in salvage(data) if x[2]]

    def gaps(data):
        return [x[3] for x in salvage(data) if x[3]]

    whole = gzip.compress(b"".join(records), mtime=0)
    assert ids(whole) == list("012345") and gaps(whole) == []
    odd = gzip.compress(records[0] + b"junk" + records[1][:-9] + records[2] + records[3] + b"end", mtime=0)
    assert ids(odd) == list("023") and gaps(odd) == ["version line", "version line"]
    cut = whole[: len(whole) * 2 // 3]
    assert ids(cut)[:2] == list("01") and gaps(cut) == ["cut gzip member"]
    wrong = whole[:-8] + bytes(4) + whole[-4:]  # the checksum
    assert ids(wrong + gzip.compress(records[5], mtime=0)) == list("0123455") and gaps(wrong) == ["gzip member"]
    hurt = bytearray(whole)
    hurt[len(whole) * 2 // 3] ^= 0xFF
    assert ids(bytes(hurt))[:2] == list("01") and gaps(bytes(hurt))[-1] == "gzip member"
    assert ids(cut + bytes(hurt) + whole)[-6:] == list("012345") and len(ids(cut + bytes(hurt) + whole)) >= 10
