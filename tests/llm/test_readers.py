"""The WARC reader's tasks and bytes, and words of rare characters."""

import gzip
import hashlib
import io
import random

from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumengrid.llm import bpe, warc


class Counting(io.BytesIO):
    """An archive that counts the bytes read from it."""

    total = 0

    def read(self, n=-1):
        data = super().read(n)
        self.total += len(data)
        return data


def archive(n, seed=1):
    rnd = random.Random(seed)
    payloads = [bytes(rnd.randrange(32, 120) for _ in range(rnd.randrange(0, 2500))) for _ in range(n)]
    return b"".join(warc.record(i, "u", p, warc.digest(p), None) for i, p in enumerate(payloads))


def ids(source, size, step):
    return [r["page_id"] for s in range(0, size, step) for r in warc.records_in_range(source, size, s, min(size, s + step))]


def test_a_range_is_read_once():
    data = archive(600)
    for step in (1 << 26, 1 << 17, 20_000):
        source = Counting(data)
        assert ids(source, len(data), step) == list(range(600))
        assert source.total <= 2 * len(data)
    assert ids(Counting(data), len(data), 311) == list(range(600))


def test_what_is_no_record_is_passed():
    data = archive(20)
    cut = data[: len(data) // 2]
    mixed = b"\x1f\x8b\x08no" + cut + b"\x1f\x8b\x08" + data + b"\x1f\x8b"
    told = lambda data, step: [(r["page_id"], r["status"]) for s in range(0, len(data), step) for r in warc.records_in_range(Counting(data), len(data), s, min(len(data), s + step))]
    whole = told(cut, 1 << 20)
    assert 5 < len(whole) < 20 and whole == [(i, "ok") for i in range(len(whole) - 1)] + [(len(whole) - 1, "truncated")]
    want = whole[:-1] + [(len(whole) - 1, "corrupt")] + [(i, "ok") for i in range(20)]
    assert told(mixed, 1 << 20) == want == told(mixed, 5000)
    assert ids(Counting(b""), 0, 10) == []


def member(head, block, tail=b"\r\n\r\n"):
    return gzip.compress(("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items())).encode() + b"\r\n" + block + tail, 1)


def foreign(tmp_path):
    """An archive as crawlers write them, with damaged members between."""
    http = b"HTTP/1.1 200 OK\r\nContent-Length: many\r\n\r\n<p>x</p>"
    sha = warc.digest(b"<p>x</p>")
    uid = lambda n: f"<urn:uuid:00000000-0000-0000-0000-{n:012d}>"
    parts = [
        member({"WARC-Type": "warcinfo", "WARC-Record-ID": uid(1), "Content-Length": 9}, b"software:"),
        member({"WARC-Type": "request", "WARC-Record-ID": uid(2), "WARC-Target-URI": "http://a", "Content-Length": 18}, b"GET / HTTP/1.1\r\n\r\n"),
        member({"WARC-Type": "response", "WARC-Record-ID": uid(3), "WARC-Target-URI": "http://a", "WARC-Payload-Digest": f"sha1:{sha}", "Content-Length": len(http)}, http),
        member({"WARC-Type": "response", "WARC-Record-ID": uid(4), "WARC-Payload-Digest": "sha1:" + hashlib.sha1(b"<p>x</p>").hexdigest(), "Content-Length": "lots"}, http, b""),
        member({"WARC-Type": "response", "WARC-Record-ID": uid(5), "WARC-Payload-Digest": f"sha1:{warc.digest(b'other')}", "Content-Length": len(http)}, http),
        member({"WARC-Type": "response", "WARC-Record-ID": uid(6), "WARC-Payload-Digest": "sha256:00", "Content-Length": len(http)}, http),
        member({"WARC-Type": "metadata", "WARC-Record-ID": uid(7), "WARC-Refers-To": uid(3), "Content-Length": 3}, b"a: "),
        member({"WARC-Type": "revisit", "WARC-Record-ID": uid(8), "WARC-Refers-To": uid(3), "WARC-Payload-Digest": f"sha1:{sha}", "Content-Length": len(http) - 8}, http[:-8]),
        member({"WARC-Type": "resource", "WARC-Record-ID": uid(9), "Content-Length": 50}, b"too short"),
    ]
    bad = bytearray(parts[2])
    bad[-6] ^= 255  # the check sum
    torn = bytearray(warc.record(70, "u", random.Random(2).randbytes(50_000), "X", None))
    torn[30_000:30_040] = bytes(40)
    (tmp_path / "one.warc.gz").write_bytes(b"".join(parts[:4]) + bytes(bad) + b"".join(parts[4:]) + bytes(torn) + warc.record(5, "u", b"ours", warc.digest(b"ours"), None) + parts[2][:-30])
    (tmp_path / "two.warc.gz").write_bytes(archive(30))
    (tmp_path / "none.warc.gz").write_bytes(b"")
    return uid, sha


def test_foreign_and_damaged_archives(spark, tmp_path):
    uid, sha = foreign(tmp_path)
    archives = warc.archives_at(spark, f"file://{tmp_path}")
    told = []
    for step in (1 << 26, 3000, 200):
        rows = warc.read_archives(archives, step).collect()
        told.append(sorted(map(str, rows)))
        assert sum(r.path.endswith("two.warc.gz") for r in rows) == 30
        own = sorted((r for r in rows if r.path.endswith("one.warc.gz")), key=lambda r: r.offset)
        assert [r.status for r in own] == ["ok"] * 4 + ["corrupt"] + ["ok"] * 4 + ["malformed", "corrupt", "ok", "truncated"]
        assert [r.record_type for r in own if r.status == "ok"] == ["warcinfo", "request", "response", "response", "response", "response", "metadata", "revisit", "response"]
        assert [r.record_id for r in own[:4]] == [uid(n) for n in range(1, 5)] and own[7].refers_to_id == own[8].refers_to_id == uid(3)
        assert all(r.page_id is None and r.refers_to is None for r in own if r.record_id and "uuid" in r.record_id)
        three, four, five, six = own[2], own[3], own[5], own[6]
        assert three.payload == four.payload == b"<p>x</p>" and three.payload_bytes == 8 and three.payload_digest == four.payload_digest == sha
        assert (three.intact, four.intact, five.intact, six.intact) == (True, True, False, None)
        assert own[-2].page_id == 5 and bytes(own[-2].payload) == b"ours" and own[9].payload is None and own[9].record_id == uid(9)
        assert all(r.payload is None and not r.intact for r in own if r.status != "ok")
    assert told[0] == told[1] == told[2]


def test_reading_tasks_grow_with_ranges(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html"))
    archives = warc.pages_to_archives(pages.repartition(3))
    total = archives.agg(F.sum("size")).first()[0]
    tasks = lambda step: warc.read_archives(archives, step).select(F.spark_partition_id().alias("p"), "page_id").groupBy("p").count().count()
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true" and tasks(total // 40) > 30 and tasks(1 << 30) == archives.count()
    assert warc.read_archives(archives, total // 40).select("page_id").distinct().count() == 3000


def test_a_hot_payload_and_pages_without_an_id(spark):
    pages = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("html"))
    got = warc.read_archives(warc.pages_to_archives(pages))
    assert got.count() == 900 and got.where("page_id is null and record_type = 'response' and refers_to is null").count() == 300
    assert {r.refers_to for r in got.where("record_type = 'revisit'").collect()} == {2} and got.where("record_type = 'revisit'").count() == 299


def test_every_character_as_the_library():
    path = bpe.default_path()
    lib = Tokenizer.from_file(path)
    lib.no_truncation(), lib.no_padding()
    encoder = bpe.Encoder(bpe.Merger(path), None)

    def check(texts):
        want = [w.ids for w in lib.encode_batch(texts, add_special_tokens=False)]
        assert [g.tolist() for g in encoder.encode(texts)] == want

    every = [chr(c) for c in range(0x3000)]
    for before, after in (("", ""), ("a", ""), ("", "b"), ("A", ""), ("", "Z"), ("1", ""), ("", ".7"), ("' ", ""), ("", "'s"), ("é", "É")):
        check([before + c + after for c in every])
    rnd = random.Random(7)
    for top in (0x80, 0x234, 0x3000):
        check(["".join(chr(rnd.randrange(top)) for _ in range(rnd.randrange(1, 30))) for _ in range(1500)])
    check(["Əli", "Ɓala", "Ɛ n'Ɔ", "İstanbul'ɪ"])


def test_bpe_repeats_and_clashing_columns(spark):
    rows = [(1, "Some words, twice", 5, "x"), (1, "Some words, twice", 5, "x"), (2, None, 0, None), (None, "w " * 200_000, 1, "y"), (None, "w " * 200_000, 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, _e string")
    got = [tuple(r) for r in bpe.encoded(docs).collect()]
    assert len(got) == 5 and len(set(got)) == 3 and {(r[0], r[1]) for r in got} == {(1, 4), (2, 0), (None, 200_000)}
