import glob
import gzip
import zlib

from pyspark.sql import functions as F
from test_operators import record, zipped

from marketweave.llm import warc


def flipped(data, at):
    return data[:at] + bytes([data[at] ^ 0xFF]) + data[at + 1 :]


def test_a_member_of_many_records_gives_all_before_the_break():
    data = zipped(b"".join(record(b"%d" % i, b"%d " % (i * i) * 400) for i in range(2000)))
    for back in (2000, len(data) // 2):
        broken = flipped(data, len(data) - back)
        d, want = zlib.decompressobj(31), b""
        try:
            for i in range(len(broken)):
                want += d.decompress(broken[i : i + 1])
        except zlib.error:
            pass
        plain = next(warc._unzip(broken))[1]
        assert plain.startswith(want) and len(want) > 1000
        found, gaps = warc.salvage(broken)
        assert len(found) > 900 * (2 if back == 2000 else 1) and [h["warc-record-id"] for _, h, _ in found] == [f"<{i}>" for i in range(len(found))]
        assert any("gzip member broken" in g[2] for g in gaps)


def test_one_flipped_byte_costs_one_written_record(spark, tmp_path):
    pages = spark.range(50).select(F.col("id").alias("page_id"), F.lit("http://x/").alias("url"), F.concat(F.repeat(F.sha2(F.col("id").cast("string"), 256), 30), F.lit("é\r\n")).alias("html")).coalesce(1)
    warc.write(warc.with_revisits(pages), f"{tmp_path}/w")
    (file,) = [f for f in glob.glob(f"{tmp_path}/w/part-*") if not f.endswith(".crc")]
    with open(file, "rb") as f:
        data = f.read()
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 50 and len(warc.salvage(data)[0]) == 50
    for at in range(5, len(data), len(data) // 23):
        found, gaps = warc.salvage(flipped(data, at))
        assert len(found) >= 49, at
        assert gaps or len(found) == 50
