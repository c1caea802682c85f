"""Archives are closed by their bytes, however large their records are."""

import hashlib

from marketweave.llm import warc


def test_archives_of_large_records(spark, tmp_path):
    """40 pages of 3 MB that hardly pack: no archive passes its bound, and all come back whole."""
    pages = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "concat_ws('', transform(sequence(1, 23500), k -> sha2(concat(id, '-', k), 512))) AS html").coalesce(1)
    warc.write(warc.with_revisits(pages), str(tmp_path / "w"))
    files = list((tmp_path / "w").glob("part-*"))
    assert len(files) >= 2 and all(f.stat().st_size <= warc.FILE_BYTES + 30 * warc.PARTS_PER_FILE for f in files)
    found = warc.read(spark, str(tmp_path / "w"), payloads=False).selectExpr("kind", "payload_bytes", "payload_digest").collect()
    assert len(found) == 40 and {(r.kind, r.payload_bytes) for r in found} == {("record", 23500 * 128)}
    first = "".join(hashlib.sha512(f"0-{k}".encode()).hexdigest() for k in range(1, 23501))
    assert hashlib.sha1(first.encode()).hexdigest() in {r.payload_digest for r in found}


def test_a_record_larger_than_an_archive_stands_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    rows = [(i, "u", "".join(hashlib.sha256(f"{i}{k}".encode()).hexdigest() for k in range(80 if i == 3 else 4))) for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    monkeypatch.setattr(warc, "PART_BYTES", 500)
    warc.write(warc.with_revisits(pages), str(tmp_path / "w"))
    files = list((tmp_path / "w").glob("part-*"))
    large = [f for f in files if f.stat().st_size > 2000 + 30 * warc.PARTS_PER_FILE]
    assert len(large) == 1 and len(warc.salvage(large[0].read_bytes())[0]) == 1 and len(files) >= 3
    got = warc.round_trip(pages)
    assert sorted((r.page_id, r.payload_bytes) for r in got.collect()) == [(i, len(h)) for i, _, h in rows]
