import io
import zipfile

from marketweave.sources import archive


def test_a_spoiled_inner_member_is_found(spark, tmp_path):
    def packed(data):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("2024.parquet", data)
        return out.getvalue()

    good, bad = packed(b"good bytes"), packed(b"spoil me").replace(b"spoil me", b"spoiled!", 1)
    name = tmp_path / "outer.zip"
    with zipfile.ZipFile(name, "w") as z:
        z.writestr("sh600000.zip", good)
        z.writestr("sz000001.zip", bad)
    got = archive.inventory(spark, [str(name)], deep=True, nested=True).first()
    assert got.bad_members == ["sz000001.zip:2024.parquet"] and got.parquet_members == 2 and got.problem is None
    assert archive.inventory(spark, [str(name)], nested=True).first().bad_members == []


def test_a_member_that_cannot_be_unpacked_is_bad():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.parquet", b"some bytes " * 50)
    data = bytearray(out.getvalue())
    data[39] = 0xFF  # the first byte of the packed data
    with zipfile.ZipFile(io.BytesIO(bytes(data))) as z:
        assert archive._bad(z) == ["a.parquet"]
    with zipfile.ZipFile(out) as z:
        assert archive._bad(z) == []
