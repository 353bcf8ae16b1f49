"""Packed folders: what goes in comes out, uncommitted archives do not."""

import io
import tarfile

import pytest
from pyarrow import fs

from pricewright.sources.packed import members, pack, packed

NAMES = ["a.md", "faq/ü ß.md", "law/" + "x" * 300 + ".md", "faq/a.md", "faq/a.md"]
BYTES = [b"", b"b\xff!", None, b"one", b"two"]


@pytest.fixture
def files(spark):
    return spark.createDataFrame(list(zip(NAMES, BYTES, strict=True)), "source string, content binary")


def read(frame):
    return sorted((row.source, bytes(row.content)) for row in frame.collect())


def test_round_trip_and_adding(spark, files, tmp_path):
    path = str(tmp_path / "packed")
    pack(files, path)
    wanted = sorted(zip(NAMES, [b or b"" for b in BYTES], strict=True))
    assert read(packed(spark, path)) == wanted
    pack(files.limit(1), path)
    assert read(packed(spark, "file://" + path)) == sorted([*wanted, ("a.md", b"")])


def test_uncommitted_archives_are_not_read(spark, files, tmp_path):
    path = tmp_path / "packed"
    pack(files, str(path))
    (path / "part-left.tar").write_bytes(next(path.glob("*.tar")).read_bytes())
    assert len(read(packed(spark, str(path)))) == len(NAMES)
    for written in path.glob("_packs-*"):
        written.unlink()  # now a folder that other tools have packed
    assert len(read(packed(spark, str(path)))) > len(NAMES)


def test_many_documents_a_task_and_several_archives(spark, tmp_path):
    rows = spark.range(2000).selectExpr("concat('t/', id, '.md') source", "cast(repeat('x', 1000) as binary) content")
    pack(rows.repartition(4), str(tmp_path / "p"), pack_bytes=100_000)
    assert len(list((tmp_path / "p").glob("*.tar"))) >= 20
    whole = packed(spark, str(tmp_path / "p"))
    assert whole.rdd.getNumPartitions() == 1
    cut = packed(spark, str(tmp_path / "p"), split=500_000)
    assert 4 < cut.rdd.getNumPartitions() < 20
    assert whole.count() == cut.count() == 2000


def test_names_alone_leave_the_contents_unread(spark, tmp_path):
    with tarfile.open(tmp_path / "big.tar", "w") as archive:
        for name in ("a/1.md", "a/2.md"):
            header = tarfile.TarInfo(name)
            header.size = 5_000_000
            archive.addfile(header, io.BytesIO(bytes(header.size)))

    class Counting(fs.LocalFileSystem):
        read = 0

        def open_input_file(self, path):
            return Counted(path)

    class Counted(io.FileIO):
        def read(self, size=-1):
            data = super().read(size)
            Counting.read += len(data)
            return data

    assert [name for name, _ in members(Counting(), str(tmp_path / "big.tar"), False)] == ["a/1.md", "a/2.md"]
    assert Counting.read < 100_000
    assert packed(spark, str(tmp_path), contents=False).columns == ["source"]
    assert packed(spark, str(tmp_path), contents=False).count() == 2


def test_empty_folders_and_wrong_tables(spark, files, tmp_path):
    pack(files.filter("false"), str(tmp_path / "none"))
    assert packed(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(Exception, match="needs a source"):
        pack(spark.createDataFrame([(None, b"x")], "source string, content binary"), str(tmp_path / "bad"))
    assert packed(spark, str(tmp_path / "bad")).collect() == []
