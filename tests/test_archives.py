import gzip
import io
import tarfile
import zipfile

import pytest

from cladeworks.sources import archives, readers


def _tar(path, members, mode="w:gz"):
    with tarfile.open(path, mode) as t:
        folder = tarfile.TarInfo("./sub")
        folder.type = tarfile.DIRTYPE
        t.addfile(folder)
        for name, text in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))


def _rows(df):
    return sorted((r["archive"].rsplit("/", 1)[-1], r["member"], r["line_no"], r["value"]) for r in df.collect())


def _files(folder):
    with zipfile.ZipFile(folder / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x/one.txt", "a\nb é\n")
        z.writestr("x/", "")
        z.writestr("two.txt", "no end\n\nlast")
        z.writestr("empty.txt", "")
    _tar(folder / "b.tar.gz", {"./one.txt": "t1\nt2\n", "sub/two.txt": "t3"})
    _tar(folder / "c.tar", {"one.txt": "plain\r\n"}, "w")
    (folder / "d.txt.gz").write_bytes(gzip.compress(b"g1\ng2\n") + gzip.compress(b"g3\n"))  # several gzip members are one file
    (folder / "e.txt").write_bytes(b"text \xff\n")


WANT = sorted(
    [("a.zip", "x/one.txt", 0, "a"), ("a.zip", "x/one.txt", 1, "b é"), ("a.zip", "two.txt", 0, "no end"), ("a.zip", "two.txt", 1, ""), ("a.zip", "two.txt", 2, "last"), ("b.tar.gz", "one.txt", 0, "t1"), ("b.tar.gz", "one.txt", 1, "t2")]
    + [("b.tar.gz", "sub/two.txt", 0, "t3"), ("c.tar", "one.txt", 0, "plain"), ("d.txt.gz", "d.txt", 0, "g1"), ("d.txt.gz", "d.txt", 1, "g2"), ("d.txt.gz", "d.txt", 2, "g3"), ("e.txt", "e.txt", 0, "text �")]
)


def test_all_kinds_both_ways(spark, tmp_path):
    _files(tmp_path)
    out = archives.read(spark, str(tmp_path))
    assert _rows(out) == WANT and out.rdd.getNumPartitions() == 7  # three members of the zip, and four files
    assert _rows(archives.read(spark, f"file://{tmp_path}/b.*")) == [r for r in WANT if r[0] == "b.tar.gz"]
    contents = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    assert _rows(archives.unpacked(contents)) == WANT
    with pytest.raises(Exception, match="FileNotFoundError|nothing"):
        archives.read(spark, str(tmp_path / "nothing*")).collect()


def test_a_member_of_many_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "_BATCH", 1000)
    lines = [f"line {k} " + "x" * (k % 50) for k in range(3000)]
    with zipfile.ZipFile(tmp_path / "big.zip", "w") as z:
        z.writestr("big.txt", "\n".join(lines))
    with open(tmp_path / "big.zip", "rb") as raw:
        batches = list(archives._batches("big.zip", raw))
    assert len(batches) > 20 and [v for b in batches for v in b.column("value").to_pylist()] == lines
    assert [n for b in batches for n in b.column("line_no").to_pylist()] == list(range(3000))


def test_a_release_as_downloaded(spark, tmp_path):
    """A tarred dump of nodes and names is unpacked and read by the format's reader."""
    nodes = "1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tgenus\t|\n"
    names = "1\t|\troot\t|\t\t|\tscientific name\t|\n2\t|\tAus\t|\t\t|\tscientific name\t|\n2\t|\tOld\t|\t\t|\tsynonym\t|\n"
    _tar(tmp_path / "taxdump.tar.gz", {"nodes.dmp": nodes, "names.dmp": names, "merged.dmp": "9\t|\t2\t|\n", "readme.txt": "x"})
    archives.unpack(archives.read(spark, str(tmp_path / "taxdump.tar.gz")), str(tmp_path / "raw"), ["nodes.dmp", "names.dmp", "merged.dmp"])
    taxa, syn, forwards = readers.ncbi(spark, str(tmp_path / "raw"))
    assert sorted((r["uid"], r["par_id"], r["name"]) for r in taxa.collect()) == [("1", None, "root"), ("2", "1", "Aus")]
    assert [r["name"] for r in syn.collect()] == ["Old"] and forwards.count() == 1
